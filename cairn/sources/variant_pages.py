"""S3 and S5 on VARIANT: one parse per document, whatever its shape, and no field lost.

A page is parsed once into a variant. Its list is looked up where the known shapes have it, known fields
are taken by path with their types (null if they do not fit), and the rest of each item is kept as JSON
in ``extra_fields``. ``page_shapes`` and ``item_schema`` show what the pages hold before a schema is
fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.sources.json_pages import SIDE_FIELDS

# fixed values: the item's field names and the sides' numbers
TX_FIELDS = {"tx_hash": "string", "block_unix_time": "bigint", "tx_type": "string", "source": "string", "owner": "string"}
SIDE_NUMBERS = ("ui_change_amount", "nearest_price")
LISTS = {"list": "$", "items": "$.items", "trades": "$.trades"}


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _data(pages: DataFrame) -> DataFrame:
    """Pages (``value`` and others) that count as fetched, with ``data`` as a variant; data that is a
    string is a document of its own."""
    p = pages.withColumn("_v", F.try_parse_json("value"))
    v = F.col("_v")
    ok = v.isNotNull() & (F.lower(F.coalesce(_get(v, "$.success", "string"), F.lit("true"))) != "false")
    d = _get(v, "$.data", "variant")
    d = F.when(F.schema_of_variant(d) == "STRING", F.try_parse_json(_get(v, "$.data", "string"))).otherwise(d)
    return p.where(ok).withColumn("data", d).drop("_v").where(F.col("data").isNotNull())


def _side_rest(item: Column, side: str) -> Column:
    """The unknown fields of one side, as a map with the side in front of the names."""
    more = F.map_filter(_get(item, f"$.{side}", "map<string,variant>"), lambda k, _: ~k.isin(SIDE_FIELDS))
    named = F.transform(F.map_entries(more), lambda e: F.struct(F.concat(F.lit(f"{side}."), e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.coalesce(named, F.array().cast("array<struct<key:string,value:variant>>")))


def _list(data: Column) -> Column:
    return F.coalesce(*[_get(data, path, "array<variant>") for path in LISTS.values()])


def transactions_from_variant(pages: DataFrame) -> DataFrame:
    """S3: the columns of ``normalize_transactions`` and ``extra_fields``, a JSON object of all fields of
    the item and of its sides that have no column (null if there are none)."""
    x = _data(pages).select(F.explode(_list(F.col("data"))).alias("x"))
    item = F.col("x")
    cols = [_get(item, f"$.{f}", kind).alias("transaction_hash" if f == "tx_hash" else f) for f, kind in TX_FIELDS.items()]
    for side in ("base", "quote"):
        cols += [_get(item, f"$.{side}.{f}", "double" if f in SIDE_NUMBERS else "string").alias(f"{side}_{f}") for f in SIDE_FIELDS]
    known = [*TX_FIELDS, "base", "quote"]
    rest = F.map_filter(_get(item, "$", "map<string,variant>"), lambda k, _: ~k.isin(known))
    for side in ("base", "quote"):
        rest = F.map_concat(rest, _side_rest(item, side))
    out = x.select(*cols, F.when(F.size(rest) > 0, F.to_json(rest)).alias("extra_fields"))
    return out.where(F.col("transaction_hash").isNotNull() & (F.col("transaction_hash") != ""))


def event_fields(v: Column) -> list[Column]:
    """S5 on a parsed payload: a JSON array's first element; anything else gives nulls and UNKNOWN."""
    is_array = _get(v, "$", "array<variant>").isNotNull()
    return [
        F.when(is_array, _get(v, "$[0].signature", "string")).alias("transaction_signature"),
        F.coalesce(F.when(is_array, _get(v, "$[0].type", "string")), F.lit("UNKNOWN")).alias("webhook_type"),
        F.when(is_array, _get(v, "$[0].accountData[0].account", "string")).alias("account_address"),
        F.when(is_array, _get(v, "$[0].tokenTransfers[0].mint", "string")).alias("token_address"),
    ]


def events_from_variant(payloads: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """``payloads`` with the event's columns."""
    return payloads.withColumn("_v", F.try_parse_json(payload)).select(*payloads.columns, *event_fields(F.col("_v")))


def page_shapes(pages: DataFrame) -> DataFrame:
    """(shape, pages, items): where the fetched pages have their lists; shape null: nowhere."""
    d = F.col("data")
    shape = F.coalesce(*[F.when(_get(d, path, "array<variant>").isNotNull(), name) for name, path in LISTS.items()])
    return _data(pages).groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.size(_list(d)).cast("long")), F.lit(0)).alias("items"))


def item_schema(pages: DataFrame) -> DataFrame:
    """One row: the merged type of all items of all pages, as a DDL string."""
    return _data(pages).select(F.explode(_list(F.col("data"))).alias("x")).agg(F.schema_of_variant_agg("x").alias("item_schema"))
