"""M11 over the landed pages and payloads (S1-S5): bad rows are kept apart with a reason, in one pass.

A checked frame holds every item of every page, and every page that gives no items, as one row:
``level`` (page or item), ``pos`` (place in the page), ``reason`` (null: accepted), ``bad_fields``
(fields of an accepted item that are there but hold no number), ``raw`` (the rejected text) and
``record`` (the normalised columns). Columns of the page frame other than ``value`` are carried along.
``land`` writes accepted and rejected rows in one job and takes the counts from that same job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from cairn.sources import json_pages as jp

_CORRUPT = "_corrupt_record"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _parsed(schema: StructType) -> Column:
    return F.from_json("value", StructType([*schema.fields, StructField(_CORRUPT, jp.S)]), _PERMISSIVE)


def _is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def _checked(pages: DataFrame, schema: StructType, items: Callable[[Column], Column], faults: list[tuple[Column, str]],
             record: list[Column], numbers: list[tuple[str, Column, str]]) -> DataFrame:
    """``items`` gives the list of a parsed page; ``faults`` are (condition on item ``x``, reason), the
    first that holds counts; ``numbers`` are (name, text, type) of the fields that should be numbers."""
    kept = [c for c in pages.columns if c != "value"]
    page = F.col("p")
    p = pages.withColumn("p", _parsed(schema))
    why = (F.when(F.col("value").isNull() | (F.trim("value") == ""), "empty document")
           .when(page[_CORRUPT].isNotNull(), "malformed document")
           .when(F.lower(F.coalesce(page["success"], F.lit("true"))) == "false", "unsuccessful page")
           .when(page["data"].isNull(), "no data")
           .when(items(page).isNull(), "no list"))
    p = p.withColumn("page_reason", why)
    x = p.select(*kept, "value", "page_reason", F.posexplode_outer(F.when(F.col("page_reason").isNull(), items(page))).alias("pos", "x"))
    x = x.where(F.col("page_reason").isNotNull() | F.col("pos").isNotNull())  # an empty list holds nothing to reject
    item_reason = F.when(F.col("x").isNull(), "no object")
    for bad, reason in faults:
        item_reason = item_reason.when(bad, reason)
    x = x.withColumn("reason", F.coalesce("page_reason", F.when(F.col("page_reason").isNull(), item_reason)))
    bad = F.array_compact(F.array(*[F.when(text.isNotNull() & text.try_cast(kind).isNull(), name) for name, text, kind in numbers]))
    ok = F.col("reason").isNull()
    return x.select(
        *kept, F.when(F.col("page_reason").isNull(), "item").otherwise("page").alias("level"), "pos", "reason",
        F.when(ok, bad).alias("bad_fields"),
        F.when(~ok, F.when(F.col("page_reason").isNotNull(), F.col("value")).otherwise(F.to_json("x"))).alias("raw"),
        F.when(ok, F.struct(*record)).alias("record"))


def checked_tokens(pages: DataFrame) -> DataFrame:
    """S1 with quarantine: a token needs an address."""
    f = lambda c: F.col(f"x.{c}")
    record = [f("address").alias("token_address"), *[f(c) for c in ("logo_uri", "name", "symbol")],
              *[f(c).try_cast("double").alias(c) for c in jp.TOKEN_NUMERIC], *[f(c).try_cast("long").alias(c) for c in jp.TOKEN_INTS],
              *[f(f"extensions.{c}").alias(c) for c in jp.EXTENSIONS]]
    numbers = [(c, f(c), "double") for c in jp.TOKEN_NUMERIC] + [(c, f(c), "long") for c in jp.TOKEN_INTS]
    return _checked(pages, jp.TOKEN_PAGE, lambda p: F.coalesce(p["data"]["tokens"], p["data"]["items"]),
                    [(_is_blank(f("address")), "no address")], record, numbers)


def checked_holders(pages: DataFrame) -> DataFrame:
    """S2 with quarantine: a holder needs an owner; the rank counts rejected rows too."""
    f = lambda c: F.col(f"x.{c}")
    record = [f("owner").alias("wallet_address"), (F.col("pos") + 1).alias("rank"), f("amount"),
              F.coalesce(f("ui_amount").try_cast("double"), F.lit(0.0)).alias("ui_amount"),
              F.coalesce(f("decimals").try_cast("int"), F.lit(9)).alias("decimals"), f("mint"), f("token_account")]
    return _checked(pages, jp.HOLDER_PAGE, lambda p: p["data"]["items"], [(_is_blank(f("owner")), "no owner")], record,
                    [("ui_amount", f("ui_amount"), "double"), ("decimals", f("decimals"), "int")])


def _tx_list(page: Column) -> Column:
    as_obj = F.from_json(page["data"], jp.TX_DATA_OBJ)
    return F.when(F.trim(page["data"]).startswith("["), F.from_json(page["data"], ArrayType(jp.TX_ITEM))).otherwise(
        F.coalesce(as_obj["items"], as_obj["trades"]))


def checked_transactions(pages: DataFrame, wallet_needed: bool = False) -> DataFrame:
    """S3 (and with ``wallet_needed`` S4) with quarantine: a transaction needs a hash, a wallet's history
    also the wallet."""
    f = lambda c: F.col(f"x.{c}")
    faults = [(_is_blank(f("tx_hash")), "no hash")] + ([(_is_blank(f("owner")), "no wallet")] if wallet_needed else [])
    numbers = [("block_unix_time", f("block_unix_time"), "long")]
    numbers += [(f"{s}.{c}", f(f"{s}.{c}"), "double") for s in ("base", "quote") for c in ("ui_change_amount", "nearest_price")]
    return _checked(pages, jp.TX_PAGE_RAW, _tx_list, faults, jp._tx_cols("x"), numbers)


def checked_payloads(payloads: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """S5 with quarantine: ``payloads`` with the event's columns and the reason why a push says nothing
    about a transaction (null: it does). One parse gives both."""
    v = F.col("_v")
    first = F.try_variant_get(v, "$[0]", "variant")
    reason = (F.when(F.col(payload).isNull() | (F.trim(payload) == ""), "empty payload")
              .when(v.isNull(), "malformed payload")
              .when(F.try_variant_get(v, "$", "array<variant>").isNull(), "not an array")
              .when(first.isNull(), "empty array")
              .when(F.try_variant_get(v, "$[0].signature", "string").isNull(), "no signature"))
    from cairn.sources.variant_pages import event_fields
    return payloads.withColumn("_v", F.try_parse_json(payload)).select(*payloads.columns, *event_fields(v), reason.alias("reason"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select("record.*")


def rejects(checked: DataFrame) -> DataFrame:
    """What was set aside, with the columns carried from the page."""
    carried = [c for c in checked.columns if c not in ("bad_fields", "record")]
    return checked.where(F.col("reason").isNotNull()).select(*carried)


def observed(checked: DataFrame, observation: Observation) -> DataFrame:
    """The frame with its outcome counts observed by whatever job runs it: no job of their own."""
    bad = F.col("reason").isNotNull()
    return checked.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(~bad).alias("accepted"),
                           F.count_if(bad & (F.col("level") == "item")).alias("rejected_items"),
                           F.count_if(bad & (F.col("level") == "page")).alias("rejected_pages"),
                           F.count_if(F.size("bad_fields") > 0).alias("with_bad_fields"))


def land(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """(accepted, rejects, counts): one job writes both outcomes as partitions of one folder and counts
    them; both frames read only their own partition."""
    seen = Observation()
    out = observed(checked, seen).withColumn("outcome", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
    out.write.partitionBy("outcome").parquet(path)
    back = checked.sparkSession.read.schema(out.schema).parquet(path)
    return (accepted(back.where("outcome = 'accepted'")), rejects(back.where("outcome = 'rejected'")).drop("outcome"), seen.get)
