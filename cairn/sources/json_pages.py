"""Landed API pages and pushed events -> flat rows.

Input is a DataFrame with one raw JSON document per row in column ``value``
(``spark.read.text(path)`` on JSON-lines files, or ``wholetext=True`` for one
document per file). Parsing is ``from_json`` with explicit schemas, arrays
are exploded, numbers are read as text and ``try_cast`` so that numeric
strings and bad values behave like the reference's guarded ``float(...)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

S = StringType()

# Field names of the market-data API pages.
TOKEN_NUMERIC = ["market_cap", "fdv", "liquidity",
                 "volume_1h_usd", "volume_1h_change_percent", "volume_2h_usd", "volume_2h_change_percent",
                 "volume_4h_usd", "volume_4h_change_percent", "volume_8h_usd", "volume_8h_change_percent",
                 "volume_24h_usd", "volume_24h_change_percent", "price",
                 "price_change_1h_percent", "price_change_2h_percent", "price_change_4h_percent",
                 "price_change_8h_percent", "price_change_24h_percent"]
TOKEN_INTS = ["decimals", "last_trade_unix_time", "trade_1h_count", "trade_2h_count", "trade_4h_count",
              "trade_8h_count", "trade_24h_count", "holder", "recent_listing_time"]
EXTENSIONS = ["coingecko_id", "serum_v3_usdc", "serum_v3_usdt", "website", "telegram", "twitter",
              "description", "discord", "medium"]
SIDE_FIELDS = ["symbol", "address", "type_swap", "ui_change_amount", "nearest_price"]


def _struct(names, extra=()) -> StructType:
    return StructType([StructField(n, S) for n in names] + list(extra))


TOKEN_ITEM = _struct(["address", "logo_uri", "name", "symbol"] + TOKEN_NUMERIC + TOKEN_INTS,
                     [StructField("extensions", _struct(EXTENSIONS))])
TOKEN_PAGE = StructType([StructField("success", S), StructField("data", StructType([
    StructField("tokens", ArrayType(TOKEN_ITEM)), StructField("items", ArrayType(TOKEN_ITEM))]))])

HOLDER_ITEM = _struct(["owner", "amount", "ui_amount", "decimals", "mint", "token_account"])
HOLDER_PAGE = StructType([StructField("success", S), StructField("data", StructType([
    StructField("items", ArrayType(HOLDER_ITEM))]))])

SIDE = _struct(SIDE_FIELDS)
TX_ITEM = _struct(["tx_hash", "block_unix_time", "tx_type", "source", "owner"],
                  [StructField("base", SIDE), StructField("quote", SIDE)])
TX_PAGE_RAW = StructType([StructField("success", S), StructField("data", S)])
TX_DATA_OBJ = StructType([StructField("items", ArrayType(TX_ITEM)), StructField("trades", ArrayType(TX_ITEM))])

EVENT_ITEM = StructType([
    StructField("signature", S), StructField("type", S),
    StructField("accountData", ArrayType(_struct(["account"]))),
    StructField("tokenTransfers", ArrayType(_struct(["mint"])))])


def _ok(page: Column) -> Column:
    """A page counts unless success is explicitly false; it needs data."""
    succ = F.lower(F.coalesce(page["success"], F.lit("true")))
    return (succ != "false") & page["data"].isNotNull()


def normalize_tokens(pages: DataFrame) -> DataFrame:
    """Token-list pages -> bronze token rows. The list is data.tokens,
    else data.items; numbers cast with null kept; extensions flattened (null
    when absent); rows without an address dropped."""
    p = pages.select(F.from_json("value", TOKEN_PAGE).alias("p"))
    items = F.coalesce(F.col("p.data.tokens"), F.col("p.data.items"))
    t = p.where(_ok(F.col("p"))).select(F.explode(items).alias("t"))
    cols = [F.col("t.address").alias("token_address"), F.col("t.logo_uri").alias("logo_uri"),
            F.col("t.name").alias("name"), F.col("t.symbol").alias("symbol")]
    cols += [F.col(f"t.{c}").try_cast("double").alias(c) for c in TOKEN_NUMERIC]
    cols += [F.col(f"t.{c}").try_cast("long").alias(c) for c in TOKEN_INTS]
    cols += [F.col(f"t.extensions.{c}").alias(c) for c in EXTENSIONS]
    out = t.select(*cols)
    return out.where(F.col("token_address").isNotNull() & (F.col("token_address") != ""))


def normalize_holders(pages: DataFrame) -> DataFrame:
    """Holder pages -> rows with rank = position in the page + 1
    (counted before bad rows are dropped); ui_amount null -> 0.0; decimals
    default 9; empty owners dropped."""
    p = pages.select(F.from_json("value", HOLDER_PAGE).alias("p"))
    h = p.where(_ok(F.col("p"))).select(F.posexplode("p.data.items").alias("pos", "h"))
    out = h.select(
        F.col("h.owner").alias("wallet_address"), (F.col("pos") + 1).alias("rank"),
        F.col("h.amount").alias("amount"),
        F.coalesce(F.col("h.ui_amount").try_cast("double"), F.lit(0.0)).alias("ui_amount"),
        F.coalesce(F.col("h.decimals").try_cast("int"), F.lit(9)).alias("decimals"),
        F.col("h.mint").alias("mint"), F.col("h.token_account").alias("token_account"))
    return out.where(F.col("wallet_address").isNotNull() & (F.col("wallet_address") != ""))


def successful_pages(pages: DataFrame) -> DataFrame:
    """The landed pages (column ``value``, others kept) that count as fetched."""
    return pages.where(_ok(F.from_json("value", TX_PAGE_RAW)))


def _tx_cols(prefix: str = "x") -> list[Column]:
    cols = [F.col(f"{prefix}.tx_hash").alias("transaction_hash"),
            F.col(f"{prefix}.block_unix_time").try_cast("long").alias("block_unix_time"),
            F.col(f"{prefix}.tx_type").alias("tx_type"), F.col(f"{prefix}.source").alias("source"),
            F.col(f"{prefix}.owner").alias("owner")]
    for side in ("base", "quote"):
        for f in SIDE_FIELDS:
            c = F.col(f"{prefix}.{side}.{f}")
            if f in ("ui_change_amount", "nearest_price"):
                c = c.try_cast("double")
            cols.append(c.alias(f"{side}_{f}"))
    return cols


def _tx_items(pages: DataFrame) -> DataFrame:
    p = pages.select(F.from_json("value", TX_PAGE_RAW).alias("p")).where(_ok(F.col("p")))
    as_list = F.from_json(F.col("p.data"), ArrayType(TX_ITEM))
    as_obj = F.from_json(F.col("p.data"), TX_DATA_OBJ)
    is_list = F.trim(F.col("p.data")).startswith("[")
    items = F.when(is_list, as_list).otherwise(F.coalesce(as_obj["items"], as_obj["trades"]))
    return p.select(F.explode(items).alias("x"))


def normalize_transactions(pages: DataFrame) -> DataFrame:
    """S3: transaction pages: data itself when a list, else data.items, else
    data.trades; sides flattened; unix time kept; empty hashes dropped."""
    out = _tx_items(pages).select(*_tx_cols())
    return out.where(F.col("transaction_hash").isNotNull() & (F.col("transaction_hash") != ""))


def normalize_seek_by_time(pages: DataFrame) -> DataFrame:
    """Wallet history pages: wallet = owner, block time (0/null -> null)
    as UTC timestamp; a row needs both hash and wallet."""
    out = _tx_items(pages).select(*_tx_cols())
    t = F.nullif(F.col("block_unix_time"), F.lit(0))
    # naive UTC time from epoch seconds, independent of the session zone
    out = out.withColumns({
        "wallet_address": F.col("owner"),
        "timestamp": F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), t.cast("decimal(18,6)")),
    })
    ok = (F.col("transaction_hash").isNotNull() & (F.col("transaction_hash") != "")
          & F.col("wallet_address").isNotNull() & (F.col("wallet_address") != ""))
    return out.where(ok)


def extract_event(payload: Column) -> list[Column]:
    """Pushed payload (a JSON array) -> signature, type (default
    UNKNOWN), first account, first token mint. Non-arrays, empty arrays and
    invalid JSON give nulls and UNKNOWN."""
    arr = F.when(F.trim(payload).startswith("["), F.from_json(payload, ArrayType(EVENT_ITEM)))
    first = F.try_element_at(arr, F.lit(1))
    return [
        first["signature"].alias("transaction_signature"),
        F.coalesce(first["type"], F.lit("UNKNOWN")).alias("webhook_type"),
        F.try_element_at(first["accountData"], F.lit(1))["account"].alias("account_address"),
        F.try_element_at(first["tokenTransfers"], F.lit(1))["mint"].alias("token_address"),
    ]


def event_id(payload: Column, delivery: Column | None = None) -> Column:
    """Id of one delivered push: hash of the payload and, if given, of where it
    was delivered (file and occurrence, or broker partition and offset), so
    that a replay gives the same id and equal payloads pushed twice two ids."""
    return F.sha2(payload if delivery is None else F.concat_ws("\n", payload, delivery), 256)


def read_json_drop(spark, path: str, done: DataFrame | None = None, documents: str = "files") -> tuple[DataFrame, DataFrame]:
    """S10 (batch form): the pending files of a folder, one JSON document per
    file (``documents="files"``, names ending in .json) or per line (``"lines"``)
    -> (valid documents, rejects with the file name). ``done`` (column
    ``file``) holds the files of earlier calls, which are left out before
    their text is read into any result; append the returned ``file`` columns
    to it. A document that does not parse is set aside, not fatal. Spark lists and
    reads the folder; the micro-batch form (at most so many files at a time)
    is ``streaming.ingest``."""
    reader = spark.read if documents == "lines" else spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json")
    docs = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    if done is not None:
        docs = docs.join(done.select("file").distinct(), "file", "left_anti").select("value", "file")
    ok = F.try_parse_json("value").isNotNull() & (F.trim("value") != "")
    return docs.where(ok), docs.where(~ok)
