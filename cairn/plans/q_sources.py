"""Registered queries for the JSON sources: pages are generated from the
fixture projections with to_json (bounded page sizes), normalized back, and
checked against the flat projection they came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.plans import fixtures as fx
from cairn.plans.registry import register
from cairn.sources import json_pages as jp

W = fx.with_ctes


# --------------------------------------------------------------------- tokens
def token_pages(spark, sf_dir):
    t = fx.tokens_fx(spark, sf_dir)
    item = F.struct(
        F.when(F.col("p_partkey") % 11 == 0, F.lit("")).otherwise(F.col("token_address")).alias("address"),
        "name", "symbol", "liquidity", "volume_1h_usd", "volume_24h_usd", "price",
        "price_change_2h_percent", "price_change_24h_percent", "market_cap", "holder", "trade_24h_count",
        F.when(F.col("p_partkey") % 2 == 0,
               F.struct(F.concat(F.lit("https://"), F.col("symbol")).alias("website"))).alias("extensions"))
    pages = t.groupBy((F.col("p_partkey") / 50).cast("long").alias("page")).agg(
        F.collect_list(item).alias("items"))
    data = F.struct(F.when(F.col("page") % 2 == 0, F.col("items")).alias("tokens"),
                    F.when(F.col("page") % 2 == 1, F.col("items")).alias("items"))
    succ = F.when(F.col("page") % 9 == 4, F.lit(False)).otherwise(F.lit(True))
    return pages.select(F.to_json(F.struct(succ.alias("success"), data.alias("data"))).alias("value"))


@register("normalize_tokens", W(fx.TOKENS_FX_SQL) + """
SELECT token_address, name, symbol, liquidity, volume_1h_usd, volume_24h_usd, price, price_change_2h_percent,
       price_change_24h_percent, market_cap, CAST(holder AS BIGINT) AS holder,
       CAST(trade_24h_count AS BIGINT) AS trade_24h_count,
       CASE WHEN p_partkey % 2 = 0 THEN 'https://' || symbol END AS website
FROM tokens_fx WHERE (p_partkey // 50) % 9 <> 4 AND p_partkey % 11 <> 0""")
def q_normalize_tokens(spark, sf_dir):
    n = jp.normalize_tokens(token_pages(spark, sf_dir))
    return n.select("token_address", "name", "symbol", "liquidity", "volume_1h_usd", "volume_24h_usd", "price",
                    "price_change_2h_percent", "price_change_24h_percent", "market_cap", "holder",
                    "trade_24h_count", "website")


# -------------------------------------------------------------------- holders
def holder_pages(spark, sf_dir):
    h = fx.holders_fx(spark, sf_dir)
    item = F.struct(
        "rank",
        F.when(F.col("rank") % 97 == 0, F.lit("")).otherwise(F.col("wallet_address")).alias("owner"),
        "amount",
        F.when(F.col("rank") % 13 == 0, F.lit(None)).otherwise(F.col("ui_amount")).alias("ui_amount"),
        F.when(F.col("rank") % 5 == 0, F.lit(None)).otherwise(F.lit(6)).alias("decimals"),
        F.col("token_address").alias("mint"))
    pages = h.groupBy("token_address", ((F.col("rank") - 1) / 100).cast("long").alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    return pages.select(F.to_json(F.struct(F.lit(True).alias("success"),
                                           F.struct(F.col("items").alias("items")).alias("data"))).alias("value"))


@register("normalize_holders", W(fx.HOLDERS_FX_SQL) + """
SELECT wallet_address, CAST((rank - 1) % 100 + 1 AS INTEGER) AS rank, amount,
       CASE WHEN rank % 13 = 0 THEN 0.0 ELSE ui_amount END AS ui_amount,
       CASE WHEN rank % 5 = 0 THEN 9 ELSE 6 END AS decimals, token_address AS mint
FROM holders_fx WHERE rank % 97 <> 0""")
def q_normalize_holders(spark, sf_dir):
    n = jp.normalize_holders(holder_pages(spark, sf_dir))
    return n.select("wallet_address", "rank", "amount", "ui_amount", "decimals", "mint")


# --------------------------------------------------------------- transactions
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def tx_pages(spark, sf_dir):
    s = fx.swaps_fx(spark, sf_dir).withColumn(
        "eid", F.substring("transaction_hash", 3, 12).cast("long"))
    secs = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("timestamp"))
    side = lambda p: F.struct(*[F.col(f"{p}_{f}").alias(f) for f in jp.SIDE_FIELDS])
    item = F.struct(
        F.col("transaction_hash").alias("tx_hash"),
        F.when(F.col("eid") % 23 == 0, F.lit(0)).otherwise(secs).alias("block_unix_time"),
        "tx_type", "source", F.col("wallet_address").alias("owner"),
        side("base").alias("base"), side("quote").alias("quote"))
    pages = s.groupBy("wallet_address", (F.col("eid") / 100).cast("long").alias("page")).agg(
        F.collect_list(item).alias("items"))
    shape = F.col("page") % 3
    data = (F.when(shape == 0, F.to_json("items"))
            .when(shape == 1, F.to_json(F.struct(F.col("items").alias("items"))))
            .otherwise(F.to_json(F.struct(F.col("items").alias("trades")))))
    return pages.select(F.to_json(F.struct(F.lit(True).alias("success"), data.alias("data"))).alias("value"))


TX_FLAT_SQL = """tx_flat AS (
  SELECT transaction_hash, CASE WHEN CAST(substr(transaction_hash, 3) AS BIGINT) % 23 = 0 THEN 0
              ELSE epoch_us("timestamp") // 1000000 END AS block_unix_time,
         tx_type, source, wallet_address AS owner,
         base_symbol, base_address, base_type_swap, base_ui_change_amount, base_nearest_price,
         quote_symbol, quote_address, quote_type_swap, quote_ui_change_amount, quote_nearest_price
  FROM swaps_fx)"""


@register("normalize_transactions", W(fx.SWAPS_FX_SQL, TX_FLAT_SQL) + "SELECT * FROM tx_flat")
def q_normalize_transactions(spark, sf_dir):
    return jp.normalize_transactions(tx_pages(spark, sf_dir))


@register("normalize_seek_by_time", W(fx.SWAPS_FX_SQL, TX_FLAT_SQL) + """
SELECT *, owner AS wallet_address,
       CASE WHEN block_unix_time = 0 THEN NULL ELSE TIMESTAMP '1970-01-01 00:00:00' + to_seconds(block_unix_time) END
         AS "timestamp"
FROM tx_flat""")
def q_normalize_seek_by_time(spark, sf_dir):
    return jp.normalize_seek_by_time(tx_pages(spark, sf_dir))


# --------------------------------------------------------------------- events
def event_payloads(spark, sf_dir):
    w = fx.webhooks_fx(spark, sf_dir)
    body = F.to_json(F.array(F.struct(
        F.col("transaction_signature").alias("signature"), F.col("webhook_type").alias("type"),
        F.array(F.struct(F.col("account_address").alias("account"))).alias("accountData"),
        F.array(F.struct(F.col("token_address").alias("mint"))).alias("tokenTransfers"))))
    i = F.col("webhook_id")
    payload = (F.when(i % 13 == 0, F.lit("{}")).when(i % 17 == 0, F.lit("[]"))
               .when(i % 19 == 0, F.lit("[{}]")).when(i % 23 == 0, F.lit("not json"))
               .otherwise(body))
    return w.select("webhook_id", payload.alias("raw_payload"))


@register("extract_event", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id,
       CASE WHEN odd THEN NULL ELSE transaction_signature END AS transaction_signature,
       CASE WHEN odd THEN 'UNKNOWN' ELSE COALESCE(webhook_type, 'UNKNOWN') END AS webhook_type,
       CASE WHEN odd THEN NULL ELSE account_address END AS account_address,
       CASE WHEN odd THEN NULL ELSE token_address END AS token_address
FROM (SELECT *, webhook_id % 13 = 0 OR webhook_id % 17 = 0 OR webhook_id % 19 = 0 OR webhook_id % 23 = 0 AS odd
      FROM webhooks_fx) x""")
def q_extract_event(spark, sf_dir):
    p = event_payloads(spark, sf_dir)
    return p.select("webhook_id", *jp.extract_event(F.col("raw_payload")))
