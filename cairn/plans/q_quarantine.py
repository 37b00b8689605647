"""Registered queries of the quarantine (M11 over S1-S5) and of the VARIANT sources (S3, S5). Pages are
made from the fixture projections, with faults in known pages and items."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn.plans import fixtures as fx
from cairn.plans.q_sources import TX_FLAT_SQL, event_payloads, tx_pages
from cairn.plans.registry import ORACLE, register
from cairn.sources import quarantine as qu
from cairn.sources import variant_pages as vp
from cairn.sources.json_pages import SIDE_FIELDS

W = fx.with_ctes


def _page(items, page, key):
    """Documents of (key, page): page % 10 is 3 cut short, 4 unsuccessful, 5 without data, 6 without a
    list, 7 with an empty one."""
    fault = F.col(page) % 10
    listed = F.when(fault == 7, F.lit("[]")).otherwise(F.to_json(items))
    data = F.when(fault == 6, F.lit('{"other":1}')).otherwise(F.concat(F.lit(f'{{"{key}":'), listed, F.lit("}")))
    doc = F.concat(F.lit('{"success":'), F.when(fault == 4, "false").otherwise("true"),
                   F.when(fault == 5, F.lit("")).otherwise(F.concat(F.lit(',"data":'), data)), F.lit("}"))
    return F.when(fault == 3, F.substring(doc, F.lit(1), F.length(doc) - 4)).otherwise(doc)


def faulty_token_pages(spark, sf_dir):
    t = fx.tokens_fx(spark, sf_dir)
    k = F.col("p_partkey")
    item = F.struct(F.when(k % 11 == 0, F.lit("")).otherwise(F.col("token_address")).alias("address"), "name", "symbol",
                    F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"))
    pages = t.groupBy((k / 50).cast("long").alias("page")).agg(F.sort_array(F.collect_list(F.struct("p_partkey", item.alias("x")))).alias("xs"))
    return pages.select("page", _page(F.transform("xs", lambda e: e["x"]), "page", "tokens").alias("value"))


def faulty_tx_pages(spark, sf_dir):
    s = fx.swaps_fx(spark, sf_dir).withColumn("eid", F.substring("transaction_hash", 3, 12).cast("long"))
    side = lambda p: F.struct(*[F.col(f"{p}_{f}").alias(f) for f in SIDE_FIELDS])
    item = F.struct(F.when(F.col("eid") % 31 == 0, F.lit("")).otherwise(F.col("transaction_hash")).alias("tx_hash"), F.lit(1).alias("block_unix_time"),
                    "tx_type", "source", F.when(F.col("eid") % 17 != 0, F.col("wallet_address")).alias("owner"), side("base").alias("base"), side("quote").alias("quote"))
    pages = s.groupBy((F.col("eid") / 100).cast("long").alias("page")).agg(F.sort_array(F.collect_list(F.struct("eid", item.alias("x")))).alias("xs"))
    return pages.select("page", _page(F.transform("xs", lambda e: e["x"]), "page", "trades").alias("value"))


_PAGE_REASON = "CASE page % 10 WHEN 3 THEN 'malformed document' WHEN 4 THEN 'unsuccessful page' WHEN 5 THEN 'no data' WHEN 6 THEN 'no list' END"
_OUTCOMES = W(fx.TOKENS_FX_SQL, fx.SWAPS_FX_SQL, f"""items AS (
  SELECT 'tokens' AS kind, p_partkey // 50 AS page, p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN 'no address' END AS reason, p_partkey % 7 = 0 AS odd FROM tokens_fx
  UNION ALL
  SELECT 'transactions', eid // 100, eid, CASE WHEN eid % 31 = 0 THEN 'no hash' WHEN eid % 17 = 0 THEN 'no wallet' END, false
  FROM (SELECT CAST(substr(transaction_hash, 3) AS BIGINT) AS eid FROM swaps_fx) s),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY kind, page ORDER BY k) - 1 AS INTEGER) AS pos FROM items),
checked AS (
  SELECT kind, page, 'page' AS level, CAST(NULL AS INTEGER) AS pos, {_PAGE_REASON} AS reason, false AS odd FROM (SELECT DISTINCT kind, page FROM items) p WHERE page % 10 IN (3, 4, 5, 6)
  UNION ALL SELECT kind, page, 'item', pos, reason, odd FROM placed WHERE page % 10 NOT IN (3, 4, 5, 6, 7))""")


def _both(spark, sf_dir):
    return {"tokens": qu.checked_tokens(faulty_token_pages(spark, sf_dir)),
            "transactions": qu.checked_transactions(faulty_tx_pages(spark, sf_dir), wallet_needed=True)}


@register("page_rejects", _OUTCOMES + "SELECT kind, page, level, pos, reason FROM checked WHERE reason IS NOT NULL")
def q_page_rejects(spark, sf_dir):
    t, x = (qu.rejects(c).select(F.lit(kind).alias("kind"), "page", "level", "pos", "reason") for kind, c in _both(spark, sf_dir).items())
    return t.unionByName(x)


@register("landing_outcomes", _OUTCOMES + """
SELECT kind, COUNT(*) AS rows, COUNT(*) FILTER (WHERE reason IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE level = 'item' AND reason IS NOT NULL) AS rejected_items, COUNT(*) FILTER (WHERE level = 'page') AS rejected_pages,
       COUNT(*) FILTER (WHERE reason IS NULL AND odd) AS with_bad_fields, COUNT(*) FILTER (WHERE reason IS NULL) AS landed,
       COUNT(*) FILTER (WHERE reason IS NOT NULL) AS set_aside
FROM checked GROUP BY kind""")
def q_landing_outcomes(spark, sf_dir):
    """Lands both kinds (one job each while the plan is built): the counts observed by the write, next to
    the rows that are then found in the two outcomes."""
    from cairn.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cairn-landing-{uuid.uuid4().hex}"
    out = None
    for kind, checked in _both(spark, sf_dir).items():
        ok, bad, counts = qu.land(checked, f"{base}/{kind}")
        found = ok.select(F.lit(1).alias("l"), F.lit(0).alias("s")).unionAll(bad.select(F.lit(0), F.lit(1)))
        found = found.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("landed"), F.coalesce(F.sum("s"), F.lit(0)).alias("set_aside"))
        row = found.select(F.lit(kind).alias("kind"), *[F.lit(counts[c]).cast("long").alias(c) for c in ("rows", "accepted", "rejected_items", "rejected_pages", "with_bad_fields")], "landed", "set_aside")
        out = row if out is None else out.unionByName(row)
    return out


@register("payload_rejects", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id, CASE WHEN webhook_id % 13 = 0 THEN 'not an array' WHEN webhook_id % 17 = 0 THEN 'empty array'
       WHEN webhook_id % 19 = 0 THEN 'no signature' WHEN webhook_id % 23 = 0 THEN 'malformed payload' ELSE 'no signature' END AS reason
FROM webhooks_fx
WHERE webhook_id % 13 = 0 OR webhook_id % 17 = 0 OR webhook_id % 19 = 0 OR webhook_id % 23 = 0 OR transaction_signature IS NULL""")
def q_payload_rejects(spark, sf_dir):
    return qu.checked_payloads(event_payloads(spark, sf_dir)).where(F.col("reason").isNotNull()).select("webhook_id", "reason")


# --------------------------------------------------------------- VARIANT
def extended_tx_pages(spark, sf_dir):
    """The transaction pages with fields no schema names: ``slot`` on every item, ``memo`` on some, and a
    ``fee`` on the base side; a third of the pages has its data as a string."""
    s = fx.swaps_fx(spark, sf_dir).withColumn("eid", F.substring("transaction_hash", 3, 12).cast("long"))
    secs = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("timestamp"))
    side = lambda p, *more: F.struct(*[F.col(f"{p}_{f}").alias(f) for f in SIDE_FIELDS], *more)
    item = F.struct(
        F.col("transaction_hash").alias("tx_hash"), F.when(F.col("eid") % 23 == 0, F.lit(0)).otherwise(secs).alias("block_unix_time"),
        "tx_type", "source", F.col("wallet_address").alias("owner"), side("base", (F.col("eid") % 7).alias("fee")).alias("base"), side("quote").alias("quote"),
        F.col("eid").alias("slot"), F.when(F.col("eid") % 4 == 0, F.struct((F.col("eid") % 5).alias("n"))).alias("memo"))
    pages = s.groupBy("wallet_address", (F.col("eid") / 100).cast("long").alias("page")).agg(F.collect_list(item).alias("items"))
    shape = F.col("page") % 3
    data = (F.when(shape == 0, F.to_json("items")).when(shape == 1, F.to_json(F.struct(F.col("items").alias("items"))))
            .otherwise(F.to_json(F.struct(F.col("items").alias("trades")))))
    as_text = F.to_json(F.struct(F.lit(True).alias("success"), data.alias("data")))
    return pages.select(F.when(shape == 1, as_text).otherwise(F.concat(F.lit('{"success":true,"data":'), data, F.lit("}"))).alias("value"))


@register("normalize_transactions_variant", W(fx.SWAPS_FX_SQL, TX_FLAT_SQL) + """
SELECT *, CAST(substr(transaction_hash, 3) AS BIGINT) AS slot, CAST(substr(transaction_hash, 3) AS BIGINT) % 7 AS base_fee,
       CASE WHEN CAST(substr(transaction_hash, 3) AS BIGINT) % 4 = 0 THEN CAST(substr(transaction_hash, 3) AS BIGINT) % 5 END AS memo_n
FROM tx_flat""")
def q_normalize_transactions_variant(spark, sf_dir):
    t = vp.transactions_from_variant(extended_tx_pages(spark, sf_dir))
    extra = F.parse_json("extra_fields")
    return t.select(*[c for c in t.columns if c != "extra_fields"], F.variant_get(extra, "$.slot", "bigint").alias("slot"),
                    F.variant_get(extra, "$['base.fee']", "bigint").alias("base_fee"), F.variant_get(extra, "$.memo.n", "bigint").alias("memo_n"))


@register("extract_event_variant", ORACLE["extract_event"])
def q_extract_event_variant(spark, sf_dir):
    return vp.events_from_variant(event_payloads(spark, sf_dir)).drop("raw_payload")


@register("page_shapes", W(fx.SWAPS_FX_SQL) + """
SELECT CASE page % 3 WHEN 0 THEN 'list' WHEN 1 THEN 'items' ELSE 'trades' END AS shape, COUNT(*) AS pages, CAST(SUM(n) AS BIGINT) AS items
FROM (SELECT wallet_address, CAST(substr(transaction_hash, 3) AS BIGINT) // 100 AS page, COUNT(*) AS n FROM swaps_fx GROUP BY 1, 2) p GROUP BY 1""")
def q_page_shapes(spark, sf_dir):
    return vp.page_shapes(tx_pages(spark, sf_dir))
