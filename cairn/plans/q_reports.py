"""Registered report queries (A3-A18, W5, L3, L4, Q1-Q3, J1-J3, J6) with oracle SQL."""

from __future__ import annotations


from cairn.functions.expr import sql_round as R
from cairn.functions.expr import ts_ntz
from cairn.operators import reports as rp
from cairn.plans import fixtures as fx
from cairn.plans.registry import ORACLE, QUERIES, register
from cairn.plans.sql_pnl import WALLET_PNL_SQL

W = fx.with_ctes
NOW_HEALTH = "2024-01-31 00:00:00"


def _pct(n: str, total: str) -> str:
    return R(f"CAST({n} AS DOUBLE) * 100.0 / CAST({total} AS DOUBLE)", 2)


# --------------------------------------------------------------- A3 status
@register("status_tokens", W(fx.TOKENS_FX_SQL) + """
SELECT COUNT(token_address) AS total, COUNT(DISTINCT token_address) AS distinct_keys,
       COUNT(*) FILTER (WHERE silver_processed = true) AS silver_processed_true,
       COUNT(*) FILTER (WHERE silver_processed = false) AS silver_processed_false,
       MIN(silver_processed_at) AS min_silver_processed_at, MAX(silver_processed_at) AS max_silver_processed_at
FROM tokens_fx""")
def q_status_tokens(spark, sf_dir):
    return rp.status_counts(fx.tokens_fx(spark, sf_dir), "token_address", ["silver_processed"],
                            ["silver_processed_at"])


@register("status_holders", W(fx.HOLDERS_FX_SQL) + """
SELECT COUNT(token_address) AS total, COUNT(DISTINCT token_address || ':' || wallet_address) AS distinct_keys,
       COUNT(*) FILTER (WHERE silver_processed = true) AS silver_processed_true,
       COUNT(*) FILTER (WHERE silver_processed = false) AS silver_processed_false,
       MIN(fetched_at) AS min_fetched_at, MAX(fetched_at) AS max_fetched_at
FROM holders_fx""")
def q_status_holders(spark, sf_dir):
    return rp.status_counts(fx.holders_fx(spark, sf_dir), ["token_address", "wallet_address"],
                            ["silver_processed"], ["fetched_at"])


@register("status_wallets", W(fx.WALLETS_FX_SQL) + """
SELECT COUNT(wallet_address) AS total, COUNT(DISTINCT wallet_address) AS distinct_keys,
       COUNT(*) FILTER (WHERE transactions_processed = true) AS transactions_processed_true,
       COUNT(*) FILTER (WHERE transactions_processed = false) AS transactions_processed_false,
       COUNT(*) FILTER (WHERE pnl_processed = true) AS pnl_processed_true,
       COUNT(*) FILTER (WHERE pnl_processed = false) AS pnl_processed_false,
       MIN(transactions_processed_at) AS min_transactions_processed_at,
       MAX(transactions_processed_at) AS max_transactions_processed_at
FROM wallets_fx""")
def q_status_wallets(spark, sf_dir):
    return rp.status_counts(fx.wallets_fx(spark, sf_dir), "wallet_address",
                            ["transactions_processed", "pnl_processed"], ["transactions_processed_at"])


@register("status_transactions", W(fx.SWAPS_FX_SQL) + """
SELECT COUNT(transaction_hash) AS total, COUNT(DISTINCT transaction_hash) AS distinct_keys,
       MIN("timestamp") AS min_timestamp, MAX("timestamp") AS max_timestamp
FROM swaps_fx""")
def q_status_transactions(spark, sf_dir):
    return rp.status_counts(fx.swaps_fx(spark, sf_dir), "transaction_hash", [], ["timestamp"])


@register("status_silver_tokens", W(fx.TOKENS_FX_SQL) + """
SELECT COUNT(token_address) AS total, COUNT(DISTINCT token_address) AS distinct_keys, COUNT(DISTINCT symbol) AS distinct_symbol,
       COUNT(DISTINCT name) AS distinct_name,
       CAST(0 AS BIGINT) AS whales_processed_true, COUNT(*) AS whales_processed_false
FROM tokens_fx WHERE silver_processed = false""")
def q_status_silver_tokens(spark, sf_dir):
    from cairn.operators import clean
    rec = clean.silver_token_record(fx.tokens_fx(spark, sf_dir), ts_ntz(fx.NOW_ORDERS))
    return rp.status_counts(rec, "token_address", ["whales_processed"], distinct=["symbol", "name"])


@register("status_wallet_pnl", W(fx.PNL_PRESENT_FX_SQL) + """
SELECT COUNT(wallet_address) AS total, COUNT(DISTINCT wallet_address) AS distinct_keys,
       COUNT(*) FILTER (WHERE gold_processed = true) AS gold_processed_true,
       COUNT(*) FILTER (WHERE gold_processed = false) AS gold_processed_false
FROM pnl_present_fx""")
def q_status_wallet_pnl(spark, sf_dir):
    return rp.status_counts(fx.pnl_present_fx(spark, sf_dir), "wallet_address", ["gold_processed"])


@register("wallet_status", W(fx.WALLETS_FX_SQL) + """
SELECT COUNT(*) AS total_whales, COUNT(*) FILTER (WHERE transactions_processed = true) AS transactions_done,
       COUNT(*) FILTER (WHERE pnl_processed = true) AS pnl_done,
       COUNT(*) FILTER (WHERE transactions_processed = true AND pnl_processed = false) AS ready_for_pnl,
       COUNT(*) FILTER (WHERE pnl_processed = false) AS pnl_pending
FROM wallets_fx""")
def q_wallet_status(spark, sf_dir):
    return rp.wallet_status(fx.wallets_fx(spark, sf_dir))


@register("pnl_summary", f"""WITH pnl AS ({WALLET_PNL_SQL})
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE smart_trader_eligible = true) AS smart_traders,
       {R('AVG(coverage_ratio_percent)', 2)} AS avg_coverage_ratio,
       COUNT(*) FILTER (WHERE calculation_method LIKE '%cost_basis%') AS new_method_records
FROM pnl""")
def q_pnl_summary(spark, sf_dir):
    return rp.pnl_summary(QUERIES["wallet_pnl"](spark, sf_dir))


# ---------------------------------------------------------- events reports
@register("status_share", W(fx.WEBHOOKS_FX_SQL) + f"""
SELECT processing_status, COUNT(*) AS count,
       {_pct('COUNT(*)', '(SELECT COUNT(*) FROM webhooks_fx)')} AS percentage
FROM webhooks_fx GROUP BY processing_status""")
def q_status_share(spark, sf_dir):
    return rp.share_of_total(fx.webhooks_fx(spark, sf_dir), "processing_status")


@register("type_share", W(fx.WEBHOOKS_FX_SQL) + f"""
SELECT webhook_type, COUNT(*) AS count, MIN(webhook_timestamp) AS first_seen, MAX(webhook_timestamp) AS last_seen,
       {_pct('COUNT(*)', '(SELECT COUNT(*) FROM webhooks_fx)')} AS percentage
FROM webhooks_fx WHERE webhook_type IS NOT NULL GROUP BY webhook_type""")
def q_type_share(spark, sf_dir):
    return rp.share_of_total(fx.webhooks_fx(spark, sf_dir), "webhook_type", drop_null=True,
                             times="webhook_timestamp")


@register("event_overview", W(fx.WEBHOOKS_FX_SQL) + """
SELECT COUNT(*) AS total_webhooks, COUNT(DISTINCT webhook_id) AS unique_webhooks,
       COUNT(DISTINCT transaction_signature) AS unique_transactions,
       COUNT(DISTINCT account_address) AS unique_accounts, COUNT(DISTINCT token_address) AS unique_tokens,
       COUNT(DISTINCT webhook_type) AS unique_webhook_types,
       MIN(webhook_timestamp) AS first_webhook, MAX(webhook_timestamp) AS last_webhook,
       MIN(ingested_at) AS first_ingested, MAX(ingested_at) AS last_ingested
FROM webhooks_fx""")
def q_event_overview(spark, sf_dir):
    return rp.event_overview(fx.webhooks_fx(spark, sf_dir))


@register("top_accounts", W(fx.WEBHOOKS_FX_SQL) + """
SELECT account_address, COUNT(*) AS webhook_count, COUNT(DISTINCT webhook_type) AS unique_types,
       COUNT(DISTINCT token_address) AS unique_tokens,
       MIN(webhook_timestamp) AS first_seen, MAX(webhook_timestamp) AS last_seen
FROM webhooks_fx WHERE account_address IS NOT NULL GROUP BY account_address
ORDER BY webhook_count DESC, account_address LIMIT 20""")
def q_top_accounts(spark, sf_dir):
    return rp.top_activity(fx.webhooks_fx(spark, sf_dir), "account_address", "token_address")


@register("top_tokens_activity", W(fx.WEBHOOKS_FX_SQL) + """
SELECT token_address, COUNT(*) AS webhook_count, COUNT(DISTINCT webhook_type) AS unique_types,
       COUNT(DISTINCT account_address) AS unique_accounts,
       MIN(webhook_timestamp) AS first_seen, MAX(webhook_timestamp) AS last_seen
FROM webhooks_fx WHERE token_address IS NOT NULL GROUP BY token_address
ORDER BY webhook_count DESC, token_address LIMIT 20""")
def q_top_tokens_activity(spark, sf_dir):
    return rp.top_activity(fx.webhooks_fx(spark, sf_dir), "token_address", "account_address")


@register("daily_activity", W(fx.WEBHOOKS_FX_SQL) + """
SELECT CAST(webhook_timestamp AS DATE) AS date, COUNT(*) AS webhook_count,
       COUNT(DISTINCT account_address) AS unique_accounts, COUNT(DISTINCT token_address) AS unique_tokens,
       COUNT(DISTINCT webhook_type) AS unique_types
FROM webhooks_fx WHERE webhook_timestamp IS NOT NULL GROUP BY 1 ORDER BY date DESC LIMIT 14""")
def q_daily_activity(spark, sf_dir):
    return rp.daily_activity(fx.webhooks_fx(spark, sf_dir))


@register("hourly_pattern", W(fx.WEBHOOKS_FX_SQL) + """
SELECT CAST(hour(webhook_timestamp) AS INTEGER) AS hour, COUNT(*) AS webhook_count,
       COUNT(DISTINCT account_address) AS unique_accounts, AVG(COUNT(*)) OVER () AS avg_per_hour
FROM webhooks_fx WHERE webhook_timestamp IS NOT NULL GROUP BY 1""")
def q_hourly_pattern(spark, sf_dir):
    return rp.hourly_pattern(fx.webhooks_fx(spark, sf_dir))


@register("recent_events", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id, webhook_type, transaction_signature, account_address, token_address, webhook_timestamp,
       ingested_at, processing_status
FROM webhooks_fx ORDER BY ingested_at DESC NULLS LAST, webhook_id DESC LIMIT 10""")
def q_recent_events(spark, sf_dir):
    return rp.recent_events(fx.webhooks_fx(spark, sf_dir))


@register("sample_payload", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id, webhook_type, transaction_signature, account_address, token_address, raw_payload
FROM webhooks_fx WHERE raw_payload IS NOT NULL AND raw_payload <> '{}'
ORDER BY ingested_at DESC NULLS LAST, webhook_id DESC LIMIT 1""")
def q_sample_payload(spark, sf_dir):
    return rp.sample_payload(fx.webhooks_fx(spark, sf_dir))


def _pct_text(n: str) -> str:
    return f"printf('%.2f%%', {_pct(n, 'total')})"


@register("quality_report", W(fx.WEBHOOKS_FX_SQL) + f""",
a AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE transaction_signature IS NULL) AS no_sig,
             COUNT(*) FILTER (WHERE account_address IS NULL) AS no_account, COUNT(*) FILTER (WHERE token_address IS NULL) AS no_token,
             COUNT(*) FILTER (WHERE raw_payload IS NULL OR raw_payload = '{{}}') AS no_payload FROM webhooks_fx)
SELECT 'Total Records' AS metric, total AS count, 'N/A' AS percentage FROM a
UNION ALL SELECT 'Missing Transaction Signature', no_sig, {_pct_text('no_sig')} FROM a
UNION ALL SELECT 'Missing Account Address', no_account, {_pct_text('no_account')} FROM a
UNION ALL SELECT 'Missing Token Address', no_token, {_pct_text('no_token')} FROM a
UNION ALL SELECT 'Empty Raw Payload', no_payload, {_pct_text('no_payload')} FROM a""")
def q_quality_report(spark, sf_dir):
    return rp.quality_report(fx.webhooks_fx(spark, sf_dir))


@register("health_report", W(fx.WEBHOOKS_FX_SQL) + f""",
a AS (SELECT
  CAST(COUNT(*) FILTER (WHERE ingested_at >= TIMESTAMP '{NOW_HEALTH}' - INTERVAL 1 HOUR) AS DOUBLE) AS h1,
  CAST(COUNT(*) FILTER (WHERE ingested_at >= TIMESTAMP '{NOW_HEALTH}' - INTERVAL 1 DAY) AS DOUBLE) AS d1,
  CAST(COUNT(*) FILTER (WHERE processing_status = 'failed') AS DOUBLE) AS failed,
  CAST(COUNT(*) FILTER (WHERE processing_status = 'pending') AS DOUBLE) AS pending,
  {R(f"AVG(CASE WHEN webhook_timestamp IS NOT NULL AND ingested_at >= TIMESTAMP '{NOW_HEALTH}' - INTERVAL 1 DAY THEN date_diff('microsecond', webhook_timestamp, ingested_at) / 1e6 END)", 2)} AS delay
  FROM webhooks_fx)
SELECT 'Webhooks in last hour' AS metric, h1 AS value FROM a
UNION ALL SELECT 'Webhooks in last 24 hours', d1 FROM a
UNION ALL SELECT 'Failed processing count', failed FROM a
UNION ALL SELECT 'Pending processing count', pending FROM a
UNION ALL SELECT 'Average ingestion delay (seconds)', delay FROM a""")
def q_health_report(spark, sf_dir):
    return rp.health_report(fx.webhooks_fx(spark, sf_dir), ts_ntz(NOW_HEALTH))


_NULL_COLS = ["transaction_signature", "account_address", "webhook_type"]


@register("null_percentage_check", W(fx.WEBHOOKS_FX_SQL) + ",\na AS (SELECT COUNT(*) AS n, "
          + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in _NULL_COLS) + " FROM webhooks_fx)\n"
          + "\nUNION ALL\n".join(
              f"SELECT 'webhooks' AS table_name, 'null_percentage' AS check_type, '{c}' AS column_name, "
              f"(CASE WHEN n > 0 THEN CAST(null_{c} AS DOUBLE) * 100.0 / n ELSE 0.0 END) <= 10.0 AS passed, "
              f"10.0::DOUBLE AS threshold, "
              f"{R(f'CASE WHEN n > 0 THEN CAST(null_{c} AS DOUBLE) * 100.0 / n ELSE 0.0 END', 4)} AS actual_value, "
              f"n AS records_checked, null_{c} AS violations_found FROM a" for c in _NULL_COLS))
def q_null_check(spark, sf_dir):
    return rp.null_percentage_check(fx.webhooks_fx(spark, sf_dir), "webhooks", _NULL_COLS, 10.0)


@register("duplicate_percentage_check", W(fx.HOLDERS_FX_SQL) + f""",
k AS (SELECT wallet_address, COUNT(*) AS c FROM holders_fx GROUP BY 1),
a AS (SELECT SUM(c) AS n, SUM(c - 1) AS dups FROM k)
SELECT 'holders' AS table_name, 'duplicate_percentage' AS check_type, 'wallet_address' AS column_name,
       (CASE WHEN n > 0 THEN CAST(dups AS DOUBLE) * 100.0 / n ELSE 0.0 END) <= 5.0 AS passed,
       5.0::DOUBLE AS threshold,
       {R('CASE WHEN n > 0 THEN CAST(dups AS DOUBLE) * 100.0 / n ELSE 0.0 END', 4)} AS actual_value,
       CAST(COALESCE(n, 0) AS BIGINT) AS records_checked, CAST(COALESCE(dups, 0) AS BIGINT) AS violations_found
FROM a""")
def q_dup_check(spark, sf_dir):
    return rp.duplicate_percentage_check(fx.holders_fx(spark, sf_dir), "holders", ["wallet_address"], 5.0)


# ---------------------------------------------------------- other rollups
@register("symbol_holdings", W(fx.HOLDERS_FX_SQL) + """
SELECT token_symbol, COUNT(DISTINCT wallet_address) AS unique_whales, AVG(ui_amount) AS avg_holding
FROM holders_fx GROUP BY token_symbol""")
def q_symbol_holdings(spark, sf_dir):
    return rp.symbol_holdings(fx.holders_fx(spark, sf_dir))


@register("value_counts_top", W(fx.WEBHOOKS_FX_SQL) + """
SELECT token_address, COUNT(*) AS count FROM webhooks_fx WHERE token_address IS NOT NULL
GROUP BY token_address ORDER BY count DESC, token_address LIMIT 20""")
def q_value_counts_top(spark, sf_dir):
    return rp.value_counts_top(fx.webhooks_fx(spark, sf_dir), "token_address", 20)


@register("value_counts_top_candidates", ORACLE["value_counts_top"])
def q_value_counts_top_candidates(spark, sf_dir):
    from cairn.functions.selection import top_counts
    return top_counts(fx.webhooks_fx(spark, sf_dir), "token_address", 20)


@register("top_accounts_candidates", ORACLE["top_accounts"])
def q_top_accounts_candidates(spark, sf_dir):
    return rp.top_activity_of_candidates(fx.webhooks_fx(spark, sf_dir), "account_address", "token_address")


@register("table_stats")
def q_table_stats(spark, sf_dir):
    """Rows, files and bytes of every given table (sizes are not SQL; tests hold them against a file
    listing)."""
    from cairn.sources.table_files import table_stats
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
              "benchmark", "labels", "conversations")
    return table_stats(spark, {t: f"{sf_dir}/{t}.parquet" for t in tables})


@register("histogram", W(fx.TOKENS_FX_SQL) + """,
v AS (SELECT CAST(liquidity AS DOUBLE) AS x FROM tokens_fx WHERE liquidity IS NOT NULL),
s AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((x - lo) * 30 / (hi - lo)), 29) END AS INTEGER) AS bin,
             lo, hi FROM v, s)
SELECT bin, lo + bin * ((hi - lo) / 30) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30) AS bin_end,
       COUNT(*) AS count
FROM b GROUP BY bin, lo, hi""")
def q_histogram(spark, sf_dir):
    return rp.histogram(fx.tokens_fx(spark, sf_dir), "liquidity", 30)


@register("layer_overview", W(fx.TOKENS_FX_SQL, fx.HOLDERS_FX_SQL, fx.WALLETS_FX_SQL, fx.SWAPS_FX_SQL,
                             fx.WEBHOOKS_FX_SQL) + """
SELECT 'bronze_tokens' AS table_name, COUNT(*) AS row_count FROM tokens_fx
UNION ALL SELECT 'bronze_whales', COUNT(*) FROM holders_fx
UNION ALL SELECT 'silver_whales', COUNT(*) FROM wallets_fx
UNION ALL SELECT 'bronze_transactions', COUNT(*) FROM swaps_fx
UNION ALL SELECT 'bronze_webhook_transactions', COUNT(*) FROM webhooks_fx""")
def q_layer_overview(spark, sf_dir):
    return rp.layer_overview({
        "bronze_tokens": fx.tokens_fx(spark, sf_dir), "bronze_whales": fx.holders_fx(spark, sf_dir),
        "silver_whales": fx.wallets_fx(spark, sf_dir), "bronze_transactions": fx.swaps_fx(spark, sf_dir),
        "bronze_webhook_transactions": fx.webhooks_fx(spark, sf_dir)})


# ------------------------------------------------------- tracking
TRACK = W(fx.WALLETS_FX_SQL, fx.PNL_PRESENT_FX_SQL)
ORDERS_TX = """orders_tx AS (
  SELECT 'C' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS wallet_address,
         CAST(o_orderkey AS VARCHAR) AS transaction_hash FROM orders)"""


def _orders_tx(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").selectExpr(
        "concat('C', lpad(cast(o_custkey as string), 6, '0')) AS wallet_address",
        "cast(o_orderkey as string) AS transaction_hash")


@register("tracking_overview", TRACK + """,
flags AS (SELECT wallet_address, BOOL_OR(pnl_processed) AS yes, BOOL_OR(NOT pnl_processed) AS no,
                 wallet_address IN (SELECT wallet_address FROM pnl_present_fx) AS has FROM wallets_fx GROUP BY wallet_address)
SELECT COUNT(*) AS total_whales, COUNT(*) FILTER (WHERE yes) AS marked_processed, COUNT(*) FILTER (WHERE no) AS marked_unprocessed,
       COUNT(*) FILTER (WHERE has) AS actual_pnl_records, COUNT(*) FILTER (WHERE yes AND NOT has) AS marked_but_no_pnl,
       COUNT(*) FILTER (WHERE no AND has) AS unmarked_but_has_pnl
FROM flags""")
def q_tracking_overview(spark, sf_dir):
    return rp.tracking_overview(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir))


@register("processed_without_record", TRACK + """
SELECT * FROM wallets_fx WHERE pnl_processed AND wallet_address NOT IN (SELECT wallet_address FROM pnl_present_fx)""")
def q_processed_without_record(spark, sf_dir):
    return rp.processed_without_record(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir))


@register("tracking_mismatches", TRACK + """
SELECT wallet_address, pnl_processed, transactions_processed, CASE WHEN has THEN 'YES' ELSE 'NO' END AS has_pnl_record
FROM (SELECT *, wallet_address IN (SELECT wallet_address FROM pnl_present_fx) AS has FROM wallets_fx) w
WHERE pnl_processed <> has""")
def q_tracking_mismatches(spark, sf_dir):
    return rp.tracking_mismatches(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir))


@register("flags_breakdown", TRACK + """
SELECT pnl_processed, transactions_processed, COUNT(*) AS whale_count, COUNT(*) FILTER (WHERE has) AS pnl_record_count
FROM (SELECT DISTINCT wallet_address, pnl_processed, transactions_processed,
             wallet_address IN (SELECT wallet_address FROM pnl_present_fx) AS has FROM wallets_fx) w
GROUP BY ALL""")
def q_flags_breakdown(spark, sf_dir):
    return rp.flags_breakdown(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir))


@register("mismatch_tx_buckets", W(fx.WALLETS_FX_SQL, fx.PNL_PRESENT_FX_SQL, ORDERS_TX) + """,
per_wallet AS (
  SELECT (SELECT COUNT(t.transaction_hash) FROM orders_tx t WHERE t.wallet_address = w.wallet_address) AS n
  FROM wallets_fx w WHERE pnl_processed AND wallet_address NOT IN (SELECT wallet_address FROM pnl_present_fx))
SELECT CASE WHEN n >= 5 THEN '5+ transactions' WHEN n >= 1 THEN '1-4 transactions' ELSE '0 transactions' END AS transaction_range,
       COUNT(*) AS whale_count
FROM per_wallet GROUP BY 1""")
def q_mismatch_tx_buckets(spark, sf_dir):
    return rp.mismatch_tx_buckets(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir),
                                  _orders_tx(spark, sf_dir))


@register("token_holder_counts", W(fx.TOKENS_FX_SQL, fx.HOLDERS_FX_SQL) + """
SELECT t.token_address, t.symbol, t.market_cap, t.price_change_24h_percent,
       COUNT(h.wallet_address) AS whale_count
FROM tokens_fx t LEFT JOIN holders_fx h ON t.token_address = h.token_address
GROUP BY t.token_address, t.symbol, t.market_cap, t.price_change_24h_percent""")
def q_token_holder_counts(spark, sf_dir):
    return rp.token_holder_counts(fx.tokens_fx(spark, sf_dir), fx.holders_fx(spark, sf_dir))
