"""Registered queries for screening, cleaning and holder operators, with
their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.config import HolderBand, TokenScreen, TxFilter
from cairn.functions.expr import ts_ntz
from cairn.operators import clean, holders
from cairn.plans import fixtures as fx
from cairn.plans.registry import register

W = fx.with_ctes
SCREEN = TokenScreen(min_liquidity=500_000, max_liquidity=2_000_000, min_volume_1h=20,
                     min_price_change_2h=0, min_price_change_24h=5, limit=100)


@register("screen_tokens", W(fx.TOKENS_FX_SQL) + f"""
SELECT * FROM tokens_fx
WHERE liquidity >= {SCREEN.min_liquidity} AND liquidity <= {SCREEN.max_liquidity}
  AND volume_1h_usd >= {SCREEN.min_volume_1h} AND price_change_2h_percent >= {SCREEN.min_price_change_2h}
  AND price_change_24h_percent >= {SCREEN.min_price_change_24h}
ORDER BY liquidity DESC NULLS LAST, token_address LIMIT {SCREEN.limit}""")
def q_screen_tokens(spark, sf_dir):
    return clean.screen_tokens(fx.tokens_fx(spark, sf_dir), SCREEN)


@register("screen_tokens_page2", W(fx.TOKENS_FX_SQL) + """
SELECT * FROM tokens_fx WHERE liquidity >= 100000
ORDER BY liquidity DESC NULLS LAST, token_address LIMIT 50 OFFSET 50""")
def q_screen_tokens_page2(spark, sf_dir):
    s = TokenScreen(min_liquidity=100_000, max_liquidity=None, min_volume_1h=None,
                    min_price_change_2h=None, min_price_change_24h=None, limit=50, offset=50)
    return clean.screen_tokens(fx.tokens_fx(spark, sf_dir), s)


@register("unprocessed_tokens", W(fx.TOKENS_FX_SQL) + "SELECT * FROM tokens_fx WHERE silver_processed = false")
def q_unprocessed(spark, sf_dir):
    return clean.unprocessed(fx.tokens_fx(spark, sf_dir), "silver_processed")


@register("due_for_refresh", W(fx.TOKENS_FX_SQL) + f"""
SELECT * FROM tokens_fx WHERE silver_processed = false
   OR (silver_processed = true AND silver_processed_at < TIMESTAMP '{fx.NOW_ORDERS}' - INTERVAL 288 HOUR)""")
def q_due_for_refresh(spark, sf_dir):
    return clean.due_for_refresh(fx.tokens_fx(spark, sf_dir), ts_ntz(fx.NOW_ORDERS), 288,
                                 flag="silver_processed", at="silver_processed_at")


@register("due_for_refetch", W(fx.WALLETS_FX_SQL) + f"""
SELECT * FROM wallets_fx WHERE transactions_processed_at IS NULL
   OR date_diff('microsecond', transactions_processed_at, TIMESTAMP '{fx.NOW_ORDERS}') // 86400000000 >= 30""")
def q_due_for_refetch(spark, sf_dir):
    return clean.due_for_refetch(fx.wallets_fx(spark, sf_dir), ts_ntz(fx.NOW_ORDERS), 30)


_VALUE = ("CASE WHEN base_ui_change_amount IS NOT NULL AND base_ui_change_amount <> 0 AND base_nearest_price "
          "IS NOT NULL AND base_nearest_price <> 0 THEN abs(base_ui_change_amount) * base_nearest_price ELSE 0.0 END")
_TXF = TxFilter(min_value_usd=100.0)


@register("clean_transactions", W(fx.SWAPS_FX_SQL) + f"""
SELECT * REPLACE (lower(tx_type) AS tx_type), {_VALUE} AS value_usd FROM swaps_fx
WHERE lower(tx_type) IN ('swap', 'transfer') AND {_VALUE} >= 100""")
def q_clean_transactions(spark, sf_dir):
    return clean.clean_transactions(fx.swaps_fx(spark, sf_dir), _TXF)


@register("rejected_transactions", W(fx.SWAPS_FX_SQL) + f"""
SELECT transaction_hash, 'below min value' AS reject_reason FROM swaps_fx
WHERE {_VALUE} < 100""")
def q_rejected_transactions(spark, sf_dir):
    return clean.split_transactions(fx.swaps_fx(spark, sf_dir), _TXF)[1] \
        .select("transaction_hash", "reject_reason")


@register("transaction_record", W(fx.SWAPS_FX_SQL) + f"""
SELECT COALESCE(transaction_hash, '') AS transaction_hash, 'whale_' || wallet_address AS whale_id, wallet_address,
       "timestamp", lower(tx_type) AS tx_type, COALESCE(source, '') AS source,
       COALESCE(base_symbol, '') AS base_symbol, COALESCE(base_address, '') AS base_address,
       COALESCE(base_type_swap, '') AS base_type_swap, base_ui_change_amount, base_nearest_price,
       COALESCE(quote_symbol, '') AS quote_symbol, COALESCE(quote_address, '') AS quote_address,
       COALESCE(quote_type_swap, '') AS quote_type_swap, quote_ui_change_amount, quote_nearest_price,
       TIMESTAMP '{fx.NOW_EVENTS}' AS fetched_at, 'run-1' AS batch_id, 'market_api' AS data_source
FROM swaps_fx""")
def q_transaction_record(spark, sf_dir):
    return clean.transaction_record(fx.swaps_fx(spark, sf_dir), ts_ntz(fx.NOW_EVENTS), "run-1")


@register("nan_to_null", W(fx.TOKENS_FX_SQL) + """
SELECT token_address, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE liquidity END AS liquidity, holder
FROM tokens_fx""")
def q_nan_to_null(spark, sf_dir):
    t = fx.tokens_fx(spark, sf_dir).select(
        "token_address",
        F.when(F.col("p_partkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("liquidity")).alias("liquidity"),
        "holder")
    return clean.nan_to_null(t)


@register("with_ingest_metadata", W(fx.TOKENS_FX_SQL) + f"""
SELECT token_address, liquidity, TIMESTAMP '{fx.NOW_ORDERS}' AS ingested_at, 'run-1' AS batch_id,
       DATE '{fx.NOW_ORDERS[:10]}' AS processing_date, false AS silver_processed,
       CAST(NULL AS TIMESTAMP) AS silver_processed_at
FROM tokens_fx""")
def q_with_ingest_metadata(spark, sf_dir):
    t = fx.tokens_fx(spark, sf_dir).select("token_address", "liquidity")
    return clean.with_ingest_metadata(t, ts_ntz(fx.NOW_ORDERS), "run-1")


@register("silver_token_record", W(fx.TOKENS_FX_SQL) + f"""
SELECT token_address, 1.0::DOUBLE AS selection_score, 'all_bronze_tokens' AS selection_criteria,
       ROW_NUMBER() OVER (ORDER BY token_address) AS selection_rank,
       CAST(holder AS BIGINT) AS holder_count, liquidity, price
FROM tokens_fx WHERE silver_processed = false""")
def q_silver_token_record(spark, sf_dir):
    r = clean.silver_token_record(fx.tokens_fx(spark, sf_dir), ts_ntz(fx.NOW_ORDERS))
    return r.select("token_address", "selection_score",
                    F.col("selection_reason.selection_criteria").alias("selection_criteria"),
                    F.col("selection_reason.rank").alias("selection_rank"),
                    "holder_count", "liquidity", "price")


@register("ready_wallets", W(fx.WALLETS_FX_SQL) + """
SELECT * FROM wallets_fx WHERE pnl_processed = false AND transactions_processed = true""")
def q_ready_wallets(spark, sf_dir):
    return clean.ready_wallets(fx.wallets_fx(spark, sf_dir))


@register("min_history", W(fx.TRADES_FX_SQL) + """
SELECT wallet_address, CAST(COUNT(*) AS BIGINT) AS transaction_count,
       CASE WHEN COUNT(*) >= 200 THEN 'ready' ELSE 'skipped' END AS state
FROM trades_fx GROUP BY wallet_address""")
def q_min_history(spark, sf_dir):
    from cairn.plans.pnl import min_history
    t = fx.trades_fx(spark, sf_dir)
    ok, skipped = min_history(t, 200)
    return (ok.withColumn("state", F.lit("ready")).unionByName(skipped)
            .select("wallet_address", "transaction_count", "state"))


@register("trade_legs", W(fx.SWAPS_FX_SQL) + """,
legs AS (
  SELECT wallet_address, transaction_hash, "timestamp", 0 AS leg, base_address AS token_address,
         CASE WHEN base_symbol IS NULL OR base_symbol = '' THEN substr(base_address, 1, 8) ELSE base_symbol END
           AS token_symbol, base_type_swap AS side, base_ui_change_amount AS amount, base_nearest_price AS px
  FROM swaps_fx
  UNION ALL
  SELECT wallet_address, transaction_hash, "timestamp", 1, quote_address,
         CASE WHEN quote_symbol IS NULL OR quote_symbol = '' THEN substr(quote_address, 1, 8) ELSE quote_symbol END,
         quote_type_swap, quote_ui_change_amount, quote_nearest_price
  FROM swaps_fx)
SELECT wallet_address, token_address, token_symbol, "timestamp", transaction_hash, leg, side,
       CAST(abs(amount) AS DOUBLE) AS quantity, CAST(px AS DOUBLE) AS price
FROM legs
WHERE token_address IS NOT NULL AND token_address <> '' AND amount IS NOT NULL AND amount <> 0
  AND px IS NOT NULL AND px > 0""")
def q_trade_legs(spark, sf_dir):
    from cairn.operators.fifo import trade_legs
    legs = trade_legs(fx.swaps_fx(spark, sf_dir))
    return legs.withColumns({"quantity": F.col("quantity").cast("double"),
                             "price": F.col("price").cast("double")})


@register("wallet_pnl_from_swaps", __import__("cairn.plans.sql_pnl", fromlist=["x"]).WALLET_PNL_SWAPS_SQL)
def q_wallet_pnl_from_swaps(spark, sf_dir):
    """P1 -> P19 on the bronze swap shape (base + CASH quote legs)."""
    from cairn.plans.pnl import wallet_pnl
    return wallet_pnl(fx.swaps_fx(spark, sf_dir))


@register("wallet_pnl_ready_wallets", "WITH ready AS (SELECT DISTINCT 'W' || lpad(CAST(user_id // 3 AS VARCHAR), 5, '0') AS wallet_address "
          "FROM events WHERE (user_id // 3) % 2 = 0),\npnl AS ("
          + __import__("cairn.plans.sql_pnl", fromlist=["x"]).WALLET_PNL_SWAPS_SQL + ")\n"
          "SELECT pnl.* FROM pnl WHERE EXISTS (SELECT 1 FROM ready r WHERE r.wallet_address = pnl.wallet_address)")
def q_wallet_pnl_ready(spark, sf_dir):
    """Only the transactions of ready wallets (semi join) reach the PnL job."""
    from cairn.plans.pnl import wallet_pnl
    ready = fx.table(spark, sf_dir, "events").where("(user_id div 3) % 2 = 0").selectExpr(
        "concat('W', lpad(cast(user_id div 3 as string), 5, '0')) AS wallet_address").distinct()
    return wallet_pnl(fx.swaps_fx(spark, sf_dir), ready)


ODD_LEGS_SQL = """odd AS (
  SELECT 'W' || CAST(l_orderkey AS VARCHAR) AS wallet_address, l_linenumber AS leg,
         CASE l_partkey % 8 WHEN 0 THEN 4e-10 WHEN 1 THEN 3e23 WHEN 2 THEN 1e19 WHEN 3 THEN 0.0 WHEN 4 THEN NULL
              ELSE CAST(l_quantity AS DOUBLE) END AS amount,
         CASE l_partkey % 8 WHEN 2 THEN 100.0 WHEN 5 THEN 4e-17 WHEN 6 THEN 0.0 ELSE 1.0 END AS px,
         CASE WHEN l_partkey % 11 = 0 THEN '' ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS token_address
  FROM lineitem)"""


def odd_swaps(spark, sf_dir):
    """Base legs with tiny, huge, null and zero amounts and prices and empty
    addresses; no quote leg."""
    k, n = F.col("l_partkey") % 8, F.lit(None).cast("string")
    li = fx.table(spark, sf_dir, "lineitem")
    amount = (F.when(k == 0, 4e-10).when(k == 1, 3e23).when(k == 2, 1e19).when(k == 3, 0.0)
              .when(k == 4, F.lit(None).cast("double")).otherwise(F.col("l_quantity").cast("double")))
    px = F.when(k == 2, 100.0).when(k == 5, 4e-17).when(k == 6, 0.0).otherwise(1.0)
    token = F.when(F.col("l_partkey") % 11 == 0, "").otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
    return li.select(
        F.concat(F.lit("W"), F.col("l_orderkey").cast("string")).alias("wallet_address"),
        F.col("l_linenumber").cast("string").alias("transaction_hash"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("timestamp"),
        n.alias("base_symbol"), token.alias("base_address"), F.lit("to").alias("base_type_swap"),
        amount.alias("base_ui_change_amount"), px.alias("base_nearest_price"),
        n.alias("quote_symbol"), n.alias("quote_address"), n.alias("quote_type_swap"),
        F.lit(None).cast("double").alias("quote_ui_change_amount"), F.lit(None).cast("double").alias("quote_nearest_price"))


@register("trade_leg_rejects", W(ODD_LEGS_SQL) + """
SELECT CASE WHEN amount < 5e-10 THEN 'quantity too small' WHEN amount > 1e23 THEN 'quantity too large'
            WHEN px < 5e-17 THEN 'price too small' ELSE 'value too large' END AS reason,
       COUNT(*) AS legs
FROM odd WHERE token_address <> '' AND amount <> 0 AND px > 0
  AND (amount < 5e-10 OR amount > 1e23 OR px < 5e-17 OR amount * px >= 1e20)
GROUP BY 1""")
def q_trade_leg_rejects(spark, sf_dir):
    """Valid legs outside the fixed-point range, counted by reason."""
    from cairn.operators.fifo import trade_leg_rejects
    return trade_leg_rejects(odd_swaps(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("legs"))


@register("trade_legs_odd", W(ODD_LEGS_SQL) + """
SELECT wallet_address, CAST(leg AS VARCHAR) AS transaction_hash, token_address, amount AS quantity, px AS price
FROM odd WHERE token_address <> '' AND amount <> 0 AND px > 0
  AND NOT (amount < 5e-10 OR amount > 1e23 OR px < 5e-17 OR amount * px >= 1e20)""")
def q_trade_legs_odd(spark, sf_dir):
    """F12 on the same input: what the FIFO receives."""
    from cairn.operators.fifo import trade_legs
    return trade_legs(odd_swaps(spark, sf_dir)).select(
        "wallet_address", "transaction_hash", "token_address", F.col("quantity").cast("double").alias("quantity"),
        F.col("price").cast("double").alias("price"))


@register("first_trade_per_position", W(fx.TRADES_FX_SQL) + """
SELECT wallet_address, token_address, arg_min(transaction_hash, ("timestamp", transaction_hash, leg)) AS transaction_hash,
       MIN("timestamp") AS first_at
FROM trades_fx GROUP BY wallet_address, token_address""")
def q_first_trade(spark, sf_dir):
    t = fx.trades_fx(spark, sf_dir).select("wallet_address", "token_address", "timestamp",
                                           "transaction_hash", "leg")
    f = clean.first_per_key(t, ["wallet_address", "token_address"], ["timestamp", "transaction_hash", "leg"])
    return f.select("wallet_address", "token_address", "transaction_hash", F.col("timestamp").alias("first_at"))


# -------------------------------------------------------------------- holders
HOLDER_TOKENS_SQL = """htok AS (
  SELECT token_address, CASE WHEN token_address LIKE '%0' THEN NULL ELSE COUNT(*) END AS holder_count
  FROM holders_fx GROUP BY token_address)"""
BAND = HolderBand(skip_top_percentage=10.0, holders_per_token=210, top_holders_limit=15)


def _holder_tokens(h):
    return h.groupBy("token_address").agg(
        F.when(F.col("token_address").endswith("0"), F.lit(None))
        .otherwise(F.count(F.lit(1))).alias("holder_count"))


@register("holder_band", W(fx.HOLDERS_FX_SQL, HOLDER_TOKENS_SQL) + f"""
, r AS (
  SELECT h.*, ROW_NUMBER() OVER (PARTITION BY h.token_address ORDER BY ui_amount DESC NULLS LAST, wallet_address)
           AS holder_rank, t.holder_count,
         CAST(floor(t.holder_count * {BAND.skip_top_percentage / 100.0}) AS BIGINT) AS skip
  FROM holders_fx h LEFT JOIN htok t USING (token_address))
SELECT * EXCLUDE (holder_count, skip) REPLACE (CAST(holder_rank AS INTEGER) AS holder_rank) FROM r
WHERE CASE WHEN holder_count IS NOT NULL AND holder_count > 0
           THEN holder_rank > skip AND holder_rank <= skip + CASE WHEN skip + {BAND.holders_per_token} > holder_count
                THEN GREATEST(1, holder_count - skip) ELSE {BAND.holders_per_token} END
           ELSE holder_rank <= {BAND.top_holders_limit} END""")
def q_holder_band(spark, sf_dir):
    h = fx.holders_fx(spark, sf_dir)
    return holders.holder_band(h, _holder_tokens(h), BAND)


@register("holder_rollup", W(fx.HOLDERS_FX_SQL) + """
SELECT wallet_address, CAST(COUNT(token_address) AS BIGINT) AS tokens_held_count,
       SUM(ui_amount) AS total_tokens_held
FROM holders_fx WHERE silver_processed = false GROUP BY wallet_address""")
def q_holder_rollup(spark, sf_dir):
    return holders.holder_rollup(fx.holders_fx(spark, sf_dir))


@register("holder_rollup_tokens", W(fx.HOLDERS_FX_SQL) + """
SELECT wallet_address, token_address, token_symbol FROM holders_fx WHERE silver_processed = false""")
def q_holder_rollup_tokens(spark, sf_dir):
    return holders.holder_rollup_tokens(fx.holders_fx(spark, sf_dir))


@register("holder_record", W(fx.HOLDERS_FX_SQL) + """,
roll AS (SELECT wallet_address, COUNT(token_address) AS tokens_held_count FROM holders_fx
         WHERE silver_processed = false GROUP BY wallet_address)
SELECT r.wallet_address, CAST(r.tokens_held_count AS BIGINT) AS tokens_held_count,
       SUM(COALESCE(h.ui_amount, 0.0)) AS total_value_held,
       CAST(COUNT(*) AS BIGINT) AS source_token_count,
       false AS transactions_processed, false AS pnl_processed
FROM roll r JOIN holders_fx h USING (wallet_address)
GROUP BY r.wallet_address, r.tokens_held_count""")
def q_holder_record(spark, sf_dir):
    return holders.holder_record(fx.holders_fx(spark, sf_dir))


@register("holder_source_tokens", W(fx.HOLDERS_FX_SQL) + """
SELECT wallet_address, token_address, token_symbol, COALESCE(ui_amount, 0.0) AS ui_amount,
       CAST(COALESCE(rank, 0) AS BIGINT) AS rank
FROM (SELECT *, BOOL_OR(silver_processed = false) OVER (PARTITION BY wallet_address) AS listed FROM holders_fx) h
WHERE listed""")
def q_holder_source_tokens(spark, sf_dir):
    return holders.holder_source_tokens(fx.holders_fx(spark, sf_dir))


@register("holder_filters", W(fx.HOLDERS_FX_SQL) + """,
roll AS (SELECT wallet_address, COUNT(token_address) AS tokens_held_count,
                SUM(COALESCE(ui_amount, 0.0)) AS total_value_held
         FROM holders_fx GROUP BY wallet_address)
SELECT * FROM roll WHERE tokens_held_count >= 5 AND total_value_held >= 300
  AND wallet_address NOT IN ('C000003', 'C000006')""")
def q_holder_filters(spark, sf_dir):
    h = fx.holders_fx(spark, sf_dir)
    roll = h.groupBy("wallet_address").agg(
        F.count("token_address").alias("tokens_held_count"),
        F.sum(F.coalesce("ui_amount", F.lit(0.0))).alias("total_value_held"))
    return holders.holder_filters(roll, 5, 300.0, ("C000003", "C000006"))


@register("min_holding_share", W(fx.HOLDERS_FX_SQL) + """
SELECT * FROM (
  SELECT h.*, CASE WHEN t.tot > 0 THEN h.ui_amount / t.tot * 100 END AS holding_percent
  FROM holders_fx h JOIN (SELECT token_address, SUM(ui_amount) AS tot FROM holders_fx GROUP BY 1) t
  USING (token_address)) x
WHERE holding_percent >= 1.0""")
def q_min_holding_share(spark, sf_dir):
    return holders.min_holding_share(fx.holders_fx(spark, sf_dir), 1.0)
