"""Registered queries for the declared options (D1-D9, W8, W9), open lots
(P6) and the leaderboard/frequency cap (G16, F14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.config import RankConfig
from cairn.functions.expr import sql_round as R
from cairn.functions.expr import ts_ntz
from cairn.operators import options as op
from cairn.operators.fifo import fifo_split, open_lots, unrealized_pnl
from cairn.plans import fixtures as fx
from cairn.plans import sql_gold
from cairn.plans.registry import QUERIES, register
from cairn.plans.sql_pnl import FIFO_CTES, POSITIONS_SQL

W = fx.with_ctes
FIFO_SQL = "WITH " + fx.TRADES_FX_SQL + ",\nlegs_in AS (SELECT * FROM trades_fx)," + FIFO_CTES


def _fifo(spark, sf_dir):
    return fifo_split(fx.trades_fx(spark, sf_dir))


_SEL = dict(min_holders=10, min_volume_24h=500.0, selection_ratio=0.5, max_selected=200)
_NORM = " + ".join(
    f"(CASE WHEN {c} IS NULL OR MAX(CAST({c} AS DOUBLE)) OVER () = MIN(CAST({c} AS DOUBLE)) OVER () THEN 0.0 "
    f"ELSE (CAST({c} AS DOUBLE) - MIN(CAST({c} AS DOUBLE)) OVER ()) / (MAX(CAST({c} AS DOUBLE)) OVER () "
    f"- MIN(CAST({c} AS DOUBLE)) OVER ()) END) * CAST({w!r} AS DOUBLE)"
    for c, w in op.SELECTION_WEIGHTS.items())


@register("token_selection_score", W(fx.TOKENS_FX_SQL) + f""",
c AS (SELECT * FROM tokens_fx WHERE holder >= {_SEL['min_holders']} AND volume_24h_usd >= {_SEL['min_volume_24h']}),
s AS (SELECT *, {_NORM} AS selection_score FROM c),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY selection_score DESC, token_address) AS selection_rank,
             COUNT(*) OVER () AS n FROM s)
SELECT * EXCLUDE (n) FROM r WHERE selection_rank <= LEAST(CEIL(n * 0.5), {_SEL['max_selected']})""")
def q_token_selection(spark, sf_dir):
    return op.token_selection_score(fx.tokens_fx(spark, sf_dir), **_SEL)


@register("lookback_transactions", W(fx.SWAPS_FX_SQL) + f"""
SELECT * FROM swaps_fx WHERE "timestamp" >= TIMESTAMP '{fx.NOW_EVENTS}' - INTERVAL 7 DAY""")
def q_lookback(spark, sf_dir):
    return op.lookback(fx.swaps_fx(spark, sf_dir), ts_ntz(fx.NOW_EVENTS), 7)


@register("rank_traders_config_tiers", sql_gold.gold_sql(tiers=op.CONFIG_TIERS) + """
SELECT wallet_address, performance_tier, tier_score, CAST(overall_rank AS BIGINT) AS overall_rank,
       met_roi, met_sharpe FROM gold""")
def q_rank_config_tiers(spark, sf_dir):
    from cairn.operators.tiers import rank_traders
    g = rank_traders(QUERIES["wallet_pnl"](spark, sf_dir), ts_ntz(fx.NOW_EVENTS), RankConfig(tiers=op.CONFIG_TIERS))
    return g.select("wallet_address", "performance_tier", "tier_score", "overall_rank", "met_roi", "met_sharpe")


@register("tier_limits", sql_gold.gold_sql() + """
SELECT wallet_address, performance_tier, CAST(tier_rank AS BIGINT) AS tier_rank,
       (SELECT COUNT(*) FROM gold) >= 10 AS meets_min_total
FROM gold WHERE tier_rank <= 5""")
def q_tier_limits(spark, sf_dir):
    g = QUERIES["rank_traders"](spark, sf_dir)
    return op.tier_limits(g, 5, 10).select("wallet_address", "performance_tier", "tier_rank", "meets_min_total")


@register("leaderboard_by_pnl", sql_gold.gold_sql() + """
SELECT performance_tier, wallet_address, total_realized_pnl_usd, win_rate_percent, total_trades FROM gold""")
def q_leaderboard(spark, sf_dir):
    from cairn.operators.tiers import leaderboard
    return leaderboard(QUERIES["rank_traders"](spark, sf_dir), by="pnl").select(
        "performance_tier", "wallet_address", "total_realized_pnl_usd", "win_rate_percent", "total_trades")


@register("rank_traders_strict_drawdown", sql_gold.gold_sql().replace(
    sql_gold.DD, "COALESCE(max_drawdown_percent, 100)") + """
SELECT wallet_address, performance_tier, CAST(overall_rank AS BIGINT) AS overall_rank, tier_score FROM gold""")
def q_rank_strict(spark, sf_dir):
    """G4 with compat=False: a drawdown of 0 counts as 0, not as missing."""
    from cairn.operators.tiers import rank_traders
    return rank_traders(QUERIES["wallet_pnl"](spark, sf_dir), ts_ntz(fx.NOW_EVENTS), RankConfig(compat=False)).select(
        "wallet_address", "performance_tier", "overall_rank", "tier_score")


@register("leaderboard_by_rank", sql_gold.gold_sql() + """
SELECT CAST(overall_rank AS BIGINT) AS overall_rank, wallet_address, performance_tier, tier_score FROM gold""")
def q_leaderboard_rank(spark, sf_dir):
    """G16 by overall rank."""
    from cairn.operators.tiers import leaderboard
    return leaderboard(QUERIES["rank_traders"](spark, sf_dir)).select(
        "overall_rank", "wallet_address", "performance_tier", "tier_score")


@register("frequency_cap", sql_gold.gold_sql() + """
SELECT wallet_address, trade_frequency_per_day FROM gold
WHERE trade_frequency_per_day IS NULL OR trade_frequency_per_day <= 2""")
def q_frequency_cap(spark, sf_dir):
    from cairn.operators.clean import frequency_cap
    return frequency_cap(QUERIES["rank_traders"](spark, sf_dir), 2.0).select(
        "wallet_address", "trade_frequency_per_day")


SNAP_SQL = f""",
d AS (SELECT wallet_address, CAST("timestamp" AS DATE) AS performance_date, SUM(pnl) AS pnl, SUM(cost) AS cost,
             COUNT(*) FILTER (WHERE is_win) AS wins, COUNT(*) FILTER (WHERE is_loss) AS losses FROM tr GROUP BY 1, 2),
c AS (SELECT wallet_address, performance_date,
             SUM(pnl) OVER w AS cum_pnl, SUM(cost) OVER w AS cum_cost,
             SUM(wins) OVER w AS cum_wins, SUM(losses) OVER w AS cum_losses
      FROM d WINDOW w AS (PARTITION BY wallet_address ORDER BY performance_date
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s0 AS (SELECT wallet_address, performance_date, CAST(ROUND(cum_pnl, 2) AS DOUBLE) AS total_realized_pnl_usd,
              {R('CASE WHEN cum_cost > 0 THEN CAST(cum_pnl AS DOUBLE) / CAST(cum_cost AS DOUBLE) * 100 ELSE 0.0 END', 2)}
                AS total_roi_percent,
              {R('CASE WHEN cum_wins + cum_losses > 0 THEN CAST(cum_wins AS DOUBLE) / (cum_wins + cum_losses) * 100 ELSE 0.0 END', 2)}
                AS win_rate_percent,
              CAST(cum_wins + cum_losses AS BIGINT) AS meaningful_trades FROM c),
snap AS (SELECT *, CASE {' '.join(f"WHEN total_realized_pnl_usd >= {p} AND total_roi_percent >= {r} AND win_rate_percent >= {w} THEN '{n}'" for n, p, r, w in op.SNAPSHOT_TIERS)}
                    ELSE 'UNQUALIFIED' END AS performance_tier FROM s0)"""


@register("performance_history", FIFO_SQL + SNAP_SQL + f"""
SELECT s.*, {R('s.total_roi_percent - p.total_roi_percent', 2)} AS roi_change_7d,
       {R('s.total_realized_pnl_usd - p.total_realized_pnl_usd', 2)} AS pnl_change_7d,
       CASE WHEN p.performance_tier IS NULL THEN NULL WHEN p.performance_tier = s.performance_tier THEN 'unchanged'
            ELSE p.performance_tier || ' -> ' || s.performance_tier END AS tier_change
FROM snap s LEFT JOIN snap p ON s.wallet_address = p.wallet_address
 AND p.performance_date = s.performance_date - INTERVAL 7 DAY
WHERE s.performance_date >= CAST(TIMESTAMP '{fx.NOW_EVENTS}' - INTERVAL 90 DAY AS DATE)""")
def q_performance_history(spark, sf_dir):
    snaps = op.daily_snapshots(_fifo(spark, sf_dir))
    return op.performance_history(snaps, 90, ts_ntz(fx.NOW_EVENTS))


@register("top_tokens", "WITH pos AS (" + POSITIONS_SQL + """)
SELECT * , CAST(ROW_NUMBER() OVER (PARTITION BY wallet_address ORDER BY realized_pnl DESC, token_address) AS INTEGER)
  AS token_rank FROM pos QUALIFY token_rank <= 5""")
def q_top_tokens(spark, sf_dir):
    from cairn.operators.metrics import position_summary
    return op.top_tokens(position_summary(_fifo(spark, sf_dir)), 5)


@register("volatility_score", FIFO_SQL + f"""
SELECT wallet_address, {R('stddev_pop(roi)', 4)} AS volatility_score FROM tr WHERE roi IS NOT NULL
GROUP BY wallet_address""")
def q_volatility(spark, sf_dir):
    return op.volatility_score(_fifo(spark, sf_dir))


@register("last_30d", FIFO_SQL + f"""
SELECT wallet_address,
       {R('CASE WHEN SUM(cost) > 0 THEN CAST(SUM(pnl) AS DOUBLE) / CAST(SUM(cost) AS DOUBLE) * 100 ELSE 0.0 END', 2)}
         AS last_30d_roi_percent,
       CAST(COUNT(*) FILTER (WHERE is_matched) AS BIGINT) AS last_30d_trades,
       {R('CASE WHEN COUNT(*) FILTER (WHERE is_win) + COUNT(*) FILTER (WHERE is_loss) > 0 THEN CAST(COUNT(*) FILTER (WHERE is_win) AS DOUBLE) / (COUNT(*) FILTER (WHERE is_win) + COUNT(*) FILTER (WHERE is_loss)) * 100 ELSE 0.0 END', 2)}
         AS last_30d_win_rate,
       CAST(ROUND(SUM(pnl), 2) AS DOUBLE) AS last_30d_pnl_usd
FROM tr WHERE "timestamp" >= TIMESTAMP '{fx.NOW_EVENTS}' - INTERVAL 30 DAY GROUP BY wallet_address""")
def q_last_30d(spark, sf_dir):
    return op.last_30d(_fifo(spark, sf_dir), ts_ntz(fx.NOW_EVENTS), 30)


@register("unrealized_pnl", FIFO_SQL + f""",
fm AS (SELECT wallet_address, token_address, SUM(mq) AS final_m FROM tr GROUP BY 1, 2),
lots2 AS (SELECT t.wallet_address, t.token_address, t.price,
                 LEAST(t.quantity, GREATEST(0, t.b - f.final_m)) AS remaining
          FROM tr t JOIN fm f USING (wallet_address, token_address) WHERE t.side = 'to'),
px AS (SELECT token_address, arg_max(price, ("timestamp", transaction_hash)) AS current_price
       FROM trades_fx GROUP BY 1),
agg AS (SELECT wallet_address, token_address, SUM(remaining) AS open_quantity, SUM(remaining * price) AS open_cost
        FROM lots2 WHERE remaining > 0 GROUP BY 1, 2)
SELECT wallet_address, token_address, CAST(open_quantity AS DOUBLE) AS open_quantity,
       CAST(ROUND(open_cost, 2) AS DOUBLE) AS open_cost,
       CAST(ROUND(open_quantity * current_price, 2) AS DOUBLE) AS current_value,
       CAST(ROUND(open_quantity * current_price - open_cost, 2) AS DOUBLE) AS unrealized_pnl
FROM agg JOIN px USING (token_address)""")
def q_unrealized_pnl(spark, sf_dir):
    t = fx.trades_fx(spark, sf_dir)
    prices = t.groupBy("token_address").agg(
        F.max_by("price", F.struct("timestamp", "transaction_hash")).alias("current_price"))
    u = unrealized_pnl(open_lots(fifo_split(t)), prices)
    return u.select("wallet_address", "token_address", F.col("open_quantity").cast("double").alias("open_quantity"),
                    *[F.round(c, 2).cast("double").alias(c) for c in ("open_cost", "current_value", "unrealized_pnl")])


@register("open_lots", FIFO_SQL + f""",
fm AS (SELECT wallet_address, token_address, SUM(mq) AS final_m FROM tr GROUP BY 1, 2),
lots2 AS (SELECT t.wallet_address, t.token_address, t.transaction_hash, t.leg, t.price,
                 LEAST(t.quantity, GREATEST(0, t.b - f.final_m)) AS remaining
          FROM tr t JOIN fm f USING (wallet_address, token_address) WHERE t.side = 'to')
SELECT wallet_address, token_address, transaction_hash, leg, CAST(remaining AS DOUBLE) AS remaining_quantity,
       CAST(ROUND(remaining * price, 2) AS DOUBLE) AS remaining_cost
FROM lots2 WHERE remaining > 0""")
def q_open_lots(spark, sf_dir):
    """What is left of every buy lot after all sells (remaining units and cost)."""
    lots = open_lots(fifo_split(fx.trades_fx(spark, sf_dir)))
    return lots.select("wallet_address", "token_address", "transaction_hash", "leg",
                       F.col("remaining_quantity").cast("double").alias("remaining_quantity"),
                       F.round("remaining_cost", 2).cast("double").alias("remaining_cost"))
