"""DuckDB oracle text for the gold family (tiers, scores, ranks, push lists)."""

from __future__ import annotations

from cairn.config import DEFAULT_WEIGHTS, TIER_PRIORITY, TIER_WEIGHTS, TIERS
from cairn.functions.expr import sql_round as R
from cairn.plans.fixtures import NOW_EVENTS
from cairn.plans.sql_pnl import WALLET_PNL_SQL


def _or(c: str, d) -> str:
    return f"(CASE WHEN {c} IS NULL OR {c} = 0 THEN {d} ELSE {c} END)"


def _raw(c: str, d=0) -> str:
    return f"COALESCE({c}, {d})"


def _lit(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _clip(e: str) -> str:
    return f"LEAST(GREATEST({e}, 0.0), 1.0)"


# Fixed values below: the normalisers (roi 200, sharpe 3, pnl 20000) and activity
# penalties of the tier score, written out here so that the SQL stands alone.
COV, ROI, WIN = _or("coverage_ratio_percent", 0), _or("total_roi_percent", 0), _or("win_rate_percent", 0)
SHARPE, PNL = _or("sharpe_ratio", 0), _or("total_realized_pnl_usd", 0)
TRADES, FREQ = _or("meaningful_trades", 0), _or("trade_frequency_per_day", 0)
DD = _or("max_drawdown_percent", 100)


def _holds(c) -> str:
    return (f"{COV} >= {_lit(c.coverage)} AND (CASE WHEN {ROI} > 0 THEN {ROI} >= {_lit(c.roi)} ELSE TRUE END)"
            f" AND {WIN} >= {_lit(c.win_rate)} AND {SHARPE} >= {_lit(c.sharpe)}"
            f" AND {PNL} >= {_lit(c.pnl)} AND {TRADES} >= {c.trades}"
            f" AND {FREQ} >= {_lit(c.freq_min)} AND {FREQ} <= {_lit(c.freq_max)} AND {DD} <= {_lit(c.drawdown)}")


def tier_case(tiers=TIERS) -> str:
    return "CASE " + " ".join(f"WHEN {_holds(c)} THEN '{c.name}'" for c in tiers) + " ELSE 'UNQUALIFIED' END"


def _weighted(w) -> str:
    cov = f"{COV} / 100"
    roi = _clip(f"{ROI} / 200")
    sh = _clip(f"{SHARPE} / 3")
    win = f"{WIN} / 100"
    vol = _clip(f"{PNL} / 20000")
    return (f"({cov} * {_lit(w[0])} + {roi} * {_lit(w[1])} + {sh} * {_lit(w[2])}"
            f" + {win} * {_lit(w[3])} + {vol} * {_lit(w[4])})")


SCORE_CASE = ("CASE " + " ".join(f"WHEN performance_tier = '{n}' THEN {_weighted(w)}"
                                 for n, w in TIER_WEIGHTS.items())
              + f" ELSE {_weighted(DEFAULT_WEIGHTS)} END")
PENALTY = f"(CASE WHEN {FREQ} > 10 THEN 0.9::DOUBLE WHEN {FREQ} < 0.2 THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END)"


def _th(field: str, default, tiers=TIERS) -> str:
    return ("CASE " + " ".join(f"WHEN performance_tier = '{c.name}' THEN {_lit(getattr(c, field))}" for c in tiers)
            + f" ELSE {_lit(default)} END")


METRICS = ["coverage_ratio_percent", "total_roi_percent", "avg_roi_percent", "median_roi_percent",
           "total_realized_pnl_usd", "win_rate_percent", "sharpe_ratio", "max_drawdown_percent",
           "trade_frequency_per_day", "total_volume_usd", "matched_volume_usd",
           "matched_cost_basis_usd", "avg_trade_size_usd"]
COUNTS = ["meaningful_trades", "matched_trades", "total_trades", "trading_days", "tokens_traded_count"]


def gold_sql(pnl_sql: str = WALLET_PNL_SQL, now: str = NOW_EVENTS, tiers=TIERS) -> str:
    """CTE text ending in `gold` (no final SELECT)."""
    return f"""WITH pnl AS ({pnl_sql}),
e AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY smart_trader_score DESC NULLS FIRST,
                                        total_realized_pnl_usd DESC NULLS FIRST, wallet_address) AS overall_rank
  FROM pnl WHERE smart_trader_eligible),
g1 AS (
  SELECT *, {tier_case(tiers)} AS performance_tier,
         CASE WHEN {COV} >= 85 THEN 'High' WHEN {COV} >= 80 THEN 'Good'
              WHEN {COV} >= 70 THEN 'Acceptable' ELSE 'Low' END AS coverage_confidence,
         CASE WHEN first_trade_at IS NOT NULL
              THEN date_diff('microsecond', first_trade_at, TIMESTAMP '{now}') // 86400000000 ELSE 0 END
           AS days_since_first_trade
  FROM e),
g2 AS (
  SELECT *, {R(f'({SCORE_CASE}) * {PENALTY} * 100', 2)} AS tier_score,
         performance_tier IN ('ELITE', 'STRONG') AND {_raw('coverage_ratio_percent')} >= 85.0
           AND days_since_first_trade >= 30 AS auto_follow_eligible,
         days_since_first_trade >= 30 AND {_raw('meaningful_trades')} >= 20
           AND {_raw('coverage_ratio_percent')} >= 75.0 AS verified_performance,
         {_raw('coverage_ratio_percent')} >= {_th('coverage', 0, tiers)} AS met_coverage_ratio,
         {_raw('total_roi_percent')} >= {_th('roi', 0, tiers)} AS met_roi,
         {_raw('win_rate_percent')} >= {_th('win_rate', 0, tiers)} AS met_win_rate,
         {_raw('sharpe_ratio')} >= {_th('sharpe', 0, tiers)} AS met_sharpe,
         {_raw('total_realized_pnl_usd')} >= {_th('pnl', 0, tiers)} AS met_pnl,
         {_raw('meaningful_trades')} >= {_th('trades', 0, tiers)} AS met_trades,
         {_raw('trade_frequency_per_day')} >= {_th('freq_min', 0, tiers)}
           AND {_raw('trade_frequency_per_day')} <= {_th('freq_max', 999, tiers)} AS met_frequency,
         {_raw('max_drawdown_percent', 100)} <= {_th('drawdown', 100, tiers)} AS met_drawdown,
         {_raw('coverage_ratio_percent')} / 100 AS coverage_score,
         {_clip(_raw('total_roi_percent') + ' / 200')} AS roi_score,
         {_clip(_raw('sharpe_ratio') + ' / 3')} AS sharpe_score,
         {_raw('win_rate_percent')} / 100 AS win_rate_score,
         {_clip(_raw('total_realized_pnl_usd') + ' / 20000')} AS volume_score,
         {_raw('coverage_ratio_percent')} / 100 * {_raw('win_rate_percent')} / 100 AS consistency_score
  FROM g1),
gold AS (
  SELECT wallet_address, performance_tier, tier_score,
         ROW_NUMBER() OVER (PARTITION BY performance_tier ORDER BY overall_rank) AS tier_rank,
         ROW_NUMBER() OVER (PARTITION BY performance_tier ORDER BY tier_score DESC, overall_rank) AS tier_rank_by_score,
         overall_rank, coverage_confidence,
         {', '.join(f'CAST({_or(c, 0.0)} AS DOUBLE) AS {c}' for c in METRICS)},
         {', '.join(f'CAST({_or(c, 0)} AS BIGINT) AS {c}' for c in COUNTS)},
         days_since_first_trade, first_trade_at, last_trade_at,
         auto_follow_eligible, verified_performance,
         met_coverage_ratio, met_roi, met_win_rate, met_sharpe, met_pnl, met_trades, met_frequency, met_drawdown,
         coverage_score, roi_score, sharpe_score, win_rate_score, volume_score, consistency_score,
         'Tier: ' || performance_tier || ', Coverage: ' || coverage_confidence AS calculation_notes
  FROM g2)
"""


PRIORITY_CASE = ("CASE performance_tier " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(TIER_PRIORITY, 1))
                 + f" ELSE {len(TIER_PRIORITY) + 1} END")
WEIGHT_CASE = ("CASE performance_tier WHEN 'ELITE' THEN 4 WHEN 'STRONG' THEN 3 WHEN 'PROMISING' THEN 2 "
               "WHEN 'QUALIFIED' THEN 1 ELSE 0 END")

RANK_TRADERS_SQL = gold_sql() + """SELECT gold.* REPLACE (CAST(tier_rank AS BIGINT) AS tier_rank,
  CAST(tier_rank_by_score AS BIGINT) AS tier_rank_by_score, CAST(overall_rank AS BIGINT) AS overall_rank,
  CAST(days_since_first_trade AS BIGINT) AS days_since_first_trade) FROM gold"""

PUSH_LIST_SQL = gold_sql() + f"""SELECT wallet_address, performance_tier, tier_score, total_realized_pnl_usd FROM gold
WHERE wallet_address IS NOT NULL AND wallet_address <> ''
ORDER BY {PRIORITY_CASE}, tier_score DESC NULLS FIRST, total_realized_pnl_usd DESC NULLS FIRST, wallet_address
LIMIT 100"""

PUSH_LIST_CAPPED_SQL = gold_sql() + f"""SELECT DISTINCT ON (wallet_address) * FROM (
  SELECT wallet_address, performance_tier, total_realized_pnl_usd, win_rate_percent, total_trades FROM gold
  WHERE trade_frequency_per_day IS NULL OR trade_frequency_per_day <= 10
  ORDER BY {WEIGHT_CASE} DESC, total_realized_pnl_usd DESC NULLS FIRST, wallet_address
  LIMIT 500) t"""

TIER_DISTRIBUTION_SQL = gold_sql() + """SELECT performance_tier, COUNT(*) AS trader_count FROM gold GROUP BY 1"""

GOLD_SUMMARY_SQL = gold_sql() + """SELECT
  CAST(COUNT(*) FILTER (WHERE auto_follow_eligible) AS BIGINT) AS auto_follow_count,
  CAST(COUNT(*) FILTER (WHERE verified_performance) AS BIGINT) AS verified_count,
  CAST(COUNT(*) FILTER (WHERE coverage_confidence = 'High') AS BIGINT) AS high_confidence,
  CAST(COUNT(*) FILTER (WHERE coverage_confidence = 'Good') AS BIGINT) AS good_confidence,
  CAST(COUNT(*) FILTER (WHERE coverage_confidence = 'Acceptable') AS BIGINT) AS acceptable_confidence,
  CAST(COUNT(*) FILTER (WHERE coverage_confidence = 'Low') AS BIGINT) AS low_confidence
FROM gold"""

PERCENTILES_SQL = f"""WITH pnl AS ({WALLET_PNL_SQL}), e AS (SELECT * FROM pnl WHERE smart_trader_eligible)
SELECT {R('quantile_cont(smart_trader_score, 0.95)', 4)} AS score_p95,
       {R('quantile_cont(smart_trader_score, 0.80)', 4)} AS score_p80,
       {R('quantile_cont(smart_trader_score, 0.60)', 4)} AS score_p60,
       {R('quantile_cont(total_realized_pnl_usd, 0.95)', 4)} AS pnl_p95,
       {R('quantile_cont(total_realized_pnl_usd, 0.80)', 4)} AS pnl_p80,
       {R('quantile_cont(total_realized_pnl_usd, 0.60)', 4)} AS pnl_p60
FROM e"""
