"""Operators the reference declares in its schema or configuration but never
computes (D1-D9, W8, W9). Where it leaves a formula open, the choice made
here is stated in the docstring ("ours")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.config import TierCriteria
from cairn.functions.expr import round_half_up
from cairn.functions.ranking import row_number_ordered

# The second, stricter tier table of the pipeline YAML
# (coverage %, roi %, win rate %, sharpe, pnl USD, meaningful trades,
#  frequency min/max per day, max drawdown %).
CONFIG_TIERS = (
    TierCriteria("ELITE", 85, 100, 70, 2.5, 10000, 50, 0.5, 5, 20),
    TierCriteria("STRONG", 80, 60, 65, 2.0, 5000, 30, 0.3, 7, 25),
    TierCriteria("PROMISING", 75, 40, 60, 1.5, 2000, 20, 0.2, 10, 30),
    TierCriteria("QUALIFIED", 70, 20, 55, 1.0, 500, 10, 0.1, 15, 40),
    TierCriteria("EXPERIMENTAL", 60, 200, 75, 3.0, 1000, 15, 0.1, 20, 35),
)

# YAML performance tiers (min pnl USD, min roi %, min win rate %).
SNAPSHOT_TIERS = (("ELITE", 10000, 50, 70), ("STRONG", 5000, 25, 60),
                  ("PROMISING", 1000, 15, 50), ("QUALIFIED", 100, 5, 40))

# Token selection weights of the pipeline YAML.
SELECTION_WEIGHTS = {"liquidity": 0.3, "volume_24h_usd": 0.25, "price_change_24h_percent": 0.2,
                     "holder": 0.15, "trade_24h_count": 0.1}


def token_selection_score(tokens: DataFrame, min_holders: int = 100, min_volume_24h: float = 50_000,
                          selection_ratio: float = 1.0, max_selected: int | None = None,
                          weights: dict[str, float] | None = None) -> DataFrame:
    """Filter by holders and 24h volume, score = weighted min-max
    normalised inputs (normalisation within the batch and null -> 0: ours),
    keep the best ceil(n x ratio), at most ``max_selected`` if given. Batch min/max and
    n are scalar subqueries."""
    w = weights or SELECTION_WEIGHTS
    c = tokens.where((F.col("holder") >= min_holders) & (F.col("volume_24h_usd") >= min_volume_24h))
    score = None
    for col, wt in w.items():
        x = F.col(col).cast("double")
        lo = c.select(F.min(x)).scalar()
        hi = c.select(F.max(x)).scalar()
        norm = F.when(x.isNull() | (hi == lo), F.lit(0.0)).otherwise((x - lo) / (hi - lo))
        term = norm * wt
        score = term if score is None else score + term
    n = c.select(F.count(F.lit(1))).scalar()
    keep = F.ceil(n * F.lit(selection_ratio))
    if max_selected is not None:
        keep = F.least(keep, F.lit(max_selected))
    scored = c.withColumn("selection_score", score)
    ranked = row_number_ordered(scored, [F.col("selection_score").desc(), F.col("token_address")],
                                "selection_rank")
    return ranked.where(F.col("selection_rank") <= keep)


def lookback(transactions: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Drop transactions older than ``days``."""
    return transactions.where(F.col("timestamp") >= now - F.make_dt_interval(F.lit(days)))


def tier_limits(gold: DataFrame, max_per_tier: int = 100, min_total: int = 10) -> DataFrame:
    """At most ``max_per_tier`` traders per tier (by tier rank), and a
    flag whether the run reached ``min_total`` traders."""
    total = gold.select(F.count(F.lit(1))).scalar()
    return (gold.where(F.col("tier_rank") <= max_per_tier)
            .withColumn("meets_min_total", total >= min_total))


def snapshot_tier(pnl: Column, roi: Column, win: Column) -> Column:
    e = None
    for name, p, r, w in SNAPSHOT_TIERS:
        cond = (pnl >= p) & (roi >= r) & (win >= w)
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return e.otherwise("UNQUALIFIED")


def daily_snapshots(fifo: DataFrame) -> DataFrame:
    """D7 input: per wallet and trading day, cumulative realized pnl, cost,
    roi, win rate and meaningful trades at the end of that day (one
    aggregation per (wallet, day), then a running window over the days of a
    wallet: bounded by the number of days)."""
    day = F.to_date("timestamp").alias("performance_date")
    d = fifo.groupBy("wallet_address", day).agg(
        F.sum("pnl").alias("pnl"), F.sum("cost_basis").alias("cost"),
        F.count_if("is_win").alias("wins"), F.count_if("is_loss").alias("losses"))
    w = (Window.partitionBy("wallet_address").orderBy("performance_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c = d.select("wallet_address", "performance_date",
                 F.sum("pnl").over(w).alias("cum_pnl"), F.sum("cost").over(w).alias("cum_cost"),
                 F.sum("wins").over(w).alias("cum_wins"), F.sum("losses").over(w).alias("cum_losses"))
    roi = F.when(F.col("cum_cost") > 0, F.col("cum_pnl").cast("double") / F.col("cum_cost").cast("double") * 100) \
        .otherwise(0.0)
    meaningful = F.col("cum_wins") + F.col("cum_losses")
    win = F.when(meaningful > 0, F.col("cum_wins") / meaningful * 100).otherwise(0.0)
    pnl = F.round("cum_pnl", 2).cast("double")
    return c.select(
        "wallet_address", "performance_date",
        pnl.alias("total_realized_pnl_usd"), round_half_up(roi, 2).alias("total_roi_percent"),
        round_half_up(win, 2).alias("win_rate_percent"), meaningful.cast("long").alias("meaningful_trades"),
        snapshot_tier(pnl, round_half_up(roi, 2), round_half_up(win, 2)).alias("performance_tier"))


def performance_history(snapshots: DataFrame, retention_days: int | None = 90,
                        now: Column | None = None) -> DataFrame:
    """W8 + D7: 7-day change of roi and pnl and the tier change against the
    snapshot exactly 7 days earlier (exact-day match: ours), via a RANGE
    frame on the day number; snapshots older than the retention are dropped."""
    dn = F.unix_date(F.col("performance_date"))
    w7 = Window.partitionBy("wallet_address").orderBy(dn).rangeBetween(-7, -7)
    prev_roi = F.first("total_roi_percent").over(w7)
    prev_pnl = F.first("total_realized_pnl_usd").over(w7)
    prev_tier = F.first("performance_tier").over(w7)
    out = snapshots.select(
        "*",
        round_half_up(F.col("total_roi_percent") - prev_roi, 2).alias("roi_change_7d"),
        round_half_up(F.col("total_realized_pnl_usd") - prev_pnl, 2).alias("pnl_change_7d"),
        F.when(prev_tier.isNull(), F.lit(None))
        .when(prev_tier == F.col("performance_tier"), F.lit("unchanged"))
        .otherwise(F.concat(prev_tier, F.lit(" -> "), F.col("performance_tier"))).alias("tier_change"))
    if retention_days is not None and now is not None:
        out = out.where(F.col("performance_date") >= F.to_date(now - F.make_dt_interval(F.lit(retention_days))))
    return out


def top_tokens(positions: DataFrame, n: int = 5, hot_threshold: int | None = None) -> DataFrame:
    """A trader's best ``n`` tokens by realized pnl (n = 5: ours): a
    running count per wallet in pnl order; wallets with very many positions
    take the range-partitioned form. The positions are stored first (jobs run
    while the plan is built): the hot check and the ranking both read them."""
    from cairn.functions.scan import Run, cut, ranged_scan, split_hot, window_scan
    positions = cut(positions)
    order = [(F.col("realized_pnl"), False), (F.col("token_address"), True)]
    runs = {"token_rank": Run("sum", F.lit(1), cast="int")}
    cold, hot = split_hot(positions, ["wallet_address"], hot_threshold)
    ranked = window_scan(cold, ["wallet_address"], order, runs)
    if hot is not None:
        ranked = ranked.unionByName(ranged_scan(hot, ["wallet_address"], order, runs))
    return ranked.where(F.col("token_rank") <= n)


def volatility_score(fifo: DataFrame, digits: int = 4) -> DataFrame:
    """Population standard deviation of matched trade ROI per wallet (ours)."""
    return fifo.where(F.col("trade_roi").isNotNull()).groupBy("wallet_address").agg(
        round_half_up(F.stddev_pop("trade_roi"), digits).alias("volatility_score"))


def last_30d(fifo: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Roi, matched trades, win rate and pnl of the last ``days`` days
    (filter the FIFO output, then P7/P8/P13)."""
    recent = fifo.where(F.col("timestamp") >= now - F.make_dt_interval(F.lit(days)))
    g = recent.groupBy("wallet_address").agg(
        F.sum("pnl").alias("pnl"), F.sum("cost_basis").alias("cost"),
        F.count_if("is_matched").alias("trades"), F.count_if("is_win").alias("wins"),
        F.count_if("is_loss").alias("losses"))
    meaningful = F.col("wins") + F.col("losses")
    return g.select(
        "wallet_address",
        round_half_up(F.when(F.col("cost") > 0, F.col("pnl").cast("double") / F.col("cost").cast("double") * 100)
                      .otherwise(0.0), 2).alias("last_30d_roi_percent"),
        F.col("trades").cast("long").alias("last_30d_trades"),
        round_half_up(F.when(meaningful > 0, F.col("wins") / meaningful * 100).otherwise(0.0), 2)
        .alias("last_30d_win_rate"),
        F.round("pnl", 2).cast("double").alias("last_30d_pnl_usd"))
