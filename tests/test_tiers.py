"""Tier assignment, tier score and flags on handmade metric rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cairn.config import RankConfig
from cairn.functions.expr import ts_ntz
from cairn.operators.tiers import performance_tier, rank_traders, tier_score

COLS = ("wallet_address string, coverage_ratio_percent double, total_roi_percent double, win_rate_percent double, "
        "sharpe_ratio double, total_realized_pnl_usd double, meaningful_trades long, "
        "trade_frequency_per_day double, max_drawdown_percent double")


def tier_of(spark, row, compat=True):
    df = spark.createDataFrame([("w",) + row], COLS)
    return df.select(performance_tier(RankConfig(compat=compat)).alias("t")).first().t


ELITE = (85.0, 50.0, 70.0, 1.5, 10000.0, 50, 0.5, 20.0)


def test_elite_boundary_inclusive(spark):
    assert tier_of(spark, ELITE) == "ELITE"
    below = (85.0, 50.0, 70.0, 1.5, 9999.99, 50, 0.5, 20.0)
    assert tier_of(spark, below) == "STRONG"


def test_experimental_reached(spark):
    # fails Q (win 80 ok, but trades 15 < ... ) -> X: cov 60, roi 100, win 75, sharpe 2, pnl 1000, trades 15
    row = (65.0, 150.0, 80.0, 2.5, 1500.0, 15, 10.0, 30.0)
    assert tier_of(spark, row) == "EXPERIMENTAL"


def test_roi_nonpositive_skips_roi_test(spark):
    row = (85.0, -5.0, 70.0, 1.5, 10000.0, 50, 0.5, 20.0)
    assert tier_of(spark, row) == "ELITE"


def test_zero_drawdown_compat_fails_all(spark):
    row = (85.0, 50.0, 70.0, 1.5, 10000.0, 50, 0.5, 0.0)
    assert tier_of(spark, row, compat=True) == "UNQUALIFIED"
    assert tier_of(spark, row, compat=False) == "ELITE"


@pytest.mark.parametrize("freq,penalty", [(10.0, 1.0), (10.1, 0.9), (0.2, 1.0), (0.19, 0.95)])
def test_activity_penalty(spark, freq, penalty):
    row = (100.0, 0.0, 0.0, 0.0, 0.0, 0, freq, 50.0)
    df = spark.createDataFrame([("w",) + row], COLS)
    s = df.select(tier_score(F.lit("QUALIFIED")).alias("s")).first().s
    assert s == round(0.35 * penalty * 100, 2)


def test_rank_traders_ranks(spark):
    rows = [(f"w{i}", 85.0, 50.0, 70.0, 1.5, 10000.0 + i, 50, 0.5 + i / 100, 20.0) for i in range(5)]
    df = spark.createDataFrame(rows, COLS).withColumns({
        "smart_trader_eligible": F.lit(True), "smart_trader_score": F.lit(0.5),
        "first_trade_at": F.lit(datetime(2023, 12, 1)).cast("timestamp_ntz"),
        "last_trade_at": F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")})
    for c in ["avg_roi_percent", "median_roi_percent", "total_volume_usd", "matched_volume_usd",
              "matched_cost_basis_usd", "avg_trade_size_usd"]:
        df = df.withColumn(c, F.lit(1.0))
    for c in ["matched_trades", "total_trades", "trading_days", "tokens_traded_count"]:
        df = df.withColumn(c, F.lit(1).cast("long"))
    g = rank_traders(df, ts_ntz("2024-02-01 00:00:00")).orderBy("overall_rank").collect()
    assert [r.wallet_address for r in g] == ["w4", "w3", "w2", "w1", "w0"]   # score tie -> pnl desc
    assert [r.tier_rank for r in g] == [1, 2, 3, 4, 5]
    assert all(r.auto_follow_eligible for r in g)                            # 62 days, coverage 85
