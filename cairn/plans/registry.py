"""Registered queries: id -> (spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir), reads whole driver tables through the
fixture projections and returns a DataFrame. Most run nothing before the
result is read; range-sliced ranks, hot-key checks, stores and streams need
jobs of their own and say so."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans import fixtures as fx
from cairn.plans import sql_gold, sql_pnl

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ PnL core
@register("wallet_pnl", sql_pnl.WALLET_PNL_SQL)
def q_wallet_pnl(spark, sf_dir):
    from cairn.plans.pnl import wallet_pnl_from_legs
    t = fx.trades_fx(spark, sf_dir)
    return wallet_pnl_from_legs(t, t.select("wallet_address", "timestamp"))


@register("fifo_match", sql_pnl.FIFO_MATCH_SQL)
def q_fifo_match(spark, sf_dir):
    from cairn.operators.fifo import fifo_split, sells
    s = sells(fifo_split(fx.trades_fx(spark, sf_dir)))
    return s.select(
        "wallet_address", "token_address", "transaction_hash", "leg", "timestamp",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("price").cast("double").alias("price"),
        F.col("matched_quantity").cast("double").alias("matched_quantity"),
        F.col("unmatched_quantity").cast("double").alias("unmatched_quantity"),
        F.round("cost_basis", 6).cast("double").alias("cost_basis"),
        F.round("pnl", 6).cast("double").alias("pnl"),
        "is_win", "is_loss",
    )


@register("position_summary", sql_pnl.POSITIONS_SQL)
def q_position_summary(spark, sf_dir):
    from cairn.operators.fifo import fifo_split
    from cairn.operators.metrics import position_summary
    return position_summary(fifo_split(fx.trades_fx(spark, sf_dir)))


# ----------------------------------------------------------------------- gold
def _gold(spark, sf_dir):
    from cairn.functions.expr import ts_ntz
    from cairn.operators.tiers import rank_traders
    return rank_traders(q_wallet_pnl(spark, sf_dir), ts_ntz(fx.NOW_EVENTS))


@register("rank_traders", sql_gold.RANK_TRADERS_SQL)
def q_rank_traders(spark, sf_dir):
    return _gold(spark, sf_dir)


@register("push_list", sql_gold.PUSH_LIST_SQL)
def q_push_list(spark, sf_dir):
    from cairn.operators.tiers import push_list
    return push_list(_gold(spark, sf_dir))


@register("push_list_capped", sql_gold.PUSH_LIST_CAPPED_SQL)
def q_push_list_capped(spark, sf_dir):
    from cairn.operators.tiers import push_list_capped
    return push_list_capped(_gold(spark, sf_dir))


@register("tier_distribution", sql_gold.TIER_DISTRIBUTION_SQL)
def q_tier_distribution(spark, sf_dir):
    from cairn.operators.tiers import tier_breakdown
    return tier_breakdown(_gold(spark, sf_dir))


@register("gold_summary", sql_gold.GOLD_SUMMARY_SQL)
def q_gold_summary(spark, sf_dir):
    g = _gold(spark, sf_dir)
    ci = lambda cond, name: F.count_if(cond).alias(name)
    c = F.col("coverage_confidence")
    return g.agg(ci(F.col("auto_follow_eligible"), "auto_follow_count"),
                 ci(F.col("verified_performance"), "verified_count"),
                 ci(c == "High", "high_confidence"), ci(c == "Good", "good_confidence"),
                 ci(c == "Acceptable", "acceptable_confidence"), ci(c == "Low", "low_confidence"))


@register("score_percentiles", sql_gold.PERCENTILES_SQL)
def q_score_percentiles(spark, sf_dir):
    from cairn.operators.reports import percentiles
    from cairn.operators.tiers import eligible_wallets
    e = eligible_wallets(q_wallet_pnl(spark, sf_dir))
    return percentiles(e, {"score": "smart_trader_score", "pnl": "total_realized_pnl_usd"},
                       (0.95, 0.80, 0.60))


def _load_all() -> None:
    """Import the modules that register the remaining query families."""
    from cairn.plans import q_clean, q_hot, q_lots, q_options, q_quarantine, q_reports, q_sources, q_store, q_stream, q_stream_state  # noqa: F401
