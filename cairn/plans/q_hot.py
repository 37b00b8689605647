"""Forced hot-key forms: registered queries once more through the range-sliced
scans and ranks, against the same DuckDB SQL as their ordinary forms. These
entries store slices (jobs) while the plan is built."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions.expr import ts_ntz
from cairn.plans import fixtures as fx
from cairn.plans import q_clean, q_options, registry
from cairn.plans.registry import ORACLE, register


@register("fifo_match_hot", ORACLE["fifo_match"])
def q_fifo_match_hot(spark, sf_dir):
    from cairn.operators.fifo import fifo_split, sells
    s = sells(fifo_split(fx.trades_fx(spark, sf_dir), hot_threshold=0))
    return s.select(
        "wallet_address", "token_address", "transaction_hash", "leg", "timestamp",
        *[F.col(c).cast("double").alias(c) for c in ("quantity", "price", "matched_quantity", "unmatched_quantity")],
        *[F.round(c, 6).cast("double").alias(c) for c in ("cost_basis", "pnl")], "is_win", "is_loss")


@register("wallet_pnl_hot", ORACLE["wallet_pnl"])
def q_wallet_pnl_hot(spark, sf_dir):
    from cairn.plans.pnl import wallet_pnl_from_legs
    t = fx.trades_fx(spark, sf_dir)
    return wallet_pnl_from_legs(t, t.select("wallet_address", "timestamp"), hot_threshold=0)


@register("holder_band_hot", ORACLE["holder_band"])
def q_holder_band_hot(spark, sf_dir):
    from cairn.operators.holders import holder_band
    h = fx.holders_fx(spark, sf_dir)
    return holder_band(h, q_clean._holder_tokens(h), q_clean.BAND, hot_threshold=0)


@register("top_tokens_hot", ORACLE["top_tokens"])
def q_top_tokens_hot(spark, sf_dir):
    from cairn.operators.metrics import position_summary
    from cairn.operators.options import top_tokens
    return top_tokens(position_summary(q_options._fifo(spark, sf_dir)), 5, hot_threshold=0)


@register("rank_traders_ranged", ORACLE["rank_traders"])
def q_rank_traders_ranged(spark, sf_dir):
    from cairn.operators.tiers import rank_traders
    return rank_traders(registry.q_wallet_pnl(spark, sf_dir), ts_ntz(fx.NOW_EVENTS), single_task_rows=0)
