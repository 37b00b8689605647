"""Holder (whale) operators: band selection per token and wallet rollups
(W10, A1, A2, J8, D2, D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import HolderBand
from cairn.functions.scan import Run, ranged_scan, split_hot, window_scan


def holder_band(holders: DataFrame, tokens: DataFrame, band: HolderBand | None = None,
                hot_threshold: int | None = None) -> DataFrame:
    """Per token, rank holders by amount desc (address breaks ties),
    skip the top pct (int(holders x pct / 100)) and take the next K, where K
    shrinks to max(1, holders - skip) at the tail; a token without a holder
    count takes its first ``top_holders_limit``.

    ``tokens``: token_address, holder_count. Ranking is a running count per
    token; tokens with more holders than one task should sort take the
    range-partitioned form (``cairn.functions.scan``)."""
    b = band or HolderBand()
    order = [(F.col("ui_amount"), False), (F.col("wallet_address"), True)]
    runs = {"holder_rank": Run("sum", F.lit(1))}
    cold, hot = split_hot(holders, ["token_address"], hot_threshold)
    ranked = window_scan(cold, ["token_address"], order, runs)
    if hot is not None:   # tokens with very many holders: range-partitioned ranking
        ranked = ranked.unionByName(ranged_scan(hot, ["token_address"], order, runs))
    ranked = ranked.withColumn("holder_rank", F.col("holder_rank").cast("int"))
    t = tokens.select("token_address", F.col("holder_count").cast("long").alias("holder_count"))
    j = ranked.join(t, "token_address", "left")
    hc = F.col("holder_count")
    has = hc.isNotNull() & (hc > 0)
    skip = F.floor(hc * F.lit(b.skip_top_percentage / 100.0)).cast("long")
    take = F.when(skip + b.holders_per_token > hc, F.greatest(F.lit(1), hc - skip)) \
        .otherwise(F.lit(b.holders_per_token))
    lo = F.when(has, skip).otherwise(F.lit(0))
    hi = F.when(has, skip + take).otherwise(F.lit(b.top_holders_limit))
    r = F.col("holder_rank")
    return j.where((r > lo) & (r <= hi)).drop("holder_count")


def holder_rollup(holders: DataFrame) -> DataFrame:
    """A1: unprocessed holder rows per wallet: token count and total ui
    amount (partial aggregates). The token and symbol lists of a wallet
    are the rows of :func:`holder_rollup_tokens`."""
    u = holders.where(F.col("silver_processed") == F.lit(False))
    return u.groupBy("wallet_address").agg(
        F.count("token_address").alias("tokens_held_count"),
        F.sum("ui_amount").alias("total_tokens_held"),
    )


def holder_rollup_tokens(holders: DataFrame) -> DataFrame:
    """A1 lists as rows: (wallet, token, symbol) of the unprocessed rows."""
    return holders.where(F.col("silver_processed") == F.lit(False)).select(
        "wallet_address", "token_address", "token_symbol")


def holder_record(holders: DataFrame, now=None) -> DataFrame:
    """A2 (+J8): silver_whales rows for the wallets of A1. Totals cover *all*
    rows of the wallet while the count comes from A1 (unprocessed rows only),
    as in the reference. The source-token list is :func:`holder_source_tokens`."""
    roll = holder_rollup(holders).select("wallet_address", "tokens_held_count")
    all_rows = holders.join(roll.select("wallet_address"), "wallet_address", "left_semi")
    detail = all_rows.groupBy("wallet_address").agg(
        F.sum(F.coalesce("ui_amount", F.lit(0.0))).alias("total_value_held"),
        F.count(F.lit(1)).alias("source_token_count"))
    out = roll.join(detail, "wallet_address")
    extra = {"transactions_processed": F.lit(False), "pnl_processed": F.lit(False)}
    if now is not None:
        extra.update({"first_seen_at": now, "last_updated_at": now})
    return out.withColumns(extra)


def holder_source_tokens(holders: DataFrame) -> DataFrame:
    """A2 source-token entries as rows: {token, symbol, ui_amount, rank} of
    every row of the A1 wallets (null amount -> 0, null rank -> 0)."""
    roll = holder_rollup(holders).select("wallet_address")
    return holders.join(roll, "wallet_address", "left_semi").select(
        "wallet_address", "token_address", "token_symbol",
        F.coalesce("ui_amount", F.lit(0.0)).alias("ui_amount"),
        F.coalesce(F.col("rank").cast("long"), F.lit(0)).alias("rank"))


def holder_filters(whales: DataFrame, min_tokens_held: int = 1, min_total_value: float = 0.0,
                   excluded: tuple = (), max_whales: int | None = None) -> DataFrame:
    """D2 (declared, never applied by the reference): minimum tokens and
    value, excluded addresses, and a cap taking the largest holders first."""
    w = whales.where((F.col("tokens_held_count") >= min_tokens_held)
                     & (F.coalesce("total_value_held", F.lit(0.0)) >= min_total_value))
    if excluded:
        w = w.where(~F.col("wallet_address").isin(*excluded))
    if max_whales:
        w = w.orderBy(F.col("total_value_held").desc_nulls_last(), "wallet_address").limit(max_whales)
    return w


def min_holding_share(holders: DataFrame, min_pct: float = 0.5) -> DataFrame:
    """D3 (declared): holders whose share of the token's summed holdings is at
    least ``min_pct`` percent (share of the sum: ours)."""
    tot = holders.groupBy("token_address").agg(F.sum("ui_amount").alias("_tot"))
    j = holders.join(tot, "token_address")
    share = F.when(F.col("_tot") > 0, F.col("ui_amount") / F.col("_tot") * 100)
    return j.withColumn("holding_percent", share).where(F.col("holding_percent") >= min_pct).drop("_tot")
