"""Silver wallet-PnL job: ready wallets -> their transactions -> legs -> FIFO
-> metrics. One shuffle by wallet for the trade work plus one aggregation of
the transaction spans; no per-wallet loop (the reference's N+1 lookups become
one semi join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import FIFO_METHODS, PnlConfig
from cairn.operators.fifo import fifo_match, trade_legs
from cairn.functions.scan import cut, split_hot_by_counts, total
from cairn.operators.metrics import transaction_span, wallet_metrics, wallet_trade_stats


def check_method(cfg: PnlConfig) -> None:
    """P20: only FIFO labels are accepted."""
    if cfg.method not in FIFO_METHODS:
        raise ValueError(f"unsupported calculation method {cfg.method!r}; use one of {FIFO_METHODS}")


def min_history(transactions: DataFrame, min_transactions: int) -> tuple[DataFrame, DataFrame]:
    """split the per-wallet span into wallets with enough history and
    the ones recorded as skipped."""
    span = transaction_span(transactions)
    enough = F.col("transaction_count") >= min_transactions
    return span.where(enough), span.where(~enough).withColumn("state", F.lit("skipped"))


def wallet_pnl_from_legs(legs: DataFrame, transactions: DataFrame,
                         cfg: PnlConfig | None = None, hot_threshold: int | None = None) -> DataFrame:
    """P2-P19 over already-extracted legs; ``transactions`` supplies the
    wallet set and the first/last trade times (wallet_address, timestamp)."""
    cfg = cfg or PnlConfig()
    check_method(cfg)
    ready = cut(min_history(transactions, cfg.min_transactions)[0])  # a row a wallet, read four times
    legs = legs.join(ready.select("wallet_address"), "wallet_address", "left_semi")
    # hot wallets (more legs than one task should scan) take the range-
    # partitioned form of the same scans; everything else keeps the single
    # hash shuffle by wallet. The check reads the per-wallet transaction
    # counts the job needs anyway (a transaction has at most two legs).
    cold, hot = split_hot_by_counts(legs, ready, ["wallet_address"], "transaction_count",
                                    hot_threshold, rows_per_count=2)
    stats = wallet_trade_stats(fifo_match(cold, rows=2 * total(ready, "transaction_count")))
    if hot is not None:
        stats = stats.unionByName(wallet_trade_stats(fifo_match(hot, ranged=True), ranged=True))
    return wallet_metrics(None, ready.drop("transaction_count"), cfg, stats=stats)


def wallet_pnl(transactions: DataFrame, ready_wallets: DataFrame | None = None,
               cfg: PnlConfig | None = None, hot_threshold: int | None = None) -> DataFrame:
    """The full silver job on bronze transactions (J7: one semi join instead
    of a lookup per wallet)."""
    if ready_wallets is not None:
        transactions = transactions.join(ready_wallets.select("wallet_address"),
                                         "wallet_address", "left_semi")
    return wallet_pnl_from_legs(trade_legs(transactions), transactions, cfg, hot_threshold)
