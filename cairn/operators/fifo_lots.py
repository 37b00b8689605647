"""What every sell consumed, lot by lot - an interval-overlap join without a join.

Inside (wallet, token) the buys' lot ranges (B - q, B] and the sells' consumed ranges (M_prev, M] each
tile a line from 0 on without gaps. So both sides' ranges are merged by where they start: in that order
the lot and the sell in force are the last ones seen, every overlapping pair appears at the later of its
two starts and nowhere else with an overlap above 0, and there are at most as many pairs as lots and
sells together. A range join would compare every sell with every lot of its key instead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.expr import MONEY, QTY
from cairn.functions.scan import Run, scans
from cairn.operators.fifo import BUY, EVENT_ORDER, KEY, fifo_match, split_legs


def fifo_lots(fifo: DataFrame, ranged: bool = False, slices: int | None = None) -> DataFrame:
    """One row per (sell, consumed lot) from the rows of ``fifo_match``: the KEY, ``sell_*`` and ``lot_*``
    event columns, quantity, both prices, cost, proceeds and pnl.

    Cost and proceeds are differences of running values, so they add up to the sell's ``cost_basis`` and
    ``matched_proceeds`` to the last digit; quantities add up to ``matched_quantity``. A sell that found
    nothing to consume has no row. The windows reuse the partitioning by wallet of ``fifo_match``;
    ``ranged=True`` runs the same scans in slices, for hot wallets."""
    scan = scans(ranged, slices)
    is_buy = F.col("side") == BUY
    event = [(F.col(c), True) for c in EVENT_ORDER]
    rows = fifo.where(is_buy | (F.col("matched_quantity") > 0)).select(
        *KEY, *EVENT_ORDER, "side", "quantity", "price", "lot_end", "matched_quantity", "matched_end")
    rows = rows.select(
        *KEY, *EVENT_ORDER, is_buy.cast("int").alias("_kind"),
        F.when(is_buy, (F.col("lot_end") - F.col("quantity")).cast(QTY)).otherwise((F.col("matched_end") - F.col("matched_quantity")).cast(QTY)).alias("_start"),
        F.struct(*EVENT_ORDER, F.when(is_buy, F.col("lot_end")).otherwise(F.col("matched_end")).cast(QTY).alias("end"),
                 F.when(is_buy, (F.col("lot_end") - F.col("quantity")).cast(QTY)).otherwise((F.col("matched_end") - F.col("matched_quantity")).cast(QTY)).alias("start"),
                 "price").alias("_range"))
    buys = F.col("_kind") == 1
    rows = scan(rows, KEY, [(F.col("_start"), True), (F.col("_kind"), True)] + event,
                {"_lot": Run("last", F.when(buys, F.col("_range"))), "_sell": Run("last", F.when(~buys, F.col("_range")))})
    lot, sell = F.col("_lot"), F.col("_sell")
    begin, end = F.greatest(lot["start"], sell["start"]), F.least(lot["end"], sell["end"])

    def money(side) -> F.Column:  # running value at the end less the one at the beginning
        at = lambda x: ((x - side["start"]).cast(QTY) * side["price"]).cast(MONEY)
        return (at(end) - at(begin)).cast(MONEY)

    out = rows.where(lot.isNotNull() & sell.isNotNull()).select(
        *KEY, *[sell[c].alias(f"sell_{c}") for c in EVENT_ORDER], *[lot[c].alias(f"lot_{c}") for c in EVENT_ORDER],
        (end - begin).cast(QTY).alias("quantity"), sell["price"].alias("sell_price"), lot["price"].alias("lot_price"),
        money(lot).alias("cost"), money(sell).alias("proceeds"))
    return out.where(F.col("quantity") > 0).withColumn("pnl", (F.col("proceeds") - F.col("cost")).cast(MONEY))


def fifo_lots_split(legs: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """``fifo_lots`` of trade legs, with the wallets of more legs than the threshold
    (``cairn.skew.hotKeyRows``) in the range-sliced form."""
    cold, hot, rows = split_legs(legs, hot_threshold)
    out = fifo_lots(fifo_match(cold, rows=rows))
    return out if hot is None else out.unionByName(fifo_lots(fifo_match(hot, ranged=True), ranged=True))


def holding_periods(lots: DataFrame) -> DataFrame:
    """Per (wallet, token): how long the sold units were held, from their lots: quantity-weighted mean,
    shortest and longest holding in seconds, and the lots touched per sell."""
    held = F.timestamp_diff("SECOND", F.col("lot_timestamp"), F.col("sell_timestamp"))
    weighted = F.sum((F.col("quantity") * held).cast("decimal(38,9)"))
    return lots.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("matches"), F.count_distinct("sell_timestamp", "sell_transaction_hash", "sell_leg").alias("sells"),
        F.sum("quantity").cast("double").alias("quantity"), F.min(held).alias("min_held_seconds"), F.max(held).alias("max_held_seconds"),
        (weighted.cast("double") / F.sum("quantity").cast("double")).alias("avg_held_seconds"))
