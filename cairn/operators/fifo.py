"""FIFO cost-basis matching of sells against buys, without a loop.

Per (wallet, token), in event order, with B/S the running bought/sold
quantity and D = B - S:

* unmatched so far  U = max(0, -min(D))     (a queue that cannot go below 0)
* matched so far    M = S - U
* a sell consumes exactly the bought range (M_prev, M] of the FIFO lot
  sequence, so its cost is F(M) - F(M_prev) where F(x) is the cost of the
  first x units bought.  With k the lot whose range (L_k, B_k] holds x,
  F(x) = CB_(k-1) + (x - L_k) * price_k.

Everything is window functions over one hash partitioning by wallet: no
join, no Python worker, no per-row state. Quantities and money are
fixed-point decimals so the prefix-sum differences are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import MEANINGFUL_PNL_USD
from cairn.functions.expr import MONEY, PRICE, QTY
from cairn.functions.scan import Run, cut, scans, split_hot_by_counts, total

KEY = ["wallet_address", "token_address"]
# largest leg in USD whose sums stay inside DECIMAL(38,10); what lies beyond is
# returned by trade_leg_rejects, never dropped silently
MAX_NOTIONAL_USD = 1e20
EVENT_ORDER = ["timestamp", "transaction_hash", "leg"]
LEGS_PER_TASK = 250_000  # the sorts and windows of a task hold its legs several times over
BUY, SELL = "to", "from"


def _valid_legs(transactions: DataFrame) -> DataFrame:
    """Both legs of every transaction that pass F12, with the fixed-point forms
    and, where those cannot hold the leg, the reason."""
    def side(prefix: str, idx: int):
        addr = F.col(f"{prefix}_address")
        sym = F.col(f"{prefix}_symbol")
        return F.struct(
            F.lit(idx).alias("leg"),
            addr.alias("token_address"),
            F.when(sym.isNull() | (sym == ""), F.substring(addr, 1, 8)).otherwise(sym)
            .alias("token_symbol"),
            F.col(f"{prefix}_type_swap").alias("side"),
            F.col(f"{prefix}_ui_change_amount").cast("double").alias("amount"),
            F.col(f"{prefix}_nearest_price").cast("double").alias("px"),
        )

    legs = transactions.select(
        "wallet_address", "transaction_hash", "timestamp",
        F.explode(F.array(side("base", 0), side("quote", 1))).alias("l"),
    ).select("wallet_address", "transaction_hash", "timestamp", "l.*")
    valid = (
        F.col("token_address").isNotNull() & (F.col("token_address") != "")
        & F.col("amount").isNotNull() & ~F.isnan("amount") & (F.col("amount") != 0)
        & F.col("px").isNotNull() & ~F.isnan("px") & (F.col("px") > 0)
    )
    q, p = F.abs("amount").try_cast(QTY), F.col("px").try_cast(PRICE)
    reason = (F.when(q.isNull(), "quantity too large").when(q == 0, "quantity too small")
              .when(p.isNull(), "price too large").when(p == 0, "price too small")
              .when(F.abs("amount") * F.col("px") >= MAX_NOTIONAL_USD, "value too large"))
    return legs.where(valid).select(
        "wallet_address", "token_address", "token_symbol", "timestamp", "transaction_hash",
        "leg", "side", "amount", "px", q.alias("quantity"), p.alias("price"), reason.alias("reason"))


def trade_legs(transactions: DataFrame) -> DataFrame:
    """P1 + F12: bronze transactions -> valid trade legs (base leg 0, quote leg 1).

    A leg counts only if its address is non-empty, the amount is non-null and
    non-zero and the price is non-null and > 0; quantity = |amount|.
    The symbol falls back to the first 8 characters of the address. The few
    legs that pass but do not fit the fixed-point types are the rows of
    :func:`trade_leg_rejects`."""
    return _valid_legs(transactions).where(F.col("reason").isNull()).drop("amount", "px", "reason")


def trade_leg_rejects(transactions: DataFrame) -> DataFrame:
    """Valid legs whose amount, price or value the fixed-point types cannot
    hold, with the raw numbers and the reason: what trade_legs leaves out."""
    return _valid_legs(transactions).where(F.col("reason").isNotNull()).drop("quantity", "price")


def fifo_match(legs: DataFrame, partitioned: bool = False, ranged: bool = False,
               slices: int | None = None, rows: int | None = None) -> DataFrame:
    """P2 (+P3, P4): annotate every buy/sell leg with its FIFO outcome.

    Input: legs with KEY, EVENT_ORDER, side ('to' buy, 'from' sell, other
    ignored), quantity > 0, price > 0.  Output: one row per buy or sell with
    purchase_value (buys), matched_quantity, unmatched_quantity, cost_basis,
    matched_proceeds, unmatched_proceeds, pnl, trade_roi, is_win, is_loss.

    Default form: the input is hash-partitioned by wallet once; every later
    window and aggregation keyed by wallet or (wallet, token) reuses that
    partitioning, so the whole PnL job has a single shuffle. ``ranged=True``
    runs the same scans range-partitioned (for hot wallets, see
    ``cairn.functions.scan``); both forms give identical rows. ``rows``, the
    number of legs where it is known, sets the number of partitions, so that
    a task's share does not grow with the table.
    """
    scan = scans(ranged, slices)
    df = legs.where(F.col("side").isin(BUY, SELL)).select(
        *KEY, "token_symbol", *EVENT_ORDER, "side",
        F.col("quantity").cast(QTY).alias("quantity"),
        F.col("price").cast(PRICE).alias("price"),
    )
    if not partitioned and not ranged:
        many = rows is not None and rows > LEGS_PER_TASK
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(*[max(least, -(-rows // LEGS_PER_TASK))] if many else [], "wallet_address")

    is_buy = F.col("side") == BUY
    zero_q = F.lit(0).cast(QTY)
    order = [(F.col(c), True) for c in EVENT_ORDER]

    buy_q = F.when(is_buy, F.col("quantity")).otherwise(zero_q)
    sell_q = F.when(~is_buy, F.col("quantity")).otherwise(zero_q)
    lot_cost = (F.col("quantity") * F.col("price")).cast(MONEY)
    buy_cost = F.when(is_buy, lot_cost)
    d = (F.col("B") - F.col("S"))
    df = scan(df, KEY, order, {"B": Run("sum", buy_q, cast=QTY), "S": Run("sum", sell_q, cast=QTY),
                               "CB": Run("sum", buy_cost, cast=MONEY), "_pos": Run("sum", F.lit(1))},
              {"_min_d": Run("min", d), "_min_d_prev": Run("min", d, inclusive=False)})
    u = F.greatest(F.lit(0).cast(QTY), -F.col("_min_d"))
    u_prev = F.greatest(F.lit(0).cast(QTY), -F.coalesce(F.col("_min_d_prev"), F.lit(0).cast(QTY)))
    m = (F.col("S") - u).cast(QTY)
    # F(x) lookup in one more sort: buys carry x = L (their lot start, B - q),
    # sells x = M; ordered by x ascending with sells first on ties, the last
    # buy seen is the lot with L < x <= B, so F(x) = CB_before + (x - L) * p.
    # In that order the sells also appear in event order (M never decreases),
    # so F(M_prev) is the previous sell's F in the same sorted pass.
    df = df.withColumns({
        "M": m,
        "M_prev": (F.col("S") - F.when(is_buy, zero_q).otherwise(F.col("quantity")) - u_prev).cast(QTY),
        "_x": F.when(is_buy, (F.col("B") - F.col("quantity")).cast(QTY)).otherwise(m),
        "_kind": F.when(is_buy, 1).otherwise(0),
    })
    x_order = [(F.col("_x"), True), (F.col("_kind"), True)] + order
    f_at_m = F.coalesce(
        (F.col("_lot_cb") + ((F.col("M") - F.col("_lot_start")).cast(QTY) * F.col("_lot_px")).cast(MONEY))
        .cast(MONEY), F.lit(0).cast(MONEY))
    df = scan(df, KEY, x_order, {
        "_lot_start": Run("last", F.when(is_buy, F.col("_x"))),
        "_lot_cb": Run("last", F.when(is_buy, (F.col("CB") - lot_cost).cast(MONEY))),
        "_lot_px": Run("last", F.when(is_buy, F.col("price"))),
    }, {"_prev_f": Run("last", F.when(~is_buy, f_at_m), inclusive=False)})
    prev_f = F.coalesce(F.col("_prev_f"), F.lit(0).cast(MONEY))
    matched = F.when(is_buy, zero_q).otherwise((F.col("M") - F.col("M_prev")).cast(QTY))
    unmatched = F.when(is_buy, zero_q).otherwise((F.col("quantity") - matched).cast(QTY))
    cost = F.when(is_buy, F.lit(0).cast(MONEY)).otherwise((f_at_m - prev_f).cast(MONEY))
    proceeds = (matched * F.col("price")).cast(MONEY)
    pnl = (proceeds - cost).cast(MONEY)
    is_matched = matched > 0
    return df.select(
        *KEY, "token_symbol", *EVENT_ORDER, "side", "quantity", "price",
        F.when(is_buy, (F.col("quantity") * F.col("price")).cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY)).alias("purchase_value"),
        F.when(is_buy, F.lit(0).cast(MONEY))
        .otherwise((F.col("quantity") * F.col("price")).cast(MONEY)).alias("sale_value"),
        matched.alias("matched_quantity"),
        unmatched.alias("unmatched_quantity"),
        cost.alias("cost_basis"),
        F.when(is_buy, F.col("B")).cast(QTY).alias("lot_end"),
        F.when(~is_buy, F.col("M")).alias("matched_end"),
        (F.col("_pos") == 1).alias("first_in_position"),
        proceeds.alias("matched_proceeds"),
        (unmatched * F.col("price")).cast(MONEY).alias("unmatched_proceeds"),
        pnl.alias("pnl"),
        is_matched.alias("is_matched"),
        (unmatched > 0).alias("is_unmatched"),
        # Per-trade ROI when the matched cost is positive
        F.when(is_matched & (cost > 0), pnl.cast("double") / cost.cast("double") * 100).alias("trade_roi"),
        # A win or a loss from MEANINGFUL_PNL_USD on; anything between is neutral
        (is_matched & (pnl >= MEANINGFUL_PNL_USD)).alias("is_win"),
        (is_matched & (pnl <= -MEANINGFUL_PNL_USD)).alias("is_loss"),
    )


def split_legs(legs: DataFrame, hot_threshold: int | None = None) -> tuple[DataFrame, DataFrame | None, int]:
    """Legs of ordinary wallets, those of hot ones or None, and the number of all legs, from one
    aggregation that is run and stored while the plan is built."""
    counts = cut(legs.groupBy("wallet_address").agg(F.count(F.lit(1)).alias("_n")))
    return *split_hot_by_counts(legs, counts, ["wallet_address"], "_n", hot_threshold), total(counts, "_n")


def fifo_split(legs: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """``fifo_match`` with the wallets of more legs than the threshold
    (``cairn.skew.hotKeyRows``) in the range-sliced form. Finding them is one
    partial aggregation of the legs, run while the plan is built."""
    cold, hot, rows = split_legs(legs, hot_threshold)
    out = fifo_match(cold, rows=rows)
    return out if hot is None else out.unionByName(fifo_match(hot, ranged=True))


def sells(fifo: DataFrame) -> DataFrame:
    return fifo.where(F.col("side") == SELL)


def open_lots(fifo: DataFrame) -> DataFrame:
    """What is left of each buy lot after all sells of its (wallet, token):
    remaining = the part of the lot range (B - q, B] beyond the final M."""
    final = fifo.groupBy(*KEY).agg(F.sum("matched_quantity").cast(QTY).alias("final_m"))
    df = fifo.where(F.col("side") == BUY).join(final, KEY)
    lot_start = (F.col("lot_end") - F.col("quantity")).cast(QTY)
    remaining = F.least(F.col("quantity"),
                        F.greatest(F.lit(0).cast(QTY), (F.col("lot_end") - F.col("final_m")).cast(QTY)))
    return df.select(
        *KEY, "transaction_hash", "leg", "timestamp", "price",
        lot_start.alias("lot_start"), F.col("lot_end"),
        remaining.cast(QTY).alias("remaining_quantity"),
        (remaining * F.col("price")).cast(MONEY).alias("remaining_cost"),
    ).where(F.col("remaining_quantity") > 0)


def unrealized_pnl(lots: DataFrame, prices: DataFrame) -> DataFrame:
    """Current value of open lots minus their remaining cost, per
    (wallet, token). ``prices`` has token_address, current_price."""
    agg = lots.groupBy(*KEY).agg(
        F.sum("remaining_quantity").cast(QTY).alias("open_quantity"),
        F.sum("remaining_cost").cast(MONEY).alias("open_cost"))
    j = agg.join(prices.select("token_address", F.col("current_price").cast(PRICE)),
                 "token_address", "left")
    value = (F.col("open_quantity") * F.coalesce("current_price", F.lit(0).cast(PRICE))).cast(MONEY)
    return j.select(*KEY, "open_quantity", "open_cost", value.alias("current_value"),
                    (value - F.col("open_cost")).cast(MONEY).alias("unrealized_pnl"))
