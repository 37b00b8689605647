"""Per-position and per-wallet performance metrics over FIFO output.

All sums run on exact decimals; ratios are taken in double at the end and
rounded half-up with plain IEEE steps (see ``round_half_up``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cairn.config import (SCORE_FREQUENCY, SCORE_PNL, SCORE_ROI, SCORE_SHARPE, SCORE_VOLUME, SCORE_WIN_RATE,
                          PnlConfig)
from cairn.functions.expr import MONEY, clip, money_out, round_half_up, safe_div, whole_days
from cairn.functions.scan import Run, scans
from cairn.operators.fifo import EVENT_ORDER, KEY

METHOD_LABEL = "fifo_cost_basis_matched_min50"


def _msum(c):
    return F.sum(c).cast(DecimalType(38, 10))


def position_summary(fifo: DataFrame) -> DataFrame:
    """P5: per (wallet, token) realized pnl, trade counts, volumes, cost basis,
    ROI and mean trade ROI. ``is_listed`` marks what the record's token list shows."""
    symbol = F.min_by("token_symbol", F.struct(*EVENT_ORDER))
    g = fifo.groupBy(*KEY).agg(
        symbol.alias("token_symbol"),
        _msum("pnl").alias("realized_pnl"),
        F.count_if("is_matched").alias("matched_trades"),
        F.count_if("is_unmatched").alias("unmatched_trades"),
        _msum("purchase_value").alias("purchase_volume"),
        _msum("matched_proceeds").alias("matched_sale_volume"),
        _msum("unmatched_proceeds").alias("unmatched_sale_volume"),
        _msum("cost_basis").alias("matched_cost_basis"),
        F.avg("trade_roi").alias("avg_trade_roi_raw"),
    )
    return g.select(
        *KEY, "token_symbol",
        money_out("realized_pnl").alias("realized_pnl"),
        "matched_trades", "unmatched_trades",
        money_out("purchase_volume").alias("purchase_volume"),
        money_out("matched_sale_volume").alias("matched_sale_volume"),
        money_out("unmatched_sale_volume").alias("unmatched_sale_volume"),
        money_out("matched_cost_basis").alias("matched_cost_basis"),
        round_half_up(safe_div("realized_pnl", "matched_cost_basis") * 100, 2).alias("roi_percent"),
        round_half_up(F.coalesce("avg_trade_roi_raw", F.lit(0.0)), 2).alias("avg_trade_roi"),
        ((F.col("matched_trades") > 0) | (F.col("unmatched_trades") > 0)
         | (F.abs("realized_pnl") > 1)).alias("is_listed"),
    )


def wallet_trade_stats(fifo: DataFrame, ranged: bool = False, slices: int | None = None) -> DataFrame:
    """Per-wallet aggregates of the FIFO output (P7-P16 inputs).

    Trade-level statistics that need an order (drawdown: event order; median
    ROI: value order) are scans over the same wallet partitioning, so in the
    default form the whole record is one aggregation without another shuffle
    and no group is ever held in memory (sorts and windows spill).
    ``ranged=True`` computes the same scans range-partitioned for hot wallets."""
    scan = scans(ranged, slices)
    dec = DecimalType(38, 10)
    wkey = ["wallet_address"]
    order = [(F.col(c), True) for c in EVENT_ORDER]
    matched_pnl = F.when(F.col("is_matched"), F.col("pnl")).otherwise(F.lit(0).cast(MONEY))
    t = scan(fifo, wkey, order, {"_cum": Run("sum", matched_pnl, cast=dec)}, {"_runmax": Run("max", F.col("_cum"))})
    peak = F.greatest(F.lit(0).cast(dec), F.col("_runmax"))
    # Drawdown at each matched sell once a positive peak exists
    dd = F.when(F.col("is_matched") & (peak > 0),
                (peak - F.col("_cum")).cast("double") / peak.cast("double"))
    # P13 exact median of trade ROI: the middle one or two values in ROI order
    roi_order = [(F.col("trade_roi"), True)] + order
    t = scan(t, wkey, roi_order, {"_rn": Run("sum", F.lit(1)), "_n": Run("total", F.col("trade_roi"))})
    mid = (F.col("trade_roi").isNotNull()
           & ((F.col("_rn") == F.floor((F.col("_n") + 1) / 2))
              | (F.col("_rn") == F.ceil((F.col("_n") + 1) / 2))))

    return t.groupBy("wallet_address").agg(
        _msum("pnl").alias("pnl"),
        F.count_if("is_matched").alias("matched_trades"),
        F.count_if("is_unmatched").alias("unmatched_trades"),
        F.count_if("is_win").alias("winning_trades"),
        F.count_if("is_loss").alias("losing_trades"),
        _msum(F.when(F.col("is_win"), F.col("pnl"))).alias("win_pnl"),
        _msum(F.when(F.col("is_loss"), F.col("pnl"))).alias("loss_pnl"),
        _msum("purchase_value").alias("purchase_volume"),
        _msum("matched_proceeds").alias("matched_sale_volume"),
        _msum("unmatched_proceeds").alias("unmatched_sale_volume"),
        _msum("sale_value").alias("sale_volume"),
        _msum("cost_basis").alias("cost_basis"),
        F.avg("trade_roi").alias("avg_roi"),
        F.avg(F.when(mid, F.col("trade_roi"))).alias("median_roi"),
        F.max(dd).alias("max_dd"),
        F.avg(F.when(F.col("is_matched"), F.col("pnl").cast("double"))).alias("mean_pnl"),
        F.stddev_pop(F.when(F.col("is_matched"), F.col("pnl").cast("double"))).alias("sd_pnl"),
        F.count_if("first_in_position").alias("tokens_traded_count"),
    )


def wallet_metrics(fifo: DataFrame, tx_span: DataFrame, cfg: PnlConfig | None = None,
                   stats: DataFrame | None = None) -> DataFrame:
    """One silver_wallet_pnl record per wallet of ``tx_span``.

    ``fifo`` is the output of ``fifo_match``; ``tx_span``: wallet_address,
    first_trade_at, last_trade_at over *all* transactions of the wallet (also
    ones without a valid leg). ``stats`` may pass precomputed
    ``wallet_trade_stats`` (e.g. the union of the normal and hot-wallet forms)."""
    cfg = cfg or PnlConfig()
    agg = stats if stats is not None else wallet_trade_stats(fifo)
    w = tx_span.join(agg, "wallet_address", "left")

    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    matched, unmatched = z("matched_trades"), z("unmatched_trades")
    win, loss = z("winning_trades"), z("losing_trades")
    meaningful = win + loss
    total = matched + unmatched
    win_rate = safe_div(win, meaningful) * 100
    coverage = safe_div(matched, total) * 100
    days = F.when(F.col("first_trade_at").isNotNull() & F.col("last_trade_at").isNotNull(),
                  whole_days("first_trade_at", "last_trade_at") + 1).otherwise(F.lit(0))
    freq = safe_div(matched, days)
    zero_m = F.lit(0).cast(DecimalType(38, 10))
    pnl = F.coalesce(F.col("pnl"), zero_m)
    purchases = F.coalesce(F.col("purchase_volume"), zero_m)
    msale = F.coalesce(F.col("matched_sale_volume"), zero_m)
    usale = F.coalesce(F.col("unmatched_sale_volume"), zero_m)
    total_volume = (purchases + F.coalesce(F.col("sale_volume"), zero_m))
    cost = F.coalesce(F.col("cost_basis"), zero_m)
    roi = F.when(cost > 0, pnl.cast("double") / cost.cast("double") * 100).otherwise(0.0)
    # mean over population deviation of the matched trades' pnl, from central moments
    sharpe = F.when((matched > 1) & (F.col("sd_pnl") > 0), F.col("mean_pnl") / F.col("sd_pnl")).otherwise(0.0)
    avg_win = safe_div(F.coalesce("win_pnl", zero_m), win)
    avg_loss = safe_div(F.abs(F.coalesce("loss_pnl", zero_m)), loss)
    avg_size = safe_div(purchases + msale, matched * 2)

    w = w.select(
        "wallet_address", "first_trade_at", "last_trade_at",
        pnl.alias("_pnl"), roi.alias("_roi"), win_rate.alias("_win_rate"),
        coverage.alias("_coverage"), days.alias("_days"), freq.alias("_freq"),
        sharpe.alias("_sharpe"), total_volume.alias("_volume"),
        meaningful.alias("meaningful_trades"), matched.alias("matched_trades"),
        unmatched.alias("unmatched_trades"), total.alias("total_trades"),
        win.alias("winning_trades"), loss.alias("losing_trades"),
        (matched - meaningful).alias("neutral_trades"),
        avg_win.alias("_avg_win"), avg_loss.alias("_avg_loss"),
        purchases.alias("_purchases"), msale.alias("_msale"), usale.alias("_usale"),
        cost.alias("_cost"), avg_size.alias("_avg_size"),
        F.coalesce("avg_roi", F.lit(0.0)).alias("_avg_roi"),
        F.coalesce("median_roi", F.lit(0.0)).alias("_median_roi"),
        F.coalesce("max_dd", F.lit(0.0)).alias("_max_dd"),
        F.coalesce("tokens_traded_count", F.lit(0)).cast("long").alias("tokens_traded_count"),
    )
    eligible = (
        (F.col("meaningful_trades") >= cfg.min_meaningful_trades)
        & (F.col("_coverage") >= cfg.min_coverage)
        & (F.col("_win_rate") >= cfg.min_win_rate)
        & (F.col("_pnl") > cfg.min_realized_pnl)
        & (F.col("_roi") >= cfg.min_roi)
        & (F.col("_days") >= cfg.min_trading_days)
    )
    pnl_d = F.col("_pnl").cast("double")
    score = (
        clip(pnl_d / SCORE_PNL[1]) * SCORE_PNL[0]
        + clip(F.col("_roi") / SCORE_ROI[1]) * SCORE_ROI[0]
        + F.least(F.col("_win_rate") / SCORE_WIN_RATE[1], F.lit(1.0)) * SCORE_WIN_RATE[0]
        + F.least(F.col("_volume").cast("double") / SCORE_VOLUME[1], F.lit(1.0)) * SCORE_VOLUME[0]
        + F.least(F.col("_freq") / SCORE_FREQUENCY[1], F.lit(1.0)) * SCORE_FREQUENCY[0]
        + clip(F.col("_sharpe") / SCORE_SHARPE[1]) * SCORE_SHARPE[0]
    )
    score = F.when(eligible & (F.col("_volume") > 0), score).otherwise(0.0)
    return w.select(
        "wallet_address",
        money_out("_pnl").alias("total_realized_pnl_usd"),
        F.lit(0.0).alias("total_unrealized_pnl_usd"),
        round_half_up("_win_rate", 2).alias("win_rate_percent"),
        round_half_up("_avg_win", 2).alias("avg_win_usd"),
        round_half_up("_avg_loss", 2).alias("avg_loss_usd"),
        round_half_up("_freq", 3).alias("trade_frequency_per_day"),
        F.col("total_trades").cast("long").alias("total_trades"),
        F.col("matched_trades").cast("long").alias("matched_trades"),
        F.col("unmatched_trades").cast("long").alias("unmatched_trades"),
        F.col("meaningful_trades").cast("long").alias("meaningful_trades"),
        F.col("neutral_trades").cast("long").alias("neutral_trades"),
        round_half_up("_coverage", 2).alias("coverage_ratio_percent"),
        F.col("winning_trades").cast("long").alias("winning_trades"),
        F.col("losing_trades").cast("long").alias("losing_trades"),
        "tokens_traded_count",
        money_out("_volume").alias("total_volume_usd"),
        money_out(F.col("_purchases") + F.col("_msale")).alias("matched_volume_usd"),
        money_out("_usale").alias("unmatched_volume_usd"),
        round_half_up("_avg_size", 2).alias("avg_trade_size_usd"),
        money_out("_cost").alias("matched_cost_basis_usd"),
        round_half_up("_roi", 2).alias("total_roi_percent"),
        round_half_up("_avg_roi", 2).alias("avg_roi_percent"),
        round_half_up("_median_roi", 2).alias("median_roi_percent"),
        "first_trade_at", "last_trade_at",
        F.col("_days").cast("long").alias("trading_days"),
        round_half_up(F.col("_max_dd") * 100, 2).alias("max_drawdown_percent"),
        round_half_up("_sharpe", 3).alias("sharpe_ratio"),
        eligible.alias("smart_trader_eligible"),
        round_half_up(score, 4).alias("smart_trader_score"),
        F.lit(METHOD_LABEL).alias("calculation_method"),
    )


def transaction_span(transactions: DataFrame) -> DataFrame:
    """First and last time and count of all transactions per wallet."""
    return transactions.groupBy("wallet_address").agg(
        F.min("timestamp").alias("first_trade_at"),
        F.max("timestamp").alias("last_trade_at"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
