"""Remaining edge cases of FIXTURES.md §4."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from cairn.config import TxFilter
from cairn.operators.clean import split_transactions
from cairn.operators.fifo import fifo_match
from cairn.plans.pnl import wallet_pnl

TX = ("transaction_hash string, wallet_address string, timestamp timestamp_ntz, tx_type string, source string, "
      "base_symbol string, base_address string, base_type_swap string, base_ui_change_amount double, "
      "base_nearest_price double, quote_symbol string, quote_address string, quote_type_swap string, "
      "quote_ui_change_amount double, quote_nearest_price double")


def tx(h, ts, side, amt, px, addr="T", qside=None, qamt=None, qpx=None, typ="swap"):
    return (h, "w", ts, typ, "s", "SYM", addr, side, amt, px, None, None, qside, qamt, qpx)


def test_invalid_legs_ignored_but_time_counts(spark):
    rows = [
        tx("h0", datetime(2024, 1, 1), "to", 0.0, 10.0),             # amount 0: ignored, time counts
        tx("h1", datetime(2024, 1, 2), "to", 2.0, 10.0),
        tx("h2", datetime(2024, 1, 3), "from", -1.0, 20.0),
        tx("h3", datetime(2024, 1, 4), "from", -1.0, None),           # price null: ignored
        tx("h4", datetime(2024, 1, 9), "from", -1.0, 30.0, addr=""),  # empty address: ignored, time counts
    ]
    r = wallet_pnl(spark.createDataFrame(rows, TX)).first()
    assert r.trading_days == 9 and r.matched_trades == 1 and r.total_realized_pnl_usd == 10.0
    assert r.tokens_traded_count == 1


def test_symbol_falls_back_to_address_prefix(spark):
    from cairn.operators.fifo import trade_legs
    rows = [("h", "w", datetime(2024, 1, 1), "swap", "s", None, "ABCDEFGHIJ", "to", 1.0, 1.0,
             "", "QUOTEADDRESS", "from", -1.0, 1.0)]
    legs = {r.leg: r.token_symbol for r in trade_legs(spark.createDataFrame(rows, TX)).collect()}
    assert legs == {0: "ABCDEFGH", 1: "QUOTEADD"}


def test_tx_type_and_value_filter(spark):
    rows = [tx("a", datetime(2024, 1, 1), "to", 1.0, 200.0, typ="SWAP"),
            tx("b", datetime(2024, 1, 1), "to", 1.0, 200.0, typ=None),
            tx("c", datetime(2024, 1, 1), "to", 1.0, 200.0, typ="mint"),
            tx("d", datetime(2024, 1, 1), "to", 1.0, 99.99),
            tx("e", datetime(2024, 1, 1), "to", -1.0, 100.0)]
    kept, rejected = split_transactions(spark.createDataFrame(rows, TX), TxFilter())
    assert sorted(r.transaction_hash for r in kept.collect()) == ["a", "e"]
    reasons = {r.transaction_hash: r.reject_reason for r in rejected.collect()}
    assert reasons == {"b": "missing tx_type", "c": "tx_type not included", "d": "below min value"}


def test_same_timestamp_tie_break(spark):
    """Buy and sell at the same instant: (timestamp, hash, leg) decides."""
    schema = ("wallet_address string, token_address string, token_symbol string, timestamp timestamp_ntz, "
              "transaction_hash string, leg int, side string, quantity decimal(18,4), price decimal(18,4)")
    t = datetime(2024, 1, 1)
    rows = [("w", "t", "S", t, "b", 0, "from", Decimal(1), Decimal(20)),
            ("w", "t", "S", t, "a", 0, "to", Decimal(1), Decimal(10))]
    s = fifo_match(spark.createDataFrame(rows, schema)).where("side = 'from'").first()
    assert s.matched_quantity == 1 and s.cost_basis == Decimal("10")   # hash 'a' (buy) first


def test_win_loss_neutral_sum_to_matched(spark):
    from cairn.plans.fixtures import trades_fx
    from cairn.plans.pnl import wallet_pnl_from_legs
    t = trades_fx(spark, "/root/testdata/sf0.001")
    p = wallet_pnl_from_legs(t, t.select("wallet_address", "timestamp"))
    bad = p.where(F.col("winning_trades") + F.col("losing_trades") + F.col("neutral_trades")
                  != F.col("matched_trades")).count()
    assert bad == 0 and p.count() > 0


def test_performance_history_exact_day_match(spark):
    from datetime import date

    from cairn.functions.expr import ts_ntz
    from cairn.operators.options import performance_history
    rows = [("w", date(2024, 1, 1), 100.0, 10.0, 50.0, 2, "QUALIFIED"),
            ("w", date(2024, 1, 8), 1500.0, 20.0, 60.0, 5, "PROMISING"),
            ("w", date(2024, 1, 10), 1600.0, 21.0, 60.0, 5, "PROMISING"),
            ("w", date(2024, 1, 15), 1700.0, 22.0, 65.0, 6, "PROMISING")]
    snaps = spark.createDataFrame(rows, "wallet_address string, performance_date date, total_realized_pnl_usd double, "
                                        "total_roi_percent double, win_rate_percent double, meaningful_trades long, "
                                        "performance_tier string")
    h = {r.performance_date: r for r in performance_history(snaps, 90, ts_ntz("2024-02-01 00:00:00")).collect()}
    assert h[date(2024, 1, 8)].pnl_change_7d == 1400.0 and h[date(2024, 1, 8)].tier_change == "QUALIFIED -> PROMISING"
    assert h[date(2024, 1, 15)].roi_change_7d == 2.0 and h[date(2024, 1, 15)].tier_change == "unchanged"
    assert h[date(2024, 1, 10)].pnl_change_7d is None and h[date(2024, 1, 10)].tier_change is None
