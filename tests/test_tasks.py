"""End-to-end incremental run of the scheduled tasks over a versioned store,
fed with JSON pages generated from the test tables."""

import tempfile

from pyspark.sql import functions as F

from cairn.config import TokenScreen
from cairn.functions.expr import ts_ntz
from cairn.plans import fixtures as fx
from cairn.plans import tasks
from cairn.plans.q_sources import holder_pages, token_pages
from cairn.sources import json_pages as jp
from cairn.sources.store import TableStore

SF = "/root/testdata/sf0.001"


def tx_pages_for(spark):
    s = fx.swaps_fx(spark, SF).withColumn(
        "wallet_address", F.regexp_replace("wallet_address", "^W", "C0"))
    secs = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("timestamp"))
    side = lambda p: F.struct(*[F.col(f"{p}_{f}").alias(f) for f in jp.SIDE_FIELDS])
    item = F.struct(F.col("transaction_hash").alias("tx_hash"), secs.alias("block_unix_time"), "tx_type",
                    "source", F.col("wallet_address").alias("owner"), side("base").alias("base"),
                    side("quote").alias("quote"))
    pages = s.groupBy("wallet_address").agg(F.collect_list(item).alias("items"))
    return pages.select(F.to_json(F.struct(F.struct(F.col("items").alias("items")).alias("data"))).alias("value"))


def test_tasks_end_to_end(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cairn-tasks-"))
    now = ts_ntz("2024-02-01 00:00:00")
    screen = TokenScreen(None, None, None, None, None, limit=100000)
    tasks.bronze_tokens_task(store, token_pages(spark, SF), now, screen)
    assert store.read("bronze_tokens").count() > 0
    tasks.silver_tokens_task(store, now)
    assert store.read("bronze_tokens").where("silver_processed").count() == store.read("silver_tokens").count()
    tasks.bronze_whales_task(store, holder_pages(spark, SF), now)
    assert store.read("bronze_whales").count() > 0
    assert store.read("silver_tokens").where("whales_processed").count() > 0
    tasks.silver_whales_task(store, now)
    assert store.read("silver_whales").count() > 0
    tasks.bronze_transactions_task(store, tx_pages_for(spark), now)
    assert store.read("bronze_transactions").count() > 0
    tasks.silver_wallet_pnl_task(store, now)
    assert store.read("silver_wallet_pnl").count() > 0
    assert store.read("silver_whales").where("pnl_processed").count() > 0
    tasks.smart_traders_task(store, now)
    gold = store.read("smart_traders").count()   # tables are read again after a rewrite
    assert gold == store.read("silver_wallet_pnl").where("smart_trader_eligible").count()
    # a second run finds nothing new to rank: gold unchanged, nothing re-flagged
    tasks.smart_traders_task(store, now)
    assert store.read("smart_traders").count() == gold
    assert tasks.push_list_task(store).count() == min(100, gold)
    runs = store.read(tasks.RUN_LOG)
    assert runs.where("status = 'completed'").count() == 8


def test_only_finished_work_is_flagged(spark):
    """A wallet without a page, with a failed page, with an empty page, and
    one below the history minimum."""
    from cairn.operators.reports import processed_without_record
    from cairn.operators.state import fold_states
    store = TableStore(spark, tempfile.mkdtemp(prefix="cairn-tasks-"))
    now = ts_ntz("2024-02-01 00:00:00")
    whales = spark.createDataFrame([(w, False, False) for w in ("full", "one", "empty", "failed", "none")],
                                   "wallet_address string, transactions_processed boolean, pnl_processed boolean")
    store.write("silver_whales", whales)

    def page(wallet, n):
        side = '{{"symbol":"S","address":"A","type_swap":"{t}","ui_change_amount":"{a}","nearest_price":"200"}}'
        items = ",".join('{"tx_hash":"%s%d","block_unix_time":"%d","tx_type":"swap","source":"x","owner":"%s","base":%s,"quote":%s}' % (
            wallet, i, 1700000000 + i * 90000, wallet, side.format(t="to", a=5), side.format(t="from", a=-5)) for i in range(n))
        return '{"success":true,"data":{"items":[%s]}}' % items

    pages = spark.createDataFrame([("full", page("full", 4)), ("one", page("one", 1)), ("empty", page("empty", 0)),
                                   ("failed", '{"success":false,"data":{"items":[]}}')], "wallet_address string, value string")
    tasks.bronze_transactions_task(store, pages, now)
    got = {r.wallet_address: r.transactions_processed for r in store.read("silver_whales").collect()}
    assert got == {"full": True, "one": True, "empty": True, "failed": False, "none": False}
    tasks.silver_wallet_pnl_task(store, now)
    got = {r.wallet_address: r.pnl_processed for r in store.read("silver_whales").collect()}
    assert got == {"full": True, "one": False, "empty": False, "failed": False, "none": False}
    assert processed_without_record(store.read("silver_whales"), store.read("silver_wallet_pnl")).count() == 0
    assert store.read("position_summary").select("wallet_address").distinct().count() == 1
    states = {(r.task_name, r.entity_id): r.state for r in fold_states(store.read(tasks.STATE_EVENTS)).collect()}
    assert states["bronze_transactions", "none"] == states["bronze_transactions", "failed"] == "failed"
    assert states["bronze_transactions", "empty"] == "completed"
    assert states["silver_wallet_pnl", "one"] == states["silver_wallet_pnl", "empty"] == "skipped"
    assert states["silver_wallet_pnl", "full"] == "completed"


def test_method_labels():
    import pytest

    from cairn.config import PnlConfig
    from cairn.plans.pnl import check_method
    for m in ("fifo", "fifo_enhanced", "fifo_cost_basis_matched", "fifo_cost_basis_matched_min50"):
        check_method(PnlConfig(method=m))
    for m in ("lifo", "fifo_cost_basis"):
        with pytest.raises(ValueError):
            check_method(PnlConfig(method=m))
