"""The reference's scheduled tasks as incremental Spark jobs over a
``TableStore`` (SURVEY §3): each reads its input
tables (and landed JSON pages), computes with the operators, upserts its
output, and only then marks its inputs processed. Each task also appends
start/end rows to the run log and state events per processed entity.

Every task is idempotent at the batch level: rerunning it after a failure
rewrites the same keys (upserts) and flags, and inputs are flagged last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import HolderBand, PnlConfig, RankConfig, TokenScreen, TxFilter
from cairn.functions.scan import cut
from cairn.operators import clean, holders, incremental, state, tiers
from cairn.operators.clean import first_per_key
from cairn.operators.fifo import fifo_split, trade_legs
from cairn.operators.metrics import position_summary
from cairn.plans.pnl import wallet_pnl
from cairn.sources import json_pages as jp
from cairn.sources.store import TableStore

RUN_LOG = "task_execution_log_events"
STATE_EVENTS = "entity_state_events"


def _log(store: TableStore, task: str, run_id: str, status: str, now: Column,
         processed: int | None = None, failed: int | None = None, skipped: int | None = None) -> None:
    spark = store.spark
    row = spark.range(1).select(
        F.lit(task).alias("task_name"), F.lit(run_id).alias("run_id"), now.alias("event_at"),
        F.lit(status).alias("status"), F.lit(processed).cast("long").alias("entities_processed"),
        F.lit(failed).cast("long").alias("entities_failed"), F.lit(skipped).cast("long").alias("entities_skipped"))
    store.append(RUN_LOG, row)


def _states(store: TableStore, entities: DataFrame, task: str, etype: str, st: str, now: Column,
            id_col: str) -> None:
    # within one run the outcome follows the start
    seq = F.lit(0 if st == "processing" else 1).cast("long")
    store.append(STATE_EVENTS, state.state_event(entities, task, etype, st, now, id_col, seq=seq))


def _run(store: TableStore, task: str, now: Column, body) -> dict:
    run_id = uuid.uuid4().hex
    _log(store, task, run_id, "running", now)
    try:
        result = body()
    except Exception:
        _log(store, task, run_id, "failed", now)
        raise
    _log(store, task, run_id, "completed", now, result.get("processed"), result.get("failed"),
         result.get("skipped"))
    return result


def bronze_tokens_task(store: TableStore, token_pages: DataFrame, now: Column,
                       screen: TokenScreen | None = None) -> dict:
    """Landed token-list pages -> screened bronze_tokens; existing tokens keep
    their processing flags (M2)."""
    def body():
        rows = clean.screen_tokens(jp.normalize_tokens(token_pages), screen or TokenScreen())
        new = clean.with_ingest_metadata(rows, now, "bronze_tokens")
        update = [c for c in new.columns if c not in ("token_address", "silver_processed", "silver_processed_at")]
        store.upsert("bronze_tokens", new, ["token_address"], update, {"silver_processed": False})
        return {"processed": store.read("bronze_tokens").count()}
    return _run(store, "bronze_tokens", now, body)


def silver_tokens_task(store: TableStore, now: Column) -> dict:
    """Unprocessed bronze tokens -> silver_tokens (F9), then mark bronze (M1)."""
    def body():
        bronze = store.read("bronze_tokens")
        rec = clean.silver_token_record(bronze, now)
        rec = rec.withColumn("selection_reason", F.to_json("selection_reason"))
        keep = ("token_address", "whales_processed", "whales_processed_at", "selected_at")
        update = [c for c in rec.columns if c not in keep]
        store.upsert("silver_tokens", rec, ["token_address"], update, {"whales_processed": False})
        done = store.read("silver_tokens").select("token_address")
        store.rewrite("bronze_tokens", lambda b: incremental.mark_processed(
            b, done, ["token_address"], "silver_processed", now))
        return {"processed": done.count()}
    return _run(store, "silver_tokens", now, body)


def bronze_whales_task(store: TableStore, holder_pages: DataFrame, now: Column, refetch_hours: int = 72,
                       band: HolderBand | None = None) -> dict:
    """Holder pages of the tokens due (F3) -> band per token (W10), first row
    per (token, wallet) (W6) -> bronze_whales keeping flags (M2), then mark
    the tokens with holder rows whales_processed (M1). Due tokens without a
    row on a successful page stay due and are recorded as failed."""
    def body():
        due = cut(clean.due_for_refresh(store.read("silver_tokens"), now, refetch_hours))
        _states(store, due, "bronze_whales", "token", "processing", now, "token_address")
        rows = jp.normalize_holders(holder_pages).drop("rank").withColumnRenamed("mint", "token_address")
        rows = rows.join(due.select("token_address"), "token_address", "left_semi")
        toks = due.select("token_address", "holder_count", F.col("symbol").alias("token_symbol"),
                          F.col("name").alias("token_name"))
        banded = holders.holder_band(rows, toks.select("token_address", "holder_count"), band or HolderBand())
        rec = (first_per_key(banded, ["token_address", "wallet_address"], ["holder_rank"])
               .withColumnRenamed("holder_rank", "rank")
               .join(toks.drop("holder_count"), "token_address", "left")
               .withColumns({"fetched_at": now, "silver_processed": F.lit(False)}))
        update = [c for c in rec.columns if c not in ("token_address", "wallet_address", "silver_processed")]
        store.upsert("bronze_whales", rec, ["token_address", "wallet_address"], update,
                     {"silver_processed": False})
        done = cut(rows.select("token_address").distinct())
        failed = cut(due.select("token_address").join(done, "token_address", "left_anti"))
        store.rewrite("silver_tokens", lambda t: incremental.mark_processed(
            t, done, ["token_address"], "whales_processed", now))
        _states(store, done, "bronze_whales", "token", "completed", now, "token_address")
        _states(store, failed, "bronze_whales", "token", "failed", now, "token_address")
        return {"processed": done.count(), "failed": failed.count()}
    return _run(store, "bronze_whales", now, body)


def silver_whales_task(store: TableStore, now: Column) -> dict:
    """Unprocessed holder rows -> silver_whales (A1, A2) keeping the
    transaction/PnL flags of known wallets, then mark bronze_whales (M1)."""
    def body():
        bw = store.read("bronze_whales")
        rec = holders.holder_record(bw, now)
        keep = ("wallet_address", "first_seen_at", "transactions_processed", "pnl_processed")
        update = [c for c in rec.columns if c not in keep]
        store.upsert("silver_whales", rec, ["wallet_address"], update,
                     {"transactions_processed": False, "pnl_processed": False})
        done = rec.select("wallet_address")
        store.rewrite("bronze_whales", lambda b: incremental.mark_processed(
            b, done, ["wallet_address"], "silver_processed", now))
        return {"processed": store.read("silver_whales").count()}
    return _run(store, "silver_whales", now, body)


def bronze_transactions_task(store: TableStore, tx_pages: DataFrame, now: Column,
                             tx_filter: TxFilter | None = None) -> dict:
    """History pages of unprocessed whales -> cleaned (F5) records (F6),
    first per (hash, wallet) (W6) -> bronze_transactions (M3), then mark the
    whales fetched: those with a successful page, an empty one (which must
    name its wallet in a ``wallet_address`` column of ``tx_pages``) included.
    Whales without one stay unprocessed and are recorded as failed; rejected
    rows are counted."""
    def body():
        whales = cut(clean.unprocessed(store.read("silver_whales"), "transactions_processed").select("wallet_address"))
        _states(store, whales, "bronze_transactions", "wallet", "processing", now, "wallet_address")
        tx = jp.normalize_seek_by_time(tx_pages).join(whales.select("wallet_address"), "wallet_address",
                                                       "left_semi")
        kept, rejected = clean.split_transactions(tx, tx_filter or TxFilter())
        rec = clean.transaction_record(kept, now, "bronze_transactions")
        rec = first_per_key(rec, ["transaction_hash", "wallet_address"], ["timestamp"])
        store.upsert("bronze_transactions", rec, ["transaction_hash", "wallet_address"])
        fetched = tx.select("wallet_address")
        if "wallet_address" in tx_pages.columns:
            fetched = fetched.unionByName(jp.successful_pages(tx_pages).select("wallet_address"))
        done = cut(whales.join(fetched, "wallet_address", "left_semi"))
        failed = cut(whales.join(done, "wallet_address", "left_anti"))
        store.rewrite("silver_whales", lambda w: incremental.mark_processed(
            w, done, ["wallet_address"], "transactions_processed", now))
        _states(store, done, "bronze_transactions", "wallet", "completed", now, "wallet_address")
        _states(store, failed, "bronze_transactions", "wallet", "failed", now, "wallet_address")
        return {"processed": done.count(), "failed": failed.count(), "skipped": rejected.count()}
    return _run(store, "bronze_transactions", now, body)


def silver_wallet_pnl_task(store: TableStore, now: Column, cfg: PnlConfig | None = None) -> dict:
    """Ready wallets (F10) -> their transactions (J7) -> FIFO + metrics ->
    silver_wallet_pnl with every column replaced (M3: gold_processed back to
    false) and its positions as rows of position_summary (P19's token list),
    then mark the whales with a record pnl_processed (M1). Wallets below the
    history minimum get no record, stay unmarked and are recorded as skipped."""
    def body():
        ready = cut(clean.ready_wallets(store.read("silver_whales")).select("wallet_address"))
        _states(store, ready, "silver_wallet_pnl", "wallet", "processing", now, "wallet_address")
        tx = store.read("bronze_transactions").join(ready, "wallet_address", "left_semi")
        pnl = cut(wallet_pnl(tx, ready, cfg).withColumns({"last_calculated_at": now, "gold_processed": F.lit(False)}))
        done = pnl.select("wallet_address")
        positions = position_summary(fifo_split(trade_legs(tx).join(done, "wallet_address", "left_semi"))).where("is_listed")
        store.upsert("silver_wallet_pnl", pnl, ["wallet_address"], None, {"gold_processed": False})
        store.upsert("position_summary", positions, ["wallet_address", "token_address"])
        skipped = cut(ready.join(done, "wallet_address", "left_anti"))
        store.rewrite("silver_whales", lambda w: incremental.mark_processed(
            w, done, ["wallet_address"], "pnl_processed", now))
        _states(store, done, "silver_wallet_pnl", "wallet", "completed", now, "wallet_address")
        _states(store, skipped, "silver_wallet_pnl", "wallet", "skipped", now, "wallet_address")
        return {"processed": done.count(), "skipped": skipped.count()}
    return _run(store, "silver_wallet_pnl", now, body)


def smart_traders_task(store: TableStore, now: Column, cfg: RankConfig | None = None) -> dict:
    """Eligible, not yet gold-processed PnL records (G1) -> smart_traders
    (G2-G13), then mark them gold_processed (M1)."""
    def body():
        pnl = store.read("silver_wallet_pnl")
        gold = cut(tiers.rank_traders(pnl, now, cfg).withColumn("last_updated_at", now))
        store.upsert("smart_traders", gold, ["wallet_address"])
        # one snapshot per trader and run for the history
        store.append("trader_performance_history", gold.select(
            "wallet_address", now.cast("date").alias("performance_date"), "total_realized_pnl_usd", "total_roi_percent",
            "win_rate_percent", "meaningful_trades", "performance_tier"))
        done = gold.select("wallet_address")
        store.rewrite("silver_wallet_pnl", lambda p: incremental.mark_processed(
            p, done, ["wallet_address"], "gold_processed", now))
        return {"processed": done.count()}
    return _run(store, "smart_traders", now, body)


def push_list_task(store: TableStore, limit: int = 100) -> DataFrame:
    """The addresses to hand to the webhook provider."""
    return tiers.push_list(store.read("smart_traders"), limit)
