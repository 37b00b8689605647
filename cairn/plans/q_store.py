"""Registered queries for upserts, processing flags, state and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions.expr import ts_ntz
from cairn.operators import incremental as inc
from cairn.operators import state as st
from cairn.plans import fixtures as fx
from cairn.plans.registry import register

W = fx.with_ctes
BATCH_SQL = """tgt AS (SELECT token_address, price, liquidity, silver_processed, silver_processed_at
                FROM tokens_fx WHERE p_partkey % 2 = 0),
src AS (SELECT token_address, price + 1 AS price, liquidity FROM tokens_fx WHERE p_partkey % 2 = 1 OR p_partkey % 3 = 0)"""


def batch_fx(spark, sf_dir):
    """existing tokens (even keys, with flags) and an incoming batch (odd keys
    and keys divisible by 3, new prices, no flags): every row is in one or both."""
    t = fx.tokens_fx(spark, sf_dir)
    tgt = t.where("p_partkey % 2 = 0").select("token_address", "price", "liquidity",
                                              "silver_processed", "silver_processed_at")
    src = t.where("p_partkey % 2 = 1 OR p_partkey % 3 = 0").select("token_address", (F.col("price") + 1).alias("price"),
                                              "liquidity")
    return tgt, src


DEFAULTS = {"silver_processed": False}


@register("upsert_preserve_state", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT COALESCE(s.token_address, t.token_address) AS token_address,
       CASE WHEN s.token_address IS NOT NULL THEN s.price ELSE t.price END AS price,
       CASE WHEN s.token_address IS NOT NULL THEN s.liquidity ELSE t.liquidity END AS liquidity,
       CASE WHEN t.token_address IS NOT NULL THEN t.silver_processed ELSE false END AS silver_processed,
       CASE WHEN t.token_address IS NOT NULL THEN t.silver_processed_at END AS silver_processed_at
FROM tgt t FULL OUTER JOIN src s ON t.token_address = s.token_address""")
def q_upsert_preserve(spark, sf_dir):
    """M2: re-ingest updates data columns, keeps flags of existing rows."""
    tgt, src = batch_fx(spark, sf_dir)
    return inc.upsert(tgt, src, ["token_address"], ["price", "liquidity"], DEFAULTS)


@register("upsert_full_replace", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT COALESCE(s.token_address, t.token_address) AS token_address,
       CASE WHEN s.token_address IS NOT NULL THEN s.price ELSE t.price END AS price,
       CASE WHEN s.token_address IS NOT NULL THEN s.liquidity ELSE t.liquidity END AS liquidity,
       CASE WHEN s.token_address IS NOT NULL THEN false ELSE t.silver_processed END AS silver_processed,
       CASE WHEN s.token_address IS NOT NULL THEN NULL ELSE t.silver_processed_at END AS silver_processed_at
FROM tgt t FULL OUTER JOIN src s ON t.token_address = s.token_address""")
def q_upsert_full_replace(spark, sf_dir):
    """M3: no update list: every non-key column replaced, flags back to default."""
    tgt, src = batch_fx(spark, sf_dir)
    return inc.upsert(tgt, src, ["token_address"], None, DEFAULTS)


@register("upsert_do_nothing", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT * FROM tgt UNION ALL
SELECT s.token_address, s.price, s.liquidity, false, NULL FROM src s
WHERE s.token_address NOT IN (SELECT token_address FROM tgt)""")
def q_upsert_do_nothing(spark, sf_dir):
    """S7 with an empty update list: ON CONFLICT DO NOTHING."""
    tgt, src = batch_fx(spark, sf_dir)
    return inc.upsert(tgt, src, ["token_address"], [], DEFAULTS)


@register("split_new_existing", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT s.token_address, t.token_address IS NOT NULL AS existing
FROM src s LEFT JOIN (SELECT DISTINCT token_address FROM tgt) t ON s.token_address = t.token_address""")
def q_split_new_existing(spark, sf_dir):
    """A batch split by key existence (anti / semi join)."""
    tgt, src = batch_fx(spark, sf_dir)
    new, old = inc.split_new_existing(src, tgt, ["token_address"])
    return (new.select("token_address", F.lit(False).alias("existing"))
            .unionByName(old.select("token_address", F.lit(True).alias("existing"))))


@register("new_vs_updated", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT COUNT(*) FILTER (WHERE t.token_address IS NULL) AS new_records, COUNT(*) FILTER (WHERE t.token_address IS NOT NULL) AS updated_records
FROM (SELECT DISTINCT token_address FROM src) s
LEFT JOIN (SELECT DISTINCT token_address FROM tgt) t ON s.token_address = t.token_address""")
def q_new_vs_updated(spark, sf_dir):
    tgt, src = batch_fx(spark, sf_dir)
    return inc.new_vs_updated(src, tgt, ["token_address"])


@register("mark_processed", W(fx.WALLETS_FX_SQL, fx.PNL_PRESENT_FX_SQL) + """
SELECT w.wallet_address, w.transactions_processed,
       CASE WHEN p.wallet_address IS NOT NULL THEN true ELSE w.pnl_processed END AS pnl_processed,
       w.transactions_processed_at
FROM wallets_fx w LEFT JOIN (SELECT DISTINCT wallet_address FROM pnl_present_fx) p
  ON w.wallet_address = p.wallet_address""")
def q_mark_processed(spark, sf_dir):
    """M1: wallets whose PnL record exists are flagged processed."""
    return inc.mark_processed(fx.wallets_fx(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir),
                              ["wallet_address"], "pnl_processed", ts_ntz(fx.NOW_ORDERS))


@register("reset_summary", W(fx.WALLETS_FX_SQL, fx.STATE_EVENTS_FX_SQL) + """
SELECT 'silver.silver_wallet_pnl' AS table_name, CAST(0 AS BIGINT) AS record_count, 'All records cleared' AS status
UNION ALL SELECT 'silver.silver_whales (pnl_processed=false)', COUNT(*), 'Ready for PnL recalculation' FROM wallets_fx
UNION ALL SELECT 'pipeline.pipeline_state (1-URGENT)', CAST(0 AS BIGINT), 'State entries cleared'""")
def q_reset_summary(spark, sf_dir):
    """Reset then the three-line summary."""
    from cairn.plans.registry import QUERIES
    whales = fx.wallets_fx(spark, sf_dir)
    pnl = QUERIES["wallet_pnl"](spark, sf_dir)
    states = st.fold_states(fx.state_events_fx(spark, sf_dir))
    w, p, _, s = inc.reset_pnl(whales, pnl, pnl, states, task_name="1-URGENT")
    return inc.reset_summary(w, p, s, task_name="1-URGENT")


# ------------------------------------------------------------------- state
FOLD_SQL = """folded AS (
  SELECT task_name, entity_type, entity_id,
         arg_max(state, (event_at, seq)) AS state,
         COUNT(*) FILTER (WHERE state = 'processing') AS attempt_count,
         MIN(event_at) AS created_at, MAX(event_at) AS updated_at,
         MAX(CASE WHEN state = 'processing' THEN event_at END) AS last_attempt_at,
         MAX(CASE WHEN state = 'completed' THEN event_at END) AS completed_at,
         arg_max(error_message, (event_at, seq)) FILTER (WHERE state = 'failed') AS error_message
  FROM state_events_fx GROUP BY task_name, entity_type, entity_id)"""


def _folded(spark, sf_dir):
    return st.fold_states(fx.state_events_fx(spark, sf_dir).select(
        "task_name", "entity_type", "entity_id", "state", "event_at", "seq", "error_message"))


@register("record_state", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + "SELECT * FROM folded")
def q_record_state(spark, sf_dir):
    return _folded(spark, sf_dir)


@register("pending_entities", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + """
SELECT entity_id FROM folded WHERE task_name = '1-URGENT' AND state = 'pending'""")
def q_pending_entities(spark, sf_dir):
    return st.pending_entities(_folded(spark, sf_dir), "1-URGENT")


@register("bulk_mark", W(fx.STATE_EVENTS_FX_SQL, fx.PNL_PRESENT_FX_SQL) + f""",
ev AS (SELECT task_name, entity_type, entity_id, state, event_at, seq, error_message FROM state_events_fx
       UNION ALL
       SELECT 'pnl', 'wallet', wallet_address, 'processing', TIMESTAMP '{fx.NOW_ORDERS}', 0, NULL FROM pnl_present_fx
       UNION ALL
       SELECT 'pnl', 'wallet', wallet_address, 'completed', TIMESTAMP '{fx.NOW_ORDERS}', 1, NULL FROM pnl_present_fx)
SELECT task_name, entity_type, entity_id, arg_max(state, (event_at, seq)) AS state,
       COUNT(*) FILTER (WHERE state = 'processing') AS attempt_count, MAX(CASE WHEN state = 'completed' THEN event_at END) AS completed_at
FROM ev WHERE task_name = 'pnl' GROUP BY 1, 2, 3""")
def q_bulk_mark(spark, sf_dir):
    """M6: mark a set of wallets processing then completed; fold."""
    ids = fx.pnl_present_fx(spark, sf_dir)
    now = ts_ntz(fx.NOW_ORDERS)
    ev = (fx.state_events_fx(spark, sf_dir)
          .select("task_name", "entity_type", "entity_id", "state", "event_at", "seq", "error_message")
          .unionByName(st.state_event(ids, "pnl", "wallet", "processing", now, "wallet_address"))
          .unionByName(st.state_event(ids, "pnl", "wallet", "completed", now, "wallet_address",
                                      seq=F.lit(1).cast("long"))))
    return (st.fold_states(ev).where(F.col("task_name") == "pnl")
            .select("task_name", "entity_type", "entity_id", "state", "attempt_count", "completed_at"))


@register("expire_states", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + f"""
SELECT * FROM folded WHERE NOT COALESCE(state = 'completed'
   AND completed_at < TIMESTAMP '{fx.NOW_ORDERS}' - INTERVAL 30 DAY, false)""")
def q_expire_states(spark, sf_dir):
    return st.expire_states(_folded(spark, sf_dir), ts_ntz(fx.NOW_ORDERS), 30)


@register("state_statistics", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + """
SELECT state, entity_type, COUNT(*) AS count, CAST(GROUPING_ID(state, entity_type) AS INTEGER) AS level
FROM folded GROUP BY CUBE (state, entity_type)""")
def q_state_statistics(spark, sf_dir):
    return st.state_statistics(_folded(spark, sf_dir)).withColumn("level", F.col("level").cast("int"))


@register("states_vs_records", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL, fx.PNL_PRESENT_FX_SQL) + """
SELECT s.state, COUNT(DISTINCT s.entity_id) AS state_count, COUNT(DISTINCT p.wallet_address) AS records_exist
FROM folded s LEFT JOIN pnl_present_fx p ON s.entity_id = p.wallet_address
WHERE s.task_name = '1-URGENT' GROUP BY s.state""")
def q_states_vs_records(spark, sf_dir):
    return st.states_vs_records(_folded(spark, sf_dir), fx.pnl_present_fx(spark, sf_dir), "1-URGENT")


@register("retry_due", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + f"""
SELECT *, last_attempt_at + to_microseconds(CAST(5 * pow(2, attempt_count - 1) * 1000000 AS BIGINT)) AS next_retry_at
FROM folded WHERE state = 'failed' AND attempt_count < 3
  AND last_attempt_at + to_microseconds(CAST(5 * pow(2, attempt_count - 1) * 1000000 AS BIGINT))
      <= TIMESTAMP '{fx.NOW_ORDERS}'""")
def q_retry_due(spark, sf_dir):
    return st.retry_due(_folded(spark, sf_dir), ts_ntz(fx.NOW_ORDERS))


# ----------------------------------------------------------------- run log
RUN_EVENTS_SQL = """runs AS (
  SELECT o_orderpriority AS task_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_id,
         MIN(o_orderdate) AS day, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
         COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_p
  FROM orders GROUP BY 1, 2),
run_events AS (
  SELECT task_name, run_id, day AS event_at, 'running' AS status, NULL::BIGINT AS entities_processed,
         NULL::BIGINT AS entities_failed, NULL::BIGINT AS entities_skipped FROM runs
  UNION ALL
  SELECT task_name, run_id, day + to_minutes(n), CASE WHEN n_f = 0 THEN 'success' WHEN n_f < n THEN 'partial_success'
         ELSE 'failed' END, n - n_f, n_f, n_p FROM runs)"""


def run_events_fx(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    runs = o.groupBy(F.col("o_orderpriority").alias("task_name"),
                     F.col("o_orderdate").cast("date").cast("string").alias("run_id")).agg(
        F.min("o_orderdate").alias("day"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_p"))
    start = runs.select("task_name", "run_id", F.col("day").alias("event_at"), F.lit("running").alias("status"),
                        *[F.lit(None).cast("long").alias(c) for c in
                          ("entities_processed", "entities_failed", "entities_skipped")])
    status = (F.when(F.col("n_f") == 0, "success").when(F.col("n_f") < F.col("n"), "partial_success")
              .otherwise("failed"))
    end = runs.select("task_name", "run_id",
                      (F.col("day") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n").cast("int")))
                      .alias("event_at"), status.alias("status"),
                      (F.col("n") - F.col("n_f")).alias("entities_processed"),
                      F.col("n_f").alias("entities_failed"), F.col("n_p").alias("entities_skipped"))
    return start.unionByName(end)


RUN_FOLD_SQL = """folded_runs AS (
  SELECT task_name, run_id, MIN(CASE WHEN status = 'running' THEN event_at END) AS started_at,
         MAX(CASE WHEN status <> 'running' THEN event_at END) AS completed_at,
         arg_max(status, (event_at, status)) AS status,
         MAX(CASE WHEN status <> 'running' THEN entities_processed END) AS entities_processed,
         MAX(CASE WHEN status <> 'running' THEN entities_failed END) AS entities_failed,
         MAX(CASE WHEN status <> 'running' THEN entities_skipped END) AS entities_skipped
  FROM run_events GROUP BY 1, 2)"""


@register("task_run_log", W(RUN_EVENTS_SQL, RUN_FOLD_SQL) + """
SELECT *, date_diff('microsecond', started_at, completed_at) / 1e6 AS duration_seconds FROM folded_runs""")
def q_task_run_log(spark, sf_dir):
    return st.fold_run_log(run_events_fx(spark, sf_dir))


@register("alert_thresholds", W(RUN_EVENTS_SQL, RUN_FOLD_SQL) + """,
r AS (SELECT *, date_diff('microsecond', started_at, completed_at) / 1e6 AS duration_seconds FROM folded_runs)
SELECT task_name, COUNT(*) AS runs,
       CAST(COUNT(*) FILTER (WHERE status IN ('success', 'completed')) AS DOUBLE) * 100.0 / COUNT(*) AS success_rate,
       MAX(duration_seconds) AS max_duration_seconds,
       CAST(COUNT(*) FILTER (WHERE status IN ('success', 'completed')) AS DOUBLE) * 100.0 / COUNT(*) < 90.0 AS low_success_rate,
       MAX(duration_seconds) > 7200.0 AS too_slow
FROM r GROUP BY task_name""")
def q_alert_thresholds(spark, sf_dir):
    return st.alert_thresholds(st.fold_run_log(run_events_fx(spark, sf_dir)))


@register("state_by_task", W(fx.STATE_EVENTS_FX_SQL, FOLD_SQL) + """
SELECT task_name, state, COUNT(*) AS entity_count FROM folded GROUP BY task_name, state""")
def q_state_by_task(spark, sf_dir):
    """A13 (notebook form): entities per (task, state)."""
    return _folded(spark, sf_dir).groupBy("task_name", "state").agg(F.count(F.lit(1)).alias("entity_count"))


# ------------------------------------------------------------- table store
LINES_A_FILE = 1000


def _store(spark):
    """A store under the session's checkpoint folder (these entries write)."""
    import uuid

    from cairn.session import ensure_checkpoint_dir
    from cairn.sources.store import TableStore
    return TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/cairn-store-{uuid.uuid4().hex}")


@register("store_scan", W(fx.TOKENS_FX_SQL) + """
SELECT token_address, price, liquidity FROM tokens_fx""")
def q_store_scan(spark, sf_dir):
    """A written table read back with three of its columns."""
    s = _store(spark)
    s.write("tokens", fx.tokens_fx(spark, sf_dir))
    return s.read("tokens", ["token_address", "price", "liquidity"])


@register("store_append", W(fx.TOKENS_FX_SQL) + """
SELECT token_address, price, silver_processed FROM tokens_fx""")
def q_store_append(spark, sf_dir):
    """A table and two appended batches read as one."""
    s = _store(spark)
    t = fx.tokens_fx(spark, sf_dir)
    for r in range(3):
        s.append("tokens", t.where(F.col("p_partkey") % 3 == r).select("token_address", "price", "silver_processed"))
    return s.read("tokens")


@register("store_first_upsert", W(fx.TOKENS_FX_SQL, BATCH_SQL) + """
SELECT token_address, price, liquidity, false AS silver_processed FROM src""")
def q_store_first_upsert(spark, sf_dir):
    """S7 into a table that does not exist: repeated keys merged, defaults set."""
    s = _store(spark)
    _, src = batch_fx(spark, sf_dir)
    s.upsert("tokens", src.unionByName(src), ["token_address"], ["price", "liquidity"], DEFAULTS)
    return s.read("tokens")


@register("store_partitioned_write", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id, CAST(CAST(webhook_timestamp AS DATE) AS VARCHAR) AS processing_date FROM webhooks_fx""")
def q_store_partitioned_write(spark, sf_dir):
    """Partitions by date, one half rewritten: nothing lost, nothing doubled."""
    from cairn.sources.store import partitioned_write
    e = fx.webhooks_fx(spark, sf_dir).select("webhook_id", F.to_date("webhook_timestamp").alias("processing_date"))
    path = _store(spark).path("events")
    partitioned_write(e, path)
    partitioned_write(e.where(F.dayofmonth("processing_date") <= 15), path)
    return spark.read.parquet(path).select("webhook_id", F.col("processing_date").cast("string").alias("processing_date"))


@register("table_schema", W(fx.TOKENS_FX_SQL) + """
SELECT column_name, data_type, column_default, (SELECT COUNT(*) FROM tokens_fx) AS row_count, value_count,
       value_count < (SELECT COUNT(*) FROM tokens_fx) AS has_nulls
FROM (SELECT 'token_address' AS column_name, 'string' AS data_type, NULL AS column_default, COUNT(token_address) AS value_count FROM tokens_fx
      UNION ALL SELECT 'price', 'double', NULL, COUNT(price) FROM tokens_fx
      UNION ALL SELECT 'liquidity', 'double', NULL, COUNT(liquidity) FROM tokens_fx
      UNION ALL SELECT 'silver_processed', 'boolean', 'false', COUNT(silver_processed) FROM tokens_fx) c""")
def q_table_schema(spark, sf_dir):
    """Columns, types and defaults of a stored table, and how far each is filled."""
    from cairn.sources.store import table_schema
    s = _store(spark)
    s.write("tokens", fx.tokens_fx(spark, sf_dir).select("token_address", F.col("price").cast("double").alias("price"), "liquidity", "silver_processed"))
    return table_schema(s.read("tokens"), DEFAULTS)


@register("read_json_drop", W(fx.WEBHOOKS_FX_SQL) + """
SELECT webhook_id % 2 + 1 AS call, CASE WHEN webhook_id % 23 = 0 THEN 'rejected' ELSE 'read' END AS outcome,
       CASE WHEN webhook_id % 23 <> 0 THEN webhook_id END AS doc
FROM webhooks_fx""")
def q_read_json_drop(spark, sf_dir):
    """Every pushed event lands as a line of a JSON file, so many lines a file, half of them between
    two calls; the second call sees only the files the first did not. Lines that do not parse are set aside."""
    from cairn.functions.scan import cut
    from cairn.sources.json_pages import read_json_drop
    path = _store(spark).path("drop")
    docs = fx.webhooks_fx(spark, sf_dir).select((F.col("webhook_id") % 2).alias("half"), F.when(
        F.col("webhook_id") % 23 == 0, F.lit("{cut short")).otherwise(F.to_json(F.struct(F.col("webhook_id").alias("id")))).alias("value"))
    out, done = None, None
    for half in (0, 1):
        docs.where(F.col("half") == half).select("value").write.mode("append").option("maxRecordsPerFile", LINES_A_FILE).text(f"{path}/part={half}")
        ok, bad = read_json_drop(spark, f"{path}/part=*", done, documents="lines")
        got = cut(ok.select("file", F.lit("read").alias("outcome"), F.get_json_object("value", "$.id").cast("long").alias("doc"))
                  .unionByName(bad.select("file", F.lit("rejected").alias("outcome"), F.lit(None).cast("long").alias("doc"))))
        done = got.select("file").distinct()
        part = got.select(F.lit(half + 1).cast("long").alias("call"), "outcome", "doc")
        out = part if out is None else out.unionByName(part)
    return out
