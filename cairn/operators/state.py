"""Per-entity processing state as an event log folded per key (M4-M8, A13,
J5, Q5, D10). Appending events and folding them replaces the reference's
read-modify-write of one row per entity; the fold is a single partial
aggregation (``max_by``/``count_if``/``max``), so hot entities pre-aggregate
before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import RetryPolicy

STATE_KEY = ["task_name", "entity_type", "entity_id"]
STATES = ("pending", "processing", "completed", "failed", "skipped")


def state_event(entities: DataFrame, task_name: str, entity_type: str, state: str, at: Column,
                id_col: str = "entity_id", error: Column | None = None, seq: Column | None = None) -> DataFrame:
    """M6: state events for a set of entities (bulk mark processing /
    completed / failed). Append these to the event log."""
    if state not in STATES:
        raise ValueError(f"unknown state {state!r}")
    return entities.select(
        F.lit(task_name).alias("task_name"), F.lit(entity_type).alias("entity_type"),
        F.col(id_col).alias("entity_id"), F.lit(state).alias("state"),
        at.alias("event_at"), (seq if seq is not None else F.lit(0).cast("long")).alias("seq"),
        (error if error is not None else F.lit(None).cast("string")).alias("error_message"))


def fold_states(events: DataFrame) -> DataFrame:
    """M4: current row per (task, type, id): latest state; attempt_count =
    number of 'processing' events; last_attempt_at, completed_at and
    error_message from the latest event of that kind."""
    order = F.struct("event_at", "seq")
    st = F.col("state")
    return events.groupBy(*STATE_KEY).agg(
        F.max_by("state", order).alias("state"),
        F.count_if(st == "processing").alias("attempt_count"),
        F.min("event_at").alias("created_at"),
        F.max("event_at").alias("updated_at"),
        F.max(F.when(st == "processing", F.col("event_at"))).alias("last_attempt_at"),
        F.max(F.when(st == "completed", F.col("event_at"))).alias("completed_at"),
        F.max_by(F.when(st == "failed", F.col("error_message")),
                 F.when(st == "failed", order)).alias("error_message"),
    )


def pending_entities(states: DataFrame, task_name: str, entity_type: str | None = None,
                     limit: int | None = None) -> DataFrame:
    """M5: entities whose state is pending (the reference's exclude-failed
    clause can never exclude anything, so it is not reproduced)."""
    s = states.where((F.col("task_name") == task_name) & (F.col("state") == "pending"))
    if entity_type is not None:
        s = s.where(F.col("entity_type") == entity_type)
    s = s.select("entity_id")
    return s.orderBy("entity_id").limit(limit) if limit else s


def expire_states(states: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """M7: drop completed rows whose completion is older than ``days``."""
    old = (F.col("state") == "completed") & (F.col("completed_at") < now - F.make_dt_interval(F.lit(days)))
    return states.where(~F.coalesce(old, F.lit(False)))


def state_statistics(states: DataFrame) -> DataFrame:
    """Counts by (state, entity_type) plus totals per state, per type
    and overall, in one pass with ROLLUP-style grouping sets."""
    return states.cube("state", "entity_type").agg(
        F.count(F.lit(1)).alias("count"),
        F.grouping_id().alias("level"))


def states_vs_records(states: DataFrame, records: DataFrame, task_name: str) -> DataFrame:
    """The task's state rows left-joined with the records by entity id,
    grouped by state: distinct entities and distinct matching records."""
    r = records.select(F.col("wallet_address").alias("record_id")).distinct()
    s = states.where(F.col("task_name") == task_name)
    j = s.join(r, s.entity_id == r.record_id, "left")
    return j.groupBy("state").agg(F.count_distinct("entity_id").alias("state_count"),
                                  F.count_distinct("record_id").alias("records_exist"))


def retry_due(states: DataFrame, now: Column, policy: RetryPolicy | None = None) -> DataFrame:
    """D10 (declared): failed entities under the attempt limit whose backoff
    (base x multiplier^(attempts-1) seconds after the last attempt) passed."""
    p = policy or RetryPolicy()
    delay = F.lit(p.base_seconds) * F.pow(F.lit(p.multiplier), F.col("attempt_count") - 1)
    next_at = F.col("last_attempt_at") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), delay.cast("decimal(18,6)"))
    return (states.where((F.col("state") == "failed") & (F.col("attempt_count") < p.max_attempts))
            .withColumn("next_retry_at", next_at)
            .where(F.col("next_retry_at") <= now))


# ----------------------------------------------------------------- run log
RUN_STATUSES = ("running", "success", "completed", "partial_success", "completed_with_errors", "failed")


def fold_run_log(events: DataFrame) -> DataFrame:
    """M8: start and end events per run -> one row: times, duration in
    seconds, final status and counts (the end event's values)."""
    end = F.col("status") != "running"
    order = F.struct("event_at", "status")
    return events.groupBy("task_name", "run_id").agg(
        F.min(F.when(~end, F.col("event_at"))).alias("started_at"),
        F.max(F.when(end, F.col("event_at"))).alias("completed_at"),
        F.max_by("status", order).alias("status"),
        F.max(F.when(end, F.col("entities_processed"))).alias("entities_processed"),
        F.max(F.when(end, F.col("entities_failed"))).alias("entities_failed"),
        F.max(F.when(end, F.col("entities_skipped"))).alias("entities_skipped"),
    ).withColumn("duration_seconds",
                 F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")) / 1e6)


def alert_thresholds(runs: DataFrame, min_success_rate: float = 90.0,
                     max_minutes: float = 120.0) -> DataFrame:
    """Q5 (declared): per task, success rate below the floor or a run longer
    than the limit."""
    ok = F.col("status").isin("success", "completed")
    g = runs.groupBy("task_name").agg(
        F.count(F.lit(1)).alias("runs"),
        (F.count_if(ok) * 100.0 / F.count(F.lit(1))).alias("success_rate"),
        F.max("duration_seconds").alias("max_duration_seconds"))
    return g.withColumns({
        "low_success_rate": F.col("success_rate") < min_success_rate,
        "too_slow": F.col("max_duration_seconds") > max_minutes * 60,
    })
