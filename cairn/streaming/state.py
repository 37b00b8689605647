"""Streaming state with bounded life: hour sketches that merge into days (T6), last-wins dedupe of
replayed pushes (T2) and running status counts in complete mode (T4).

Every state here ends by itself: windows and sessions close behind the watermark, the status counts are
one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.streaming.ingest import _instant, status_counts

LG_K = 14  # 2^14 registers: relative standard error 1.04 / sqrt(2^14) = 0.8 %, exact to rounding below about 1,500


def _naive(c: Column) -> Column:
    """An instant as naive UTC wall time, whatever the session zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c) / 1_000_000).cast("decimal(18,6)"))


def activity_sketches(events: DataFrame, size: str = "1 hour", delay: str = "10 minutes", time: str = "webhook_timestamp") -> DataFrame:
    """Per window the event count and mergeable sketches of its accounts and tokens. In append mode a
    window comes out once, when the watermark (latest time less ``delay``) has passed its end; rows of
    windows that are already out are dropped. Rows without a time belong to no window."""
    src = events.withColumn("_et", _instant(F.col(time))).where(F.col("_et").isNotNull()).withWatermark("_et", delay)
    return src.groupBy(F.window("_et", size).alias("w")).agg(
        F.count(F.lit(1)).alias("webhook_count"),
        F.hll_sketch_agg("account_address", LG_K).alias("accounts"), F.hll_sketch_agg("token_address", LG_K).alias("tokens"),
    ).select(_naive(F.col("w.start")).alias("window_start"), _naive(F.col("w.end")).alias("window_end"), "webhook_count", "accounts", "tokens")


def hourly_from_sketches(hours: DataFrame) -> DataFrame:
    return hours.select("window_start", "window_end", "webhook_count", F.hll_sketch_estimate("accounts").alias("unique_accounts"),
                        F.hll_sketch_estimate("tokens").alias("unique_tokens"))


def daily_from_sketches(hours: DataFrame) -> DataFrame:
    """Per date: events, and distinct accounts and tokens of the whole day from the union of its hours'
    sketches - what distinct counts per hour could not give."""
    return hours.groupBy(F.to_date("window_start").alias("date")).agg(
        F.sum("webhook_count").alias("webhook_count"), F.hll_sketch_estimate(F.hll_union_agg("accounts")).alias("unique_accounts"),
        F.hll_sketch_estimate(F.hll_union_agg("tokens")).alias("unique_tokens"))


def last_wins(events: DataFrame, gap: str = "10 minutes", key: str = "webhook_id", time: str = "ingested_at", tie: str | None = None) -> DataFrame:
    """Replays of an id within ``gap`` of each other give one row, the last one's values (``tie``
    orders equal times). An id's rows are a session that closes ``gap`` after its last one, so its state
    lives that long and no longer; a replay after that is a row of its own, for the keyed upsert of the
    table. Rows without an id or time are dropped."""
    src = events.withColumn("_ing", _instant(F.col(time))).where(F.col("_ing").isNotNull() & F.col(key).isNotNull()).withWatermark("_ing", gap)
    rest = [c for c in events.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct("_ing", *([tie] if tie else [])))
    return src.groupBy(F.session_window("_ing", gap), key).agg(last.alias("v"), F.count(F.lit(1)).alias("pushes")).select(key, "v.*", "pushes")


def start_append(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append closed windows or sessions to a folder of Parquet files; the sink's own log makes a replayed
    batch harmless. One partition a batch is enough for rows that are one per window."""
    return (rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def start_status_counts(events: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    """T4 in complete mode: every trigger hands the counts of all events so far, one row, to ``sink``."""
    return (status_counts(events).writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
