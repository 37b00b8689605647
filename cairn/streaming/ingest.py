"""Structured Streaming ingest of pushed events.

Pushed payloads land as JSON-lines files; a file stream (at most 500 files
per micro-batch) extracts the event fields (S5) and keys each push by its
payload and delivery. Each micro-batch is one partition of the event table, so
the cost per batch is the batch, never the table, and a replayed epoch
(``foreachBatch`` is at-least-once) replaces exactly what it wrote. Readers see
the merged table: last ingest wins per id (T2), a partial aggregation. The
checkpointed source keeps a backlog instead of expiring files (T3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.sources.json_pages import event_id, extract_event


def parse_events(lines: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """T7 / S5 on a (streaming or batch) frame of raw payload lines (``value``,
    and ``source_file`` where the file source gave it)."""
    ing = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    p = F.col("value")
    where = F.col("source_file") if "source_file" in lines.columns else F.lit(None).cast("string")
    return lines.select(
        event_id(p).alias("webhook_id"),
        *extract_event(p),
        ing.alias("webhook_timestamp"),
        p.alias("raw_payload"),
        ing.alias("ingested_at"),
        F.lit("pending").alias("processing_status"),
        where.alias("source_file"),
    ).withColumns({
        "processing_date": F.date_format("ingested_at", "yyyy-MM-dd"),
        "processed_to_silver": F.lit(False),
    })


def read_landing(spark: SparkSession, landing_dir: str, max_files: int = 500,
                 clean_source: str | None = None) -> DataFrame:
    """File source over the landing folder (S10 streaming form)."""
    r = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
         .option("latestFirst", "false"))
    if clean_source:
        r = r.option("cleanSource", clean_source)
    return r.load(landing_dir).select("value", F.col("_metadata.file_path").alias("source_file"))


def with_delivery_ids(batch: DataFrame) -> DataFrame:
    """Each push of a micro-batch its own id: payload, file and which of the
    file's equal payloads it is. Equal lines of a file are interchangeable, so
    a replayed epoch gives the same ids."""
    nth = F.row_number().over(Window.partitionBy("source_file", "raw_payload").orderBy(F.lit(1)))
    return batch.withColumn("webhook_id", event_id(
        F.coalesce("raw_payload", F.lit("")), F.concat_ws("#", "source_file", nth.cast("string"))))


def write_epoch(events_root: str):
    """foreachBatch sink: one partition per epoch, replaced as a whole when
    the epoch is replayed (dynamic partition overwrite; Spark's commit moves a
    finished partition into place, so a part-written one is never read)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        with_delivery_ids(batch).withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(events_root)
    return run


def read_events(spark: SparkSession, events_root: str) -> DataFrame:
    """The event table: one row per webhook_id, the last ingest wins (ties:
    the later epoch). ``max_by`` pre-aggregates per task, so a repeated id
    never becomes a large group."""
    from cairn.operators.incremental import dedupe_source
    return dedupe_source(spark.read.parquet(events_root), ["webhook_id"], ["ingested_at", "epoch"])


def start_ingest(spark: SparkSession, landing_dir: str, events_root: str, checkpoint: str,
                 trigger: dict | None = None, max_files: int = 500):
    """Landing files -> parsed events -> one directory per micro-batch.
    ``trigger`` defaults to every 10 seconds; tests use availableNow."""
    events = parse_events(read_landing(spark, landing_dir, max_files))
    w = events.writeStream.foreachBatch(write_epoch(events_root)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def _instant(c: Column) -> Column:
    """Naive UTC time -> TIMESTAMP instant without the session zone."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c))


def first_wins(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """T2 option: keep the first event per id within the watermark delay
    (streaming state is kept only for the delay)."""
    return (events.withColumn("_ing", _instant(F.col("ingested_at"))).withWatermark("_ing", delay)
            .dropDuplicatesWithinWatermark(["webhook_id"]).drop("_ing"))


def activity_windows(events: DataFrame, size: str = "1 hour", watermark: str | None = "10 minutes",
                     exact_distinct: bool = False) -> DataFrame:
    """Tumbling-window activity (the streaming form of A11/W5): events,
    accounts and tokens per window; late rows beyond the watermark are
    dropped. Streaming aggregation needs an approximate distinct count."""
    # event time as an instant (watermarks need TIMESTAMP): naive UTC wall
    # time -> epoch micros -> instant, and back for the window bounds, so the
    # session time zone plays no part
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    src = events.withColumn("_et", _instant(F.col("webhook_timestamp")))
    src = src.withWatermark("_et", watermark) if watermark else src
    distinct = F.count_distinct if exact_distinct else F.approx_count_distinct
    back = lambda c: epoch + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c) / 1_000_000).cast("decimal(18,6)"))
    return src.groupBy(F.window("_et", size).alias("w")).agg(
        F.count(F.lit(1)).alias("webhook_count"),
        distinct("account_address").alias("unique_accounts"),
        distinct("token_address").alias("unique_tokens"),
    ).select(back(F.col("w.start")).alias("window_start"), back(F.col("w.end")).alias("window_end"),
             "webhook_count", "unique_accounts", "unique_tokens")


def status_counts(events: DataFrame) -> DataFrame:
    """T4: total / pending / processed / failed (complete mode on a stream)."""
    s = F.col("processing_status")
    return events.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "pending").alias("pending"),
        F.count_if(s == "processed").alias("processed"),
        F.count_if(s == "failed").alias("failed"))


def expired_events(events: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """T5: how many events are older than ``days`` (count only)."""
    return events.agg(F.count_if(F.col("ingested_at") < now - F.make_dt_interval(F.lit(days)))
                      .alias("expired_count"))


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str = "webhooks",
               starting_offsets: str = "latest") -> DataFrame:
    """Pushed events from a Kafka topic (JSON values) as the same
    ``value`` column the file stream gives, ready for ``parse_events``. Needs
    the Kafka connector on the classpath (not installed in this environment,
    so this path is untested here)."""
    try:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
               .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    except Exception as e:  # connector missing: say so plainly
        raise RuntimeError("Kafka source unavailable: add the spark-sql-kafka connector to the "
                           "session's packages") from e
    return raw.select(F.col("value").cast("string").alias("value"))
