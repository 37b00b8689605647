"""Registered queries for the streaming family: batch forms with oracle SQL,
and the end-to-end file-stream ingest (rows-only)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn.functions.expr import ts_ntz
from cairn.plans import fixtures as fx
from cairn.plans.registry import register
from cairn.streaming import ingest

W = fx.with_ctes
LINES_A_FILE = 5000


@register("event_status_counts", W(fx.WEBHOOKS_FX_SQL) + """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE processing_status = 'pending') AS pending,
       COUNT(*) FILTER (WHERE processing_status = 'processed') AS processed, COUNT(*) FILTER (WHERE processing_status = 'failed') AS failed
FROM webhooks_fx""")
def q_event_status_counts(spark, sf_dir):
    return ingest.status_counts(fx.webhooks_fx(spark, sf_dir))


@register("expired_events", W(fx.WEBHOOKS_FX_SQL) + f"""
SELECT COUNT(*) FILTER (WHERE ingested_at < TIMESTAMP '{fx.NOW_EVENTS}' - INTERVAL 7 DAY) AS expired_count FROM webhooks_fx""")
def q_expired_events(spark, sf_dir):
    return ingest.expired_events(fx.webhooks_fx(spark, sf_dir), ts_ntz(fx.NOW_EVENTS), 7)


@register("activity_windows", W(fx.WEBHOOKS_FX_SQL) + """
SELECT time_bucket(INTERVAL 1 HOUR, webhook_timestamp) AS window_start,
       time_bucket(INTERVAL 1 HOUR, webhook_timestamp) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS webhook_count, COUNT(DISTINCT account_address) AS unique_accounts,
       COUNT(DISTINCT token_address) AS unique_tokens
FROM webhooks_fx GROUP BY 1, 2""")
def q_activity_windows(spark, sf_dir):
    return ingest.activity_windows(fx.webhooks_fx(spark, sf_dir), "1 hour", watermark=None,
                                   exact_distinct=True)


@register("ingest_stream", W(fx.WEBHOOKS_FX_SQL) + """
SELECT CASE WHEN odd THEN NULL ELSE transaction_signature END AS transaction_signature,
       CASE WHEN odd THEN 'UNKNOWN' ELSE COALESCE(webhook_type, 'UNKNOWN') END AS webhook_type,
       CASE WHEN odd THEN NULL ELSE account_address END AS account_address,
       CASE WHEN odd THEN NULL ELSE token_address END AS token_address, 'pending' AS processing_status
FROM (SELECT *, webhook_id % 13 = 0 OR webhook_id % 17 = 0 OR webhook_id % 19 = 0 OR webhook_id % 23 = 0 AS odd
      FROM webhooks_fx) x""")
def q_ingest_stream(spark, sf_dir):
    """T1/T2/T7 end to end (runs a stream): payload lines of every pushed
    event land as files under the session's checkpoint folder (so many lines a
    file: their number grows with the events), a file stream writes them
    micro-batch by micro-batch, and the event table is returned: one row per
    push, equal payloads included."""
    from cairn.plans.q_sources import event_payloads
    from cairn.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cairn-stream-{uuid.uuid4().hex}"
    lines = event_payloads(spark, sf_dir).select(F.col("raw_payload").alias("value"))
    lines.write.option("maxRecordsPerFile", LINES_A_FILE).text(f"{base}/landing")
    q = ingest.start_ingest(spark, f"{base}/landing", f"{base}/events", f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return ingest.read_events(spark, f"{base}/events").select(
        "transaction_signature", "webhook_type", "account_address", "token_address", "processing_status")
