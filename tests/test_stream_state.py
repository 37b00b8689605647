"""Stream state: late rows, day counts from hour sketches within their error, last-wins sessions."""

import pytest
from pyspark.sql import functions as F

from cairn.streaming import state

NOW = {"availableNow": True}
EVENT = "webhook_id long, webhook_timestamp timestamp_ntz, account_address string, token_address string"


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    from datetime import datetime
    t = lambda h, m: datetime(2024, 1, 1, h, m)
    batches = [[(1, t(0, 5), "a", "x"), (2, t(0, 50), "b", None), (3, t(2, 30), "a", "y")],   # watermark 2:20 closes 0 and 1 o'clock
               [(4, t(0, 59), "late", "z"), (5, t(2, 10), "c", "y"), (6, None, "d", "y"), (7, t(3, 20), "a", "x")],  # 3:10 closes 2 o'clock
               [(8, t(3, 0), "e", "x")]]
    for rows in batches:
        land(spark, f"{tmp_path}/in", rows, EVENT)
        hours = state.activity_sketches(spark.readStream.schema(EVENT).parquet(f"{tmp_path}/in"))
        state.start_append(hours, f"{tmp_path}/out", f"{tmp_path}/cp", NOW).awaitTermination()
    got = state.hourly_from_sketches(spark.read.parquet(f"{tmp_path}/out")).orderBy("window_start").collect()
    assert [(r[0].hour, r[2], r[3], r[4]) for r in got] == [(0, 2, 2, 1), (2, 2, 2, 1)]


def test_days_from_hours_within_the_stated_error(spark):
    """60,000 accounts a day, each in several hours: sums of hour counts would be far off."""
    ev = spark.range(240000).select(
        F.col("id").alias("webhook_id"), (F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), (F.col("id") % 48).cast("int"))).alias("webhook_timestamp"),
        F.concat(F.lit("a"), (F.col("id") % 60000).cast("string")).alias("account_address"), F.concat(F.lit("t"), (F.col("id") % 900).cast("string")).alias("token_address"))
    hours = state.activity_sketches(ev)
    exact = {r[0]: r for r in ev.groupBy(F.to_date("webhook_timestamp")).agg(F.count("*"), F.count_distinct("account_address"), F.count_distinct("token_address")).collect()}
    days = state.daily_from_sketches(hours).collect()
    assert len(days) == 2
    for d in days:
        e = exact[d[0]]
        assert d[1] == e[1] and d[3] == e[3] and abs(d[2] - e[2]) <= 3 * 0.0082 * e[2]


@pytest.mark.parametrize("order", [1, -1])
def test_last_wins(spark, tmp_path, order):
    """The later time wins whatever the order of arrival; a replay after the gap is a row of its own."""
    from datetime import datetime, timedelta
    t = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    schema = "webhook_id long, ingested_at timestamp_ntz, status string"
    rows = [(1, t(0), "first"), (1, t(8), "second"), (1, t(16), "third"), (2, t(3), "only"), (1, t(90), "much later"), (None, t(5), "no id"), (3, None, "no time")]
    land(spark, f"{tmp_path}/in", rows[::order] + [(-1, t(5000), "end")], schema)
    out = state.last_wins(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    state.start_append(out, f"{tmp_path}/out", f"{tmp_path}/cp", NOW).awaitTermination()
    got = sorted((r["webhook_id"], r["status"], r["pushes"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "much later", 1), (1, "third", 3), (2, "only", 1)]


def test_status_counts_grow_by_trigger(spark, tmp_path):
    schema, seen = "webhook_id long, processing_status string", []
    for rows in ([(1, "pending"), (2, "failed")], [(3, "processed"), (4, None)]):
        land(spark, f"{tmp_path}/in", rows, schema)
        state.start_status_counts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), lambda df, _: seen.append(tuple(df.first())), f"{tmp_path}/cp", NOW).awaitTermination()
    assert seen[0] == (2, 1, 0, 1) and seen[-1] == (4, 1, 1, 1)
