"""Property test: the range-partitioned scan (hot-key form) equals the
window scan for every aggregate kind and frame, on generated data with keys
spread over many slices."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.functions.scan import Run, ranged_scan, window_scan

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10_000),
                          st.one_of(st.none(), st.integers(-50, 50))),
                min_size=1, max_size=120, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_ranged_scan_equals_window_scan(spark, data):
    df = spark.createDataFrame(data, "k string, t int, v int")
    order = [(F.col("t"), True)]
    runs = {"s": Run("sum", F.col("v")), "s_x": Run("sum", F.col("v"), inclusive=False),
            "mn": Run("min", F.col("v")), "mx_x": Run("max", F.col("v"), inclusive=False),
            "l": Run("last", F.col("v")), "l_x": Run("last", F.col("v"), inclusive=False),
            "n": Run("total", F.col("v"))}
    cols = ["k", "t", *runs]
    a = sorted(map(tuple, window_scan(df, ["k"], order, runs).select(cols).collect()))
    b = sorted(map(tuple, ranged_scan(df, ["k"], order, runs, slices=7).select(cols).collect()))
    assert a == b


ranked = st.lists(st.tuples(st.integers(0, 1000), st.sampled_from(["x", "y"])), min_size=1, max_size=150,
                  unique_by=lambda r: r[0])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ranked)
def test_range_row_numbers_equal_windows(spark, data):
    from pyspark.sql import Window

    from cairn.functions.ranking import row_numbers
    df = spark.createDataFrame(data, "v int, g string")
    order = [F.col("v").desc()]
    got = row_numbers(df, order, {"r": [], "rg": ["g"]}, num_partitions=5)
    want = df.withColumns({"r": F.row_number().over(Window.orderBy(*order)),
                           "rg": F.row_number().over(Window.partitionBy("g").orderBy(*order))})
    cols = ["v", "g", "r", "rg"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_range_ranks_on_a_table_that_is_sampled(spark):
    """100,000 rows with all columns: the range exchange samples its bounds."""
    from pyspark.sql import functions as F

    from cairn.functions.ranking import row_numbers
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    n = ev.count()
    for parts in (4, 16, 200):
        got = row_numbers(ev.repartition(7), ["ts", "event_id"], {"r": []}, num_partitions=parts)
        row = got.agg(F.count("*"), F.count_distinct("r"), F.min("r"), F.max("r")).first()
        assert tuple(row) == (n, n, 1, n)
    runs = {"s": Run("sum", F.lit(1)), "m": Run("max", F.col("event_id"))}
    order = [(F.col("ts"), True), (F.col("event_id"), True)]
    a = window_scan(ev, ["user_id"], order, runs).select("event_id", "s", "m")
    b = ranged_scan(ev.repartition(5), ["user_id"], order, runs, slices=16).select("event_id", "s", "m")
    assert b.count() == n and a.exceptAll(b).isEmpty()
