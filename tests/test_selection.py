"""Order statistics, top counts and table sizes without sorts or full shuffles, against plain Python."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairn.functions.selection import order_statistics, top_counts
from cairn.operators import reports as rp
from cairn.sources.table_files import table_stats


def columns():
    rng = random.Random(3)
    yield "uniform", [rng.random() for _ in range(999)]
    yield "magnitudes", [(-1) ** i * 2.0 ** rng.randint(-1070, 1023) for i in range(999)]
    yield "ties", [float(rng.randint(-2, 2)) for _ in range(999)]
    yield "neighbours", [1.0 + k * 2.0 ** -52 for k in range(999)]
    yield "odd", [math.inf, -math.inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0] * 3
    yield "one", [7.5]


@pytest.mark.parametrize("name,values", list(columns()))
def test_every_rank(spark, name, values):
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values + [None]], "v double").repartition(3)
    ranks = sorted(random.Random(2).sample(range(len(values)), min(len(values), 7)) + [len(values) - 1])
    got = order_statistics(df, {"v": ranks})
    want = sorted(values)
    assert got == {("v", r): want[r] for r in ranks}


def test_nan_is_above_all(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (2.0,), (None,)], "v double")
    got = order_statistics(df, {"v": [0, 1, 2]})
    assert (got["v", 0], got["v", 1]) == (1.0, 2.0) and math.isnan(got["v", 2])


def test_percentiles_equal_percentile(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.gauss(0, 50), rng.choice([None, 1.0, 4.0, 9.5])) for _ in range(501)], "a double, b double")
    got = rp.percentiles(df, {"a": "a", "b": "b"}, (0.95, 0.5, 0.25, 0.0, 1.0), 6).first()
    want = df.agg(*[F.percentile(c, q).alias(f"{c}{q}") for c in ("a", "b") for q in (0.95, 0.5, 0.25, 0.0, 1.0)]).first()
    assert [round(x, 5) for x in got] == [round(x, 5) for x in want]
    assert list(rp.percentiles(df.where("false"), {"a": "a"}).first()) == [None] * 3


@pytest.mark.parametrize("buckets", [1, 5, 1 << 16])
def test_top_counts(spark, buckets):
    rng = random.Random(buckets)
    values = [f"k{int(rng.paretovariate(0.7))}" for _ in range(3000)] + [f"flat{i}" for i in range(500)] + [None] * 2000
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(4)
    want = sorted(((k, n) for k, n in Counter(v for v in values if v).items()), key=lambda x: (-x[1], x[0]))
    for n in (1, 20, 5000):
        assert [tuple(r) for r in top_counts(df, "k", n, buckets).collect()] == want[:n]
    assert top_counts(df.where("false"), "k", 3).count() == 0


def test_top_counts_shuffle_candidates_only(spark):
    """One value holds a third of the rows; the last step counts a small part of all values."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    got = top_counts(df, "k", 1)
    assert [tuple(r) for r in got.collect()] == [("hot", 10000)]
    assert "left_semi" in got._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftsemi", "left_semi")


def test_table_stats_against_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    got = {r["table_name"]: r for r in table_stats(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}).collect()}
    sizes = [os.path.getsize(os.path.join(tmp_path, "a", f)) for f in os.listdir(tmp_path / "a") if f.endswith(".parquet")]
    assert (got["a"]["row_count"], got["a"]["files"], got["a"]["bytes"], got["a"]["largest_file"]) == (1000, 3, sum(sizes), max(sizes))
    assert got["b"]["row_count"] == got["b"]["bytes"] == 0
