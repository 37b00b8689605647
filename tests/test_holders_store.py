"""Holder band edge cases, upsert semantics and stored tables."""

import tempfile

from pyspark.sql import functions as F

from cairn.config import HolderBand
from cairn.operators.holders import holder_band
from cairn.operators.incremental import upsert
from cairn.sources.store import TableStore, partitioned_write, table_schema


def test_holder_band_edges(spark):
    rows = [("t10", f"w{i:02d}", float(100 - i)) for i in range(10)] + [("t1", "solo", 5.0)] + \
           [("tn", f"n{i:03d}", float(200 - i)) for i in range(150)]
    h = spark.createDataFrame(rows, "token_address string, wallet_address string, ui_amount double")
    toks = spark.createDataFrame([("t10", 10), ("t1", 1), ("tn", None)], "token_address string, holder_count long")
    got = holder_band(h, toks, HolderBand(10.0, 2000, 100)).groupBy("token_address").agg(
        F.min("holder_rank").alias("lo"), F.max("holder_rank").alias("hi"), F.count("*").alias("n"))
    g = {r.token_address: (r.lo, r.hi, r.n) for r in got.collect()}
    assert g["t10"] == (2, 10, 9)      # skip 1, take 9
    assert g["t1"] == (1, 1, 1)        # skip 0, take 1
    assert g["tn"] == (1, 100, 100)    # no count: first 100


def test_upsert_twice_equals_once(spark):
    tgt = spark.createDataFrame([("a", 1.0, True), ("b", 2.0, False)], "k string, v double, flag boolean")
    src = spark.createDataFrame([("b", 20.0), ("c", float("nan"))], "k string, v double")
    once = upsert(tgt, src, ["k"], ["v"], {"flag": False})
    twice = upsert(once, src, ["k"], ["v"], {"flag": False})
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    assert a == [("a", 1.0, True), ("b", 20.0, False), ("c", None, False)]
    full = {r.k: r for r in upsert(tgt, src, ["k"], None, {"flag": False}).collect()}
    assert full["a"].flag is True and full["b"].flag is False


def test_store(spark):
    root = tempfile.mkdtemp(prefix="cairn-store-")
    st = TableStore(spark, root)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert not st.exists("t") and st.read("t", schema=df.schema).count() == 0
    st.write("t", df)
    st.upsert("t", spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int"), ["k"])   # reads what it overwrites
    assert sorted(map(tuple, st.read("t").collect())) == [("a", 1), ("b", 3), ("c", 4)]
    st.append("t", spark.createDataFrame([(5, "d")], "v int, k string"))
    assert st.read("t").count() == 4 and st.read("t", ["v"]).columns == ["v"]
    st.rewrite("t", lambda t: t.where("v > 1"))
    assert sorted(map(tuple, st.read("t").collect())) == [("b", 3), ("c", 4), ("d", 5)]
    stats = st.stats(["t"]).first()
    assert stats.row_count == 3 and stats.bytes > 0
    partitioned_write(df.withColumn("processing_date", F.lit("2024-01-01")), f"{root}/p")
    assert spark.read.parquet(f"{root}/p").count() == 2
    got = table_schema(spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"), {"v": 0}).collect()
    assert [tuple(r) for r in got] == [("k", "string", None, 2, 1, True), ("v", "int", "0", 2, 2, False)]
    nan = spark.createDataFrame([("a", float("nan")), ("a", 2.0)], "k string, x double")
    st.upsert("first", nan, ["k"], ["x"], {"flag": False})   # the first upsert merges
    assert [tuple(r) for r in st.read("first").collect()] == [("a", 2.0, False)]


def test_holder_band_hot_tokens_same(spark):
    rows = [(f"t{i % 3}", f"w{i:04d}", float(i % 50)) for i in range(600)]
    h = spark.createDataFrame(rows, "token_address string, wallet_address string, ui_amount double")
    toks = spark.createDataFrame([("t0", 200), ("t1", None), ("t2", 150)], "token_address string, holder_count long")
    b = HolderBand(10.0, 50, 30)
    a = sorted(map(tuple, holder_band(h, toks, b, hot_threshold=10 ** 9).collect()))
    c = sorted(map(tuple, holder_band(h, toks, b, hot_threshold=10).collect()))
    assert a == c and len(a) > 0


def test_upsert_duplicate_source_keys_last_wins(spark):
    tgt = spark.createDataFrame([("a", 1, 0, True)], "k string, v int, at int, flag boolean")
    src = spark.createDataFrame([("a", 5, 2), ("a", 7, 9), ("b", 3, 1), ("b", 4, 0)], "k string, v int, at int")
    out = {r.k: r for r in upsert(tgt, src, ["k"], ["v", "at"], {"flag": False}, source_order=["at"]).collect()}
    assert (out["a"].v, out["a"].at, out["a"].flag) == (7, 9, True)
    assert (out["b"].v, out["b"].flag) == (3, False)
