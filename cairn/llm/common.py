"""Helpers shared by the training-data operators: table access, lineage cuts, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_EDGES = 200_000  # edges of a graph that one task connects by itself; larger graphs go through rounds
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BATCH_BYTES = 2 << 20  # long texts: a Python batch is bounded by bytes, not only by rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read by Spark from wherever ``sf_dir`` lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch handed to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, ``spark.checkpoint.dir``. Only a local session without
    one (tests) gets a scratch folder; a cluster session must name it."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            path = tempfile.mkdtemp(prefix="cairn-llm-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that neither later steps nor a lost
    executor run its lineage again. Its shuffle files, which nothing reads any more, go at once: else they
    stay on disk until the driver happens to collect its garbage."""
    checkpoint_folder(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a run of its own: ``df`` itself may have shuffles that others read
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """A broadcast hint after a count of ``df`` (give it stored rows); beyond ``max_rows`` the join
    shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash with ``df``'s own (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of the nodes 0 to n - 1 the smallest one that the edges (a, b) connect it with. Each round
    hangs every root on its smallest neighbour and at least halves the roots that still have one."""
    up = np.arange(n)
    while len(a):
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up, above := up[up]):
            up = above
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    return up


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all edges that come; Python orders texts as Spark does, by code point."""
    held = [batch for batch in batches if batch.num_rows]
    if held:
        a, b = (pa.concat_arrays([batch.column(i) for batch in held]) for i in range(2))
        both = pa.concat_arrays([a, b]).to_numpy(zero_copy_only=False)
        names, at = np.unique(both, return_inverse=True)
        roots = smallest_reachable(at[:len(a)], at[len(a):], len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names, a.type), pa.array(names[roots], a.type)], ["node", "root"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected graph ``edges(a, b)`` (any orderable ids).

    Returns ``(node, root)`` for every node with an edge, root = the smallest node reachable.
    Up to ``TASK_EDGES`` distinct edges of long or text ids are connected by one task: rounds of that few
    rows would be mostly the cost of their tasks. Others go by alternating star contraction: each round hangs every neighbour larger than a node, then every
    smaller one, on the smallest neighbour; the number of rounds grows with the logarithm of the
    longest path. A hub's edges are only ever joined with its one minimum, so a hub is a skewed
    join key (split by AQE), never one task's group, and minima are combined before the shuffle.
    Null ids are ignored; an edge from a node to itself adds nothing."""
    e = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = cut(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def stars(both: DataFrame) -> DataFrame:
        """Every row (u, v): v hung on the smallest of u and its neighbours."""
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(low, "u")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    seen = state(e)
    kind = dict(e.dtypes)["a"]
    if 0 < seen[0] <= TASK_EDGES and kind in ("bigint", "string"):
        return cut(e.coalesce(1).mapInArrow(_connected, f"node {kind}, root {kind}"))
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (stars(both).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        hung = stars(large)
        small = (hung.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionAll(hung.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .filter("a <> b").distinct())
        e = cut(small)
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
