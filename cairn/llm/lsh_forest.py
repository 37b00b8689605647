"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a string of sign bits and keeps the strings of its rows as a sorted array: a
prefix is a contiguous range of it. A query descends in every tree to its longest matching prefix,
then all trees ascend in step, one bit at a time, until their ranges together hold ``budget``
candidates; these are scored exactly.

The rows lie in shards of bounded size, the queries in blocks, and one task searches one block in one
shard's forest. The bits' thresholds and the budget are fitted on a bounded sample: the budget is the
smallest of a ladder that finds the wanted share of the sample's true neighbours (data without
structure needs a large one, clustered data a small one)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, cut

BITS = 32
LADDER = (0.125, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0)  # candidates (with repeats) per shard row


class Forest:
    """Hash functions of the forest and, after ``build``, its sorted arrays over one shard."""

    def __init__(self, dim: int, trees: int, seed: int, largest_norm: float):
        rng = np.random.default_rng(seed)
        self.trees, self.norm = trees, largest_norm
        self.planes = rng.standard_normal((dim + 1, trees * BITS)).astype(np.float32)
        self.cuts = np.zeros(trees * BITS, np.float32)

    def lifted(self, x: np.ndarray, rows: bool) -> np.ndarray:
        """Inner product as angle: rows get the component that makes all norms equal, queries a 0."""
        if rows:
            x = x / self.norm
            rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
        else:
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            rest = np.zeros(len(x))
        return np.column_stack([x, rest]).astype(np.float32)

    def fit(self, sample: np.ndarray) -> None:
        """Each bit cuts the sample in half."""
        self.cuts = np.median(self.lifted(sample, True) @ self.planes, axis=0)

    def strings(self, x: np.ndarray, rows: bool) -> np.ndarray:
        """(trees, n) hash strings; the first bit is the highest."""
        bits = (self.lifted(x, rows) @ self.planes > self.cuts).reshape(len(x), self.trees, BITS)
        packed = np.packbits(bits, axis=2).view(">u4")[:, :, 0]
        return packed.T.astype(np.uint32)

    def build(self, x: np.ndarray) -> None:
        self.x = x
        strings = self.strings(x, True)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def search(self, q: np.ndarray, k: int, budget: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (row positions, scores) of its best k candidates, best first."""
        n = len(self.x)
        depth = min(BITS, int(np.ceil(np.log2(max(2, n)))) + 4)
        strings = self.strings(q, False).astype(np.uint64)
        # ranges of the prefixes of every length: [length][tree, query]
        lo = np.empty((depth + 1, self.trees, len(q)), np.int64)
        hi = np.empty_like(lo)
        for length in range(depth + 1):
            shift = np.uint64(BITS - length)
            first = (strings >> shift) << shift
            last = first + (np.uint64(1) << shift) - np.uint64(1)
            for t in range(self.trees):
                lo[length, t] = np.searchsorted(self.sorted[t], first[t].astype(np.uint32), "left")
                hi[length, t] = np.searchsorted(self.sorted[t], last[t].astype(np.uint32), "right")
        held = (hi - lo).sum(axis=1)  # [length, query]
        # longest prefix length at which the trees together hold the budget; all rows at length 0
        level = np.where((held >= budget).any(axis=0), depth - np.argmax((held >= budget)[::-1], axis=0), 0)
        out = []
        for i in range(len(q)):
            found = np.zeros(n, bool)
            for t in range(self.trees):
                found[self.order[t, lo[level[i], t, i]:hi[level[i], t, i]]] = True
            cand = np.flatnonzero(found)
            score = self.x[cand] @ q[i]
            if len(cand) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k]
                near = score >= kth - 1e-9 * max(1.0, abs(kth))  # rounding apart, all that may rank
                cand = cand[near]
            exact = np.cumsum(self.x[cand] * q[i], axis=1)[:, -1]  # left to right, in double precision
            out.append((cand, exact))
        return out


def fitted(sample: np.ndarray, trees: int, seed: int, largest_norm: float, k: int, recall: float, queries: int,
           least: int) -> tuple[Forest, float]:
    """A forest fitted on the sample and the budget per row that reaches ``recall`` there."""
    forest = Forest(sample.shape[1], trees, seed, largest_norm)
    forest.fit(sample)
    forest.build(sample)
    q = sample[:queries]
    k = min(k + 1, len(sample))  # a sample query is its own nearest row
    scores = q @ sample.T
    for share in LADDER:
        hits = 0
        for i, (cand, _) in enumerate(forest.search(q, k, max(least, int(share * len(sample))))):
            best = np.sort(scores[i])[-k]
            hits += int((scores[i][cand] >= best).sum())
        if hits >= recall * k * len(q):
            return forest, share
    return forest, float(trees)


def _search_cell(forest: Forest, k: int, share: float, least: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"q": [], "c": [], "score": []})
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        ids = rows["c"].to_numpy()
        forest.build(x)
        q = np.stack(queries["qv"].to_numpy()).astype(np.float64)
        got = forest.search(q, k, max(least, int(share * len(x))))
        picked = []
        for cand, score in got:
            best = np.lexsort((ids[cand], -score))[:k]
            picked.append((ids[cand[best]], score[best]))
        return pd.DataFrame({"q": np.repeat(queries["q"].to_numpy(), [len(c) for c, _ in picked]),
                             "c": np.concatenate([c for c, _ in picked]), "score": np.concatenate([s for _, s in picked])})

    return run


def nearest(vectors: DataFrame, is_query: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            trees: int = 24, recall: float = 0.95, shard_rows: int = 8192, query_block: int = 1024,
            sample_rows: int = 8192, sample_queries: int = 128, least: int = 2048, seed: int = 7) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` rows of largest inner product found for every row that
    satisfies the SQL condition ``is_query``, its own id excluded; ties go to the smaller id.

    Vectors that are null, empty, zero or hold null, NaN or infinite components take no part, nor do
    those of another length than the commonest one (of equally common, the longer); rows with a null
    id take no part. Equal vectors are one indexed row that stands for its k + 1 smallest ids - no
    query can need more - so a vector that a third of the rows hold is searched once. A repeated id
    counts once. An empty table gives none. Other columns are not read.

    Every distinct vector is indexed. Only the sample (``sample_rows``, at most 64 MB, smallest
    hashes of the ids) reaches the driver; ``least`` candidates are examined per shard in any case,
    so small tables are searched in full."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.expr(is_query).alias("asks"))
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))))
    shape = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).orderBy(F.desc("n"), F.desc("dim")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if shape is None:
        return empty
    rows = rows.filter(F.size("v") == shape["dim"])
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    classes = cut(rows.select("v", "id").distinct().withColumn("at", first).filter(F.col("at") <= k + 1)
                  .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                  .select(F.get("ids", F.lit(0)).alias("c"), "v", "ids"))
    asking = cut(rows.filter("asks").select(F.col("id").alias("query_id"), "v").distinct()
                 .join(classes.select("v", "c"), "v").select("query_id", "c"))
    bound = max(k + 2, min(sample_rows, (64 << 20) // (8 * shape["dim"])))
    sample = classes.orderBy(F.xxhash64("c"), "c").limit(bound).select("v").collect()
    forest, share = fitted(np.array([r["v"] for r in sample]), trees, seed, shape["norm"], k, recall, sample_queries, least)
    forest.x = forest.order = forest.sorted = None  # the hash functions alone travel
    n, asks = classes.count(), asking.select("c").distinct()
    shards, blocks = -(-n // shard_rows), -(-max(1, asks.count()) // query_block)
    spread = lambda what, parts: F.pmod(F.xxhash64("c", F.lit(what)), F.lit(parts)).cast("int")
    sharded = (classes.select("c", "v", spread("row", shards).alias("shard"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    queries = (classes.join(asks, "c", "left_semi")
               .select(F.col("c").alias("q"), F.col("v").alias("qv"), spread("query", blocks).alias("qblock"))
               .withColumn("qshard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    cells = (sharded.groupBy("shard", "block").cogroup(queries.groupBy("qshard", "qblock"))
             .applyInPandas(_search_cell(forest, k + 1, share, least), "q long, c long, score double"))
    top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))
    best = cells.withColumn("at", top).filter(F.col("at") <= k + 1).drop("at")
    near = (best.join(classes.select("c", "ids"), "c")
            .select("q", F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("id"))).alias("found"))
            .groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found")))
    own = (asking.join(near, asking["c"] == near["q"])
           .select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("at", "x")))
    return own.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("id"), (-F.col("x.far")).alias("score"))
