"""Exact order statistics by bucket refinement, and exact top-k counts by bounded candidates. Neither
sorts or shuffles its input: rows are counted in buckets inside each task, and only bucket counts move."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = 1024          # buckets an interval is cut into per round
COUNT_BUCKETS = 1 << 16  # hash buckets of the candidate counts: at most this many rows leave a task


def _bucket(v: Column, a: float, b: float) -> Column:
    """A bucket number that never decreases with v, for values within [a, b] that differ at the ends: by
    kind where the interval holds infinities or both signs, by logarithm where it spans magnitudes, in
    equal widths otherwise."""
    if math.isinf(a) or math.isinf(b) or (a < 0 < b):
        inf = float("inf")
        return F.when(v == -inf, 0).when(v < 0, 1).when(v == 0, 2).when(v < inf, 3).otherwise(4)
    if a > 0 and b / a > SPLITS:
        place = (F.log(v) - math.log(a)) / (math.log(b) - math.log(a))
    elif b < 0 and a / b > SPLITS:
        place = (math.log(-a) - F.log(-v)) / (math.log(-a) - math.log(-b))
    else:
        place = (v - F.lit(a)) / F.lit(b - a)
    inner = F.least(F.greatest(F.floor(place * (SPLITS - 2)), F.lit(0)), F.lit(SPLITS - 3)).cast("int") + 1
    return F.when(v == a, 0).when(v == b, SPLITS - 1).otherwise(inner)  # both ends on their own: every round narrows


def order_statistics(df: DataFrame, ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """{(column, rank): value} of 0-based ranks among the column's non-null doubles, NaN above all.

    A round counts, for every interval that still holds a wanted rank, its values by bucket, with each
    bucket's smallest and largest value; the bucket that holds the rank is the next interval. At most
    (wanted ranks) x ``SPLITS`` counts reach the driver a round, and a dozen rounds separate any doubles.
    Give it stored rows: each round reads them once."""
    out: dict[tuple[str, int], float] = {}
    first = df.agg(*[x for c in ranks for x in (F.count(F.when(~F.isnan(c), F.col(c))).alias(f"n_{c}"), F.min(F.when(~F.isnan(c), F.col(c))).alias(f"a_{c}"),
                                                F.max(F.when(~F.isnan(c), F.col(c))).alias(f"b_{c}"))]).first()
    cells: dict[tuple[str, float, float, int], list[int]] = {}  # (column, from, to, values below) -> ranks
    for c, rs in ranks.items():
        for r in rs:
            if r >= first[f"n_{c}"]:
                out[c, r] = float("nan")
            else:
                cells.setdefault((c, first[f"a_{c}"], first[f"b_{c}"], 0), []).append(r)
    while True:
        for key in [k for k in cells if k[1] == k[2]]:
            out.update({(key[0], r): key[1] for r in cells.pop(key)})
        if not cells:
            return out
        todo = list(cells)
        entries = []
        for i, (c, a, b, _) in enumerate(todo):
            v = F.col(c)
            entries.append(F.when((v >= a) & (v <= b) & ~F.isnan(v), F.struct(F.lit(i).alias("cell"), _bucket(v, a, b).alias("bucket"), v.alias("v"))))
        counted = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.cell", "e.bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min("e.v").alias("a"), F.max("e.v").alias("b"))
        found: dict[int, list] = {}
        for r in counted.collect():  # bounded: see above
            found.setdefault(r["cell"], []).append((r["bucket"], r["n"], r["a"], r["b"]))
        new: dict[tuple[str, float, float, int], list[int]] = {}
        for i, key in enumerate(todo):
            below, wanted = key[3], sorted(cells[key])
            for _, n, a, b in sorted(found[i]):
                here = [r for r in wanted if below <= r < below + n]
                if here:
                    new.setdefault((key[0], a, b, below), []).extend(here)
                below += n
        cells = new


def top_counts(df: DataFrame, key: str, n: int, buckets: int = COUNT_BUCKETS) -> DataFrame:
    """The n most frequent non-null values of ``key`` with their counts (``key``, ``count``; equal counts
    by ascending value), exactly, shuffling candidates only.

    Rows are counted by hash bucket: a bucket's count bounds the count of every value in it. The values of
    the fullest buckets are counted exactly, and the n-th of them is a bound from below: a value of the
    result lies in a bucket of at least that count. Only those buckets are counted by value. Where all
    values are alike this is every bucket, that is, the full count. Two jobs run while the plan is built;
    the lists that are broadcast hold at most ``buckets`` numbers."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key), F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_b"))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    order = (F.col("count").desc(), F.col(key))

    def best(kept: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(kept.select("_b")), "_b", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(*order).limit(n)

    fullest = df.sparkSession.createDataFrame(sizes.orderBy(F.desc("_n"), "_b").limit(4 * n).select("_b").collect(), "_b long")
    bound = [r["count"] for r in best(fullest).collect()]
    least = bound[-1] if len(bound) == n else 0
    return best(sizes.where(F.col("_n") >= least))
