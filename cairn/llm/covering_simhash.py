"""SimHash near-dedup by covering locality-sensitive hashing.

Bit i of a 64-bit fingerprint gets a non-zero vector m(i) of radius + 1 bits; the mask of a
non-zero vector v keeps the bits with <m(i), v> odd. Two fingerprints that differ in at most
``radius`` bits differ in positions whose vectors span at most ``radius`` dimensions, so some v is
orthogonal to all of them and its mask hides every difference: each such pair agrees in at least one
of the 2^(radius+1) - 1 tables, without exception."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, broadcast_if_small, components, cut, free_name

BUCKET_CAP = 4096  # larger buckets go through a second level of masks; none is cut short
_CHUNK = 1 << 16


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions; every pair within ``radius`` of each other there
    agrees under at least one of them."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i % n for i in range(len(positions))]
    return [sum(1 << p for p, m in zip(positions, vectors) if bin(m & v).count("1") & 1)
            for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def text_simhash(raw: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the XXH64 (seed 42) of the word shingles of a lower-cased text."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()  # bytes: A-Z only; splits at 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1:].tolist()
    total = len(starts)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        h = np.array([xxh64_intdigest(joined[s:e], 42)
                      for s, e in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])], dtype="<u8")
        octets = h.view(np.uint8).reshape(-1, 8)
        if len(h) < 256:
            counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:  # how often each byte value stands in each of the 8 places
            seen = np.bincount((octets + (np.arange(8, dtype=np.uint16) << 8)).ravel(), minlength=2048).reshape(8, 256)
            bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
            counts += (seen @ bits).ravel()
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def simhash_column(text_col: str, shingle: int):
    """An Arrow function: text -> signed long with the fingerprint's bits (null text: 0)."""

    @F.arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw = texts.cast(pa.binary()).to_pylist()
            yield pa.array([_signed(text_simhash(x or b"", shingle)) for x in raw], pa.int64())

    return fingerprints(F.col(text_col))


def linked(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph of fingerprints within ``radius`` bits (one bucket).

    Grows one component at a time: what a fingerprint reaches leaves the pool, so a dense group
    costs one pass and gives its size - 1 links, not all its pairs."""
    pool = np.sort(fps)
    left, right = [], []
    while len(pool) > 1:
        queue, pool = [int(pool[0])], pool[1:]
        while queue and len(pool):
            x = queue.pop()
            near = np.bitwise_count(pool ^ np.uint64(x)) <= radius
            if near.any():
                hit = pool[near]
                left.append(np.full(len(hit), x, np.uint64))
                right.append(hit)
                queue.extend(hit.tolist())
                pool = pool[~near]
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _link_buckets(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by bucket; a bucket may go on in the next batch
        held: list[np.ndarray] = []
        key = None

        def close():
            if held:
                a, b = linked(np.unique(np.concatenate(held)), radius)
                if len(a):
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[["t", "k", "t2", "k2"]].to_numpy(np.int64)
            fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                now = tuple(keys[lo].tolist())
                if now != key:
                    yield from close()
                    held, key = [], now
                held.append(fp[lo:hi])
        yield from close()

    return run


def fingerprint_links(fps: DataFrame, radius: int = 4, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)`` (signed longs) that span exactly the
    components of "differ in at most ``radius`` bits".

    A bucket of two is one comparison inside the aggregation. A larger one is linked as a spanning
    forest by one task; beyond ``bucket_cap`` fingerprints it is first split by covering masks over
    the bits its table hides, which keeps the guarantee and bounds a bucket by 2^(bits hidden twice)."""
    every = list(range(64))
    masks = covering_masks(every, radius)
    masked = F.array(*[F.lit(_signed(m)) for m in masks])
    tables = fps.select("fp", F.posexplode(F.transform(masked, lambda m: F.col("fp").bitwiseAND(m))).alias("t", "k"))
    buckets = cut(tables.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                  .filter("n > 1"))
    pairs = buckets.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    many = tables.join(broadcast_if_small(buckets.filter("n > 2").select("t", "k", "n")), ["t", "k"])
    small = many.filter(F.col("n") <= bucket_cap).select("t", "k", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("k2"), "fp")
    again = F.array(*[F.array(*[F.lit(_signed(x)) for x in covering_masks([p for p in every if not m >> p & 1], radius)]) for m in masks])
    large = (many.filter(F.col("n") > bucket_cap)
             .select("t", "k", "fp", F.posexplode(F.transform(F.element_at(again, F.col("t") + 1),
                                                              lambda m: F.col("fp").bitwiseAND(m))).alias("t2", "k2"))
             .select("t", "k", "t2", "k2", "fp"))
    in_buckets = small.unionAll(large).repartition("t", "k", "t2", "k2").sortWithinPartitions("t", "k", "t2", "k2")
    return pairs.unionAll(in_buckets.mapInPandas(_link_buckets(radius), "a long, b long")).distinct()


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, th, fp)`` of every row: id, hash of the text as stored, SimHash as a signed long.
    Written once, so that the texts go to Python a single time."""
    bounded_batches(docs.sparkSession)
    return cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"),
                           simhash_column(text_col, shingle).alias("fp")))


def fingerprint_components(prints: DataFrame, radius: int = 4, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """``(fp, component_id, keep_id, keep_th)`` for every distinct fingerprint of ``prints``:
    the smallest id of its component, and the row that stands for the component."""
    row = F.struct(F.col("id").isNull(), "id", "th")
    nodes = prints.groupBy("fp").agg(F.min(row).alias("first"))
    roots = components(fingerprint_links(nodes.select("fp"), radius, bucket_cap)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return (rooted.select("fp", "root").join(first, "root")
            .select("fp", F.col("first.id").alias("component_id"), F.col("first.th").alias("keep_th")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       radius: int = 4, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """``(id_col, fp, component_id)`` per row: fp a signed long with the fingerprint's bits,
    component_id the smallest id reachable over links, itself included.

    Equal fingerprints are one node, so copies never meet pairwise. Documents without words (null,
    empty, white space) have fingerprint 0 and link like any other. Repeated rows each return a row;
    a null id is a component's id only where the component has no other. Other columns of ``docs`` are
    not read, so none can clash. An empty table gives an empty result."""
    prints = document_fingerprints(docs, id_col, text_col, shingle)
    of_fp = fingerprint_components(prints, radius, bucket_cap)
    return prints.join(of_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                      radius: int = 4, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with the smallest id (non-null ids
    first; of rows with the same id the smallest text hash; of equal rows one). Columns unchanged."""
    prints = document_fingerprints(docs, id_col, text_col, shingle)
    keep = fingerprint_components(prints, radius, bucket_cap).select(
        F.col("component_id").alias("__id"), F.col("keep_th").alias("__th")).distinct()
    (th,) = free_name(docs, "__text_hash")
    stamped = docs.withColumn(th, F.xxhash64(F.col(text_col)))
    kept = stamped.join(keep, stamped[id_col].eqNullSafe(keep["__id"]) & (stamped[th] == keep["__th"]), "left_semi")
    return kept.dropDuplicates([id_col, th]).drop(th)
