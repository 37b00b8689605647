"""Ranked lexical search by bag deduplication.

A document's score depends only on how often it holds each term of the items and on its length factor
m, so documents are restricted to the items' vocabulary, equal vectors with equal m become one class
(grouped by a hash and by the vector itself, which verifies the hash), each class is scored once
against all items, and its members take part by ascending id.

A text is read once: what is stored of it is its term count and its (term, frequency) vector. Every
task sees the vocabulary as a bitmap of fixed size; the few foreign terms that slip through make a
class finer and add nothing to a score. Items are sent to the stored classes in blocks of a bounded
number of terms, so neither side grows in a task, and no class moves more than once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import bounded_batches, cut

SLOTS = 1 << 23        # bits of the vocabulary's bitmap, 1 MB
ITEM_TERMS = 1 << 14   # (item, term) pairs of a block of items, on average
PRODUCTS = 1 << 21     # (posting, item) products held at a time
SLICE = 1 << 23        # bytes of a text whose terms are held at a time
K1000, B100, SCALE = 8, 75, 1_000_000_000  # fixed values: the formula's constants
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def count_terms(raw: bytes) -> Counter:
    """Terms of a text (digits, letters and non-ASCII, A-Z lower-cased) with their frequencies; a long
    text is cut between terms."""
    out: Counter = Counter()
    at = 0
    while at < len(raw):
        end = at + SLICE
        while end < len(raw) and _BYTES[raw[end]] != 32:
            end += 1
        out.update(raw[at:end].translate(_BYTES).split())
        at = end
    return out


def _slot(term: bytes) -> int:
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(term, 12) & (SLOTS - 1)


def _vectors(bitmap: bytes | None):
    """Rows (id, text) -> (id, n, terms in order, their frequencies), with terms of the bitmap only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}

        def wanted(term: bytes) -> bool:
            got = known.get(term)
            if got is None:
                if len(known) > 500_000:
                    known.clear()
                s = _slot(term)
                got = known[term] = bitmap is None or bool(bitmap[s >> 3] >> (s & 7) & 1)
            return got

        for b in batches:
            n, offsets, terms, tfs = [], [0], [], []
            for raw in b.column(1).cast(pa.binary()).to_pylist():
                found = count_terms(raw or b"")
                n.append(found.total())
                kept = sorted(filter(wanted, found))
                terms += kept
                tfs += map(found.__getitem__, kept)
                offsets.append(len(terms))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string())),
                                              pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], names=["id", "n", "terms", "tfs"])

    return run


def term_vectors(rows: DataFrame, id_col: str, text_col: str, bitmap: bytes | None = None) -> DataFrame:
    ids = T.StructField("id", rows.schema[id_col].dataType)
    schema = T.StructType([ids, T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tfs", T.ArrayType(T.LongType()))])
    return rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_vectors(bitmap), schema)


def vocabulary_bitmap(items: DataFrame) -> bytes:
    """A bitmap of the terms of stored item vectors; at most SLOTS numbers come to the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {_slot(t.encode()) for t in b.column(0).flatten().unique().to_pylist()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["slot"])

    bits = np.zeros(SLOTS, np.uint8)
    for r in items.select("terms").mapInArrow(slots, "slot long").distinct().toLocalIterator():
        bits[r[0]] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def classes_of(vectors: DataFrame, total_docs: int, total_terms: int, k: int) -> DataFrame:
    """Classes (m, terms, tfs, ids) of stored vectors that hold an item term; ``ids`` are the class's k
    smallest, which is all that a ranking of k can take from it. Rows beyond k of a class are dropped
    before the shuffle, in each task."""
    m = F.expr(f"{100 - B100} + ({B100} * n * {total_docs}L) div {max(1, total_terms)}L")
    rows = vectors.filter(F.size("terms") > 0).withColumn("m", m).withColumn("h", F.xxhash64("terms", "tfs", "m"))
    same = ["h", "m", "terms", "tfs"]
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_last("id")))).filter(F.col("nth") <= k)
    return first.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("nth", "id"))).alias("ids")).select(
        "m", "terms", "tfs", F.transform("ids", lambda x: x["id"]).alias("ids"))


def _score(keys: list[int], item_ids: list, bags: list[list[tuple[str, int, int]]], k: int, id_type: pa.DataType, item_type: pa.DataType):
    """Scores of all classes of a partition for a block of items; sends each item's k best rows."""
    vocabulary = sorted({t for bag in bags for t, _, _ in bag})
    place = {t: i for i, t in enumerate(vocabulary)}
    times = np.zeros((len(vocabulary), len(bags)), np.int64)
    weight = np.zeros(len(vocabulary), np.int64)
    for j, bag in enumerate(bags):
        for t, c, w in bag:
            times[place[t], j] = c
            weight[place[t]] = w
    step = max(1, PRODUCTS // max(1, len(bags)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in bags]           # (-score, whether the id is null, id)
        bar = np.ones(len(bags), np.int64)               # an item's k-th best score so far, 1 at least
        values = pa.array(vocabulary, pa.string())

        def take(rows: np.ndarray, scores: np.ndarray, ids: list) -> None:
            nonlocal bar
            if len(rows) > k:
                need = np.maximum(bar, np.partition(scores, len(rows) - k, axis=0)[len(rows) - k])
            else:
                need = bar
            hit, item = np.nonzero(scores >= need)
            for r, j, s in zip(rows[hit].tolist(), item.tolist(), scores[hit, item].tolist()):
                best[j] += [(-s, i is None, i) for i in ids[r]]
            for j in np.unique(item).tolist():
                best[j].sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
                del best[j][k:]
                if len(best[j]) == k:
                    bar[j] = max(1, -best[j][-1][0])

        for b in batches:
            terms, tfs = b.column(1), b.column(2)
            sizes = np.diff(terms.offsets.to_numpy())
            at = pc.index_in(terms.flatten(), value_set=values)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), sizes)[known]
            if not len(row):
                continue
            term = at.drop_null().to_numpy().astype(np.int64)
            tf = tfs.flatten().to_numpy(zero_copy_only=False)[known]
            m = b.column(0).to_numpy()[row]
            part = weight[term] * ((SCALE * tf) // (1000 * tf + K1000 * m))
            ids = b.column(3).to_pylist()
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            lo = 0
            while lo < len(starts):  # whole rows, as many as their postings allow, one at least
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + step, side="right")) - 1)
                end = starts[hi] if hi < len(starts) else len(row)
                if hi == len(starts) - 1 and len(row) - starts[lo] <= step:
                    hi, end = len(starts), len(row)
                # one row of more terms than fit is summed piece by piece
                total = np.zeros((hi - lo, len(bags)), np.int64)
                for p in range(starts[lo], end, step):
                    q = min(p + step, end)
                    first = np.concatenate(([p], starts[lo:hi][(starts[lo:hi] > p) & (starts[lo:hi] < q)]))
                    total[np.searchsorted(starts[lo:hi], first, side="right") - 1] += np.add.reduceat(part[p:q, None] * times[term[p:q]], first - p, axis=0)
                take(row[starts[lo:hi]], total, ids)
                lo = hi
        rows = [(keys[j], item_ids[j], -s, i) for j, found in enumerate(best) for s, _, i in found]
        if rows:
            key, item, score, i = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(item, item_type), pa.array(score, pa.int64()), pa.array(i, id_type)],
                                             names=["key", "item_id", "score", "doc_id"])

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of the highest scores above 0, equal scores
    by ascending id, ranks from 1.

    All counts are taken over all documents and whole texts. A null or empty text has no term and is
    found by no item, but a null id is an id like any other, behind all others. Rows repeated with id
    and text count, and are listed, each. Items repeated in full are one item; different texts under
    one item id are ranked separately. An empty table on either side gives an empty result. Only ids
    and texts are read, so further columns cannot clash."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    bounded_batches(spark)
    asked = cut(term_vectors(items, item_col, item_text).filter(F.size("terms") > 0).distinct())
    vectors = cut(term_vectors(docs, id_col, text_col, vocabulary_bitmap(asked)))
    total_docs, total_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = cut(classes_of(vectors, total_docs, total_terms, k))
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * total_docs + 2)) / (2 * F.col("df") + 1)))
    bags = asked.select("id", "terms", "tfs", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).join(df, F.col("x.terms") == F.col("term"))
    bags = cut(bags.groupBy("id", "terms", "tfs").agg(F.collect_list(F.struct("term", F.col("x.tfs").alias("c"), weight.alias("w"))).alias("bag")).select("id", "bag"))
    pairs = bags.agg(F.sum(F.size("bag"))).first()[0] or 0
    blocks = max(1, -(-pairs // ITEM_TERMS))
    id_type, item_type = to_arrow_type(docs.schema[id_col].dataType), to_arrow_type(items.schema[item_col].dataType)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("item_id", items.schema[item_col].dataType),
                           T.StructField("score", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType)])
    found = spark.createDataFrame([], schema)
    for n in range(blocks):
        block = bags.filter(F.pmod(F.xxhash64("id", "bag"), F.lit(blocks)) == n).collect()
        if block:
            keys = [n << 32 | j for j in range(len(block))]
            got = classes.mapInArrow(_score(keys, [r["id"] for r in block], [[(x["term"], x["c"], x["w"]) for x in r["bag"]] for r in block], k, id_type, item_type), schema)
            found = found.unionAll(got)
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
