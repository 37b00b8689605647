"""Exact dedup by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of bytes. All blocks are sorted and every
distinct one gets an integer name, its place in that order; then adjacent names are paired, the pairs
are sorted and named in the same way, and so on, until one name is left of every document. Equal names
of one level stand for equal contents and different names for different ones, so level and name are an
identity without collisions: no hash decides anything.

A sort cuts its rows into slices by range, so that a block that a third of all rows share is spread
over many tasks; every slice numbers its own distinct contents, and one small row a slice (its first
and last content, how many it has) puts the slices' numbers together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import bounded_batches, cut

BLOCK = 1024  # bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 64    # parts of a group of equal documents on its way back to the rows
_DOC = ["doc_id", "sha"]  # a document's key; rows that agree in both are copies of one row


def normalised(text: str) -> Column:
    """The text column with A-Z lower-cased and nothing else changed; null is empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def _lead(block: Column, seed: int) -> Column:
    """A short key in front of the block, so that sampled range bounds hold 16 bytes and not a block."""
    return F.xxhash64(F.lit(seed), block)


def _number(content: list[str], carried: list[str]):
    """Number the distinct contents of a sorted slice from 0, in a stream. Besides its rows (edge 0) a
    slice sends its first content (edge 1) and its last one with its number (edge 2)."""

    def edge(schema: pa.Schema, part: int, kind: int, last: tuple, at: int) -> pa.RecordBatch:
        values = dict(zip(content, last), slice=part, local=at, edge=kind)
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, schema = TaskContext.get().partitionId(), None, -1, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c) for c in content]
            new = np.zeros(b.num_rows, bool)
            for col in cols:
                new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
            front = tuple(col[0].as_py() for col in cols)
            new[0] = front != last
            local = at + np.cumsum(new)
            if schema is None:
                schema = pa.schema([b.schema.field(c) for c in carried + content] + [("slice", pa.int32()), ("local", pa.int64()), ("edge", pa.int32())])
                yield edge(schema, part, 1, front, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in carried] + [pa.nulls(b.num_rows, col.type) for col in cols]
                + [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(local), pa.array(np.zeros(b.num_rows, np.int32))], schema=schema)
            at, last = int(local[-1]), tuple(col[-1].as_py() for col in cols)
        if last is not None:
            yield edge(schema, part, 2, last, at)

    return run


def _named(rows: DataFrame, content: list[str], lead: list[str], carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``carried`` columns and an integer ``name``, where equal contents and only they share
    one; one row a slice, with ``clash`` if contents of equal lead were cut apart out of order)."""
    salt = F.xxhash64(*_DOC, "pos")
    front = lead + [c for c in content if c not in lead]
    sliced = rows.repartitionByRange(*lead, salt).sortWithinPartitions(*front, salt)
    fields = [rows.schema[c] for c in carried] + [T.StructField(c, rows.schema[c].dataType) for c in front]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                          + [T.StructField("slice", T.IntegerType()), T.StructField("local", T.LongType()), T.StructField("edge", T.IntegerType())])
    stored = cut(sliced.mapInArrow(_number(front, carried), schema))
    slices = stored.filter("edge > 0").groupBy("slice").agg(
        F.max(F.when(F.col("edge") == 1, F.struct(*front))).alias("first"), F.max(F.when(F.col("edge") == 2, F.struct(*front))).alias("last"),
        (F.max("local") + 1).alias("n"))
    w = Window.orderBy("slice")
    before = F.lag("last").over(w)
    goes_on = F.coalesce((before == F.col("first")).cast("long"), F.lit(0))
    same_lead = F.lit(True)
    for c in lead:
        same_lead = same_lead & (before[c] == F.col("first")[c])
    # one row a slice, and there are as many slices as shuffle partitions
    base = slices.select("slice", "n", goes_on.alias("on"), (F.coalesce(same_lead, F.lit(False)) & (goes_on == 0)).alias("clash")).select(
        "slice", "clash", (F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum("on").over(w)).alias("base"))
    named = stored.filter("edge = 0").join(F.broadcast(base.select("slice", "base")), "slice")
    return named.select(*carried, (F.col("base") + F.col("local")).alias("name")), base


def _first_level(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """Names of all blocks: (doc_id, sha, left, pos, name); ``left`` counts the document's names. Blocks
    are sorted by a hash and then by their bytes; in the rare case that two blocks of one hash are cut
    apart out of order, they are sorted again by another hash."""
    raw = F.encode(normalised(text_col), "UTF-8")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / block)).cast("int")
    texts = docs.select(F.col(id_col).alias("doc_id"), raw.alias("raw")).select("doc_id", F.unhex(F.sha2("raw", 256)).alias("sha"), "raw", n.alias("left"))
    cut_up = F.transform(F.sequence(F.lit(0), F.col("left") - 1), lambda i: F.substring(F.col("raw"), i * block + 1, F.lit(block)))
    blocks = texts.select(*_DOC, "left", F.posexplode(cut_up).alias("pos", "block"))
    for seed in range(5):
        named, slices = _named(blocks.withColumn("h", _lead(F.col("block"), seed)), ["block"], ["h"], [*_DOC, "left", "pos"])
        if slices.filter("clash").isEmpty():
            return named
    raise RuntimeError("no hash keeps the blocks in order")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, sha, level, name, copies): documents are equal if and only if level and name are.
    ``copies`` counts the rows that agree in id and text."""
    bounded_batches(docs.sparkSession)
    rows = _first_level(docs, id_col, text_col, block)
    none = F.lit(None).cast("long")
    done = rows.filter("pos = 0").select(*_DOC, none.alias("level"), none.alias("name"), F.lit(1).alias("copy"))
    left, level = rows.agg(F.max("left")).first()[0] or 0, 0
    while True:
        done = done.unionAll(rows.filter("left = 1").select(*_DOC, F.lit(level).cast("long"), "name", F.lit(0)))
        if left <= 1:
            break
        even = F.col("pos") % 2 == 0
        pairs = rows.filter("left > 1").groupBy(*_DOC, "left", F.expr("pos div 2").cast("int").alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = pairs.select(*_DOC, F.expr("cast((left + 1) div 2 as int)").alias("left"), F.col("at").alias("pos"), "a", "b")
        rows, _ = _named(pairs, ["a", "b"], ["a", "b"], [*_DOC, "left", "pos"])
        left, level = (left + 1) // 2, level + 1
    return done.groupBy(*_DOC).agg(F.max("level").alias("level"), F.max("name").alias("name"), F.sum("copy").alias("copies"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest id
    stays; ids are any orderable type. A null text counts as empty, and empty texts are equal to each
    other; a null id is smaller than any other. Rows repeated with id and text count each in
    ``group_size``, and one of them stays. Texts of any length are cut whole. An empty table gives an
    empty result. Only the two columns are read, so further ones cannot clash."""
    ids = cut(identities(docs, id_col, text_col, block))
    # equal documents are combined in parts first, so that no task holds a whole group
    part = F.pmod(F.xxhash64(*_DOC), F.lit(SALTS))
    parts = ids.groupBy("level", "name", part.alias("part")).agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    parts = cut(parts)
    groups = parts.groupBy("level", "name").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    spread = parts.select("level", "name", "part").join(groups, ["level", "name"])
    joined = ids.withColumn("part", part).join(spread, ["level", "name", "part"])
    each = joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return each.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))
