"""Exact dedup by block naming against a dictionary of whole texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cairn.llm import block_naming

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (4, "oNE"), (4, "one"), (None, "null id"), (None, "null id"), (7, "null id"), (5, "É É"), (6, "é É"),
       (8, "word " * 30000), (9, "word " * 30000), (10, "word " * 30000 + "x"), (11, "a" * 1024), (12, "a" * 1025), (13, "a" * 2048), (14, "A" * 2048)]


def expected(rows):
    groups = {}
    for i, t in rows:
        norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(norm, []).append(i)
    out = []
    for norm, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep, sha, free = max(named) if named else None, hashlib.sha256(norm.encode()).hexdigest(), True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and free, sha))
            free = free and i != keep
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0, 1) for i, t in rows], "doc_id long, text string, SHA string, name int, keep_id int").repartition(3)


@pytest.mark.parametrize("block", [1024, 3])
def test_odd_rows(spark, block):
    rows = [(i, t) for i, t in ODD if block > 3 or len(t or "") < 1000]
    df = block_naming.exact_groups(frame(spark, rows), block=block)
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(df) == expected(rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts_of_few_letters(spark, seed):
    """Few letters and tiny blocks: shared prefixes, suffixes and pairs at every level."""
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("abAé") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17])))) for i in range(400)]
    rows += [(1000 + i, "abcd" * 5 + rng.choice(["", "x"])) for i in range(400)]  # two groups of a quarter of the rows each
    assert got(block_naming.exact_groups(frame(spark, rows), block=2)) == expected(rows)


def test_blocks_of_one_hash_are_told_apart(spark, monkeypatch):
    """With a hash that is the same for all blocks the cut is found to be out of order and made anew."""
    seeds = []

    def lead(block, seed, real=block_naming._lead):
        seeds.append(seed)
        return F.lit(7).cast("long") if seed == 0 else real(block, seed)

    monkeypatch.setattr(block_naming, "_lead", lead)
    rows = [(i, f"text {i % 37}") for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several slices even here
    try:
        assert got(block_naming.exact_groups(frame(spark, rows))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert seeds == [0, 1]


def test_empty_table(spark):
    assert got(block_naming.exact_groups(frame(spark, [(1, "a")]).filter("false"))) == []


def test_names_are_dense(spark):
    names = [tuple(r) for r in block_naming.identities(frame(spark, [(i, f"t{i % 10}") for i in range(200)])).select("level", "name").distinct().collect()]
    assert sorted(names) == [(0, n) for n in range(10)]
