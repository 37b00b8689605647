"""The corpus pipeline on odd rows: each stage alone, and run() over a small table without labels."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, LANG_PRED string, n_dropped int, th long, hits string"


def prose(rng, n=60):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows(rng, lang=None):
    out = [(i, prose(rng), lang, f"s{i % 2}", None, "x", 1, 2, "y") for i in range(30)]
    out += [out[0], out[0], (31, out[1][1], lang, None, 5, "x", 1, 2, "y"), (None, prose(rng), None, None, None, None, None, None, None),
            (32, "", lang, "s0", 0, "x", 1, 2, "y"), (33, None, lang, "s0", None, "x", 1, 2, "y"), (34, "12 34 !!", lang, "s0", 8, "x", 1, 2, "y")]
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(2)
    shared = prose(rng, 20)
    spark.createDataFrame([(1, shared), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), shared


def test_unlabelled_documents_stay(spark, folder):
    got = cp.language_id(spark, frame(spark, rows(random.Random(1))), folder[0])
    assert got.columns == cp.COLUMNS
    assert got.count() == 34 and got.filter("lang IS NOT NULL").count() == 0  # all but the empty, null and letterless texts


def test_missing_labels_are_filled(spark, folder):
    got = cp.language_id(spark, frame(spark, rows(random.Random(1), "aa")), folder[0])
    assert got.count() == 34 and got.filter("lang = 'aa'").count() == 34  # the row without a label, too


def test_decontamination_and_near_duplicates(spark, folder):
    path, shared = folder
    rng = random.Random(1)
    data = rows(rng) + [(50, f"{prose(rng, 30)} {shared} {prose(rng, 5)}", None, "s0", None, "x", 1, 2, "y")]
    left = cp.decontaminate(spark, frame(spark, data), path)
    assert left.columns == cp.COLUMNS and left.count() == len(data) - 1 and left.filter("doc_id = 50").count() == 0
    kept = cp.simhash_dedup(spark, frame(spark, data), path)
    assert kept.columns == cp.COLUMNS
    assert kept.filter("doc_id = 0").count() == 1 and kept.filter("doc_id = 31").count() == 0
    assert kept.filter(F.coalesce(F.trim("text"), F.lit("")) == "").count() == 1


def test_stages_on_an_empty_table(spark, folder):
    empty = frame(spark, rows(random.Random(1))).filter("false")
    for name, stage in cp.STAGES:
        assert stage(spark, empty, folder[0]).count() == 0, name


def test_run_over_a_table_without_labels(spark, folder):
    path, shared = folder
    rng = random.Random(5)
    data = [(i, f"{prose(rng, 50)}\n{prose(rng, 12)}", None, f"s{i % 3}", None, "x", 1, 2, "y") for i in range(120)]
    data += [(900, data[3][1], None, "s0", None, "x", 1, 2, "y"), (901, f"{shared} {prose(rng, 40)}", None, "s1", None, "x", 1, 2, "y"),
             (902, None, None, "s1", None, "x", 1, 2, "y"), (903, "77 --", None, "s1", None, "x", 1, 2, "y")]
    frame(spark, data).write.parquet(f"{path}/documents.parquet")
    got = cp.run(spark, path)
    assert set(cp.COLUMNS) <= set(got.columns)
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 60 <= len(ids) <= 120 and not {900, 901, 902, 903} & set(ids)
    texts = {i: t for i, t, *_ in data}
    assert all(r["text"] == texts[r["doc_id"]] for r in got.collect())
