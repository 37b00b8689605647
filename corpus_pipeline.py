"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, decontamination, mixing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all documents the one before kept;
``run`` writes every stage's result as Parquet in the shared checkpoint folder and reads it again.

Every stage reads the columns of ``documents`` only and returns them (the last one adds its own), so
further columns cannot clash and do not pass. An empty table stays empty. Texts are read whole. Null
values of doc_id, lang, source and n_chars pass unless a stage says otherwise."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.bigru_langid import UND, fit, identify
from cairn.llm.common import checkpoint_folder, free_name, table
from cairn.llm.covering_simhash import one_per_component
from cairn.llm.fuzzy_lines import dedup_lines
from cairn.llm.ipf_mixing import calibrated_sample
from cairn.llm.winnowing import benchmark_hits

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts that are null or without a letter go, all others stay.
    A missing label is filled with the prediction of a network learned from the labelled documents; a
    given one stays, and without any label the column stays null. Repeated rows all stay."""
    known = docs.select(*COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    named = identify(known, fit(known))
    return named.withColumn("lang", F.coalesce("lang", F.nullif("lang_pred", F.lit(UND)))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that occur, equally or nearly so, elsewhere before; documents of which
    nothing but white space is left go. Of equal or linked lines the occurrence of the smallest (doc_id,
    text hash, position) stays, null ids last; rows repeated in id and text keep the same lines. A null
    text stays null; n_chars is counted anew where lines went."""
    cleaned = dedup_lines(docs.select(*COLUMNS))
    left = cleaned.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group within 4 bits (shingles of 4 words): the one with the smallest id, null
    ids last, of rows equal in id and text one. Null and word-less texts are one group."""
    return one_per_component(docs.select(*COLUMNS), shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of 10 benchmark words. Null and word-less texts stay, repeated rows go
    or stay together."""
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), window=10, k=5).filter("n_hit > 0").select("id", F.col("th").alias("hit"))
    (th,) = free_name(docs, "__text_hash")
    stamped = docs.select(*COLUMNS).withColumn(th, F.xxhash64("text"))
    return stamped.join(found.distinct(), stamped["doc_id"].eqNullSafe(found["id"]) & (stamped[th] == found["hit"]), "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic shares meet their targets, with its probabilities. Null
    sources and languages are categories of their own; rows equal in id and text stay or go together."""
    return calibrated_sample(docs.select(*COLUMNS))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("decontaminate", decontaminate), ("mix_sources", mix_sources)]

# The learned language stage has no SQL form; tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
