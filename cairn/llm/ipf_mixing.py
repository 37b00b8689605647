"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) with their tokens. Raking multiplies the tokens to
keep of the cells until source, language and topic shares all meet their targets; a document is then
sampled with its cell's kept share as probability, by a hash of its id."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cairn.llm.common import bounded_batches, cut, free_name

TOPICS = 8
DIMENSIONS = ("source", "lang", "topic")
CELLS_A_TASK = 200_000  # up to so many cells are raked in one task
_LONG = 7  # letters from which a word says what a text is about


def topic_and_tokens(raw: bytes, topics: int = TOPICS) -> tuple[str, int]:
    """(topic, tokens) of a whole text: tokens are its white-space words; the topic is the hashed
    vocabulary group with the most of its long words, or of all words if none is long (ties and texts
    without words: the smallest)."""
    tokens, tally, at = 0, np.zeros((2, topics), np.int64), 0
    while at < len(raw):
        end = min(len(raw), at + (1 << 21))
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = raw[at:end].lower().split()
        at = end
        tokens += len(words)
        groups = np.fromiter(map(crc32, words), np.int64, len(words)) % topics
        long = np.fromiter(map(len, words), np.int64, len(words)) >= _LONG
        tally[0] += np.bincount(groups[long], minlength=topics)
        tally[1] += np.bincount(groups, minlength=topics)
    return f"t{int(tally[0 if tally[0].any() else 1].argmax())}", tokens


def _topics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        got = [topic_and_tokens(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        yield pa.StructArray.from_arrays([pa.array([a for a, _ in got], pa.string()), pa.array([b for _, b in got], pa.int64())], ["topic", "tokens"])


def flattened_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares ``(dimension, target)``: the present shares to a power below 1 (their scale is
    settled in ``rake``), which moves weight from large to small sources, languages and topics."""
    return cells.groupBy(dimension).agg(F.sum("tokens").alias("n")).select(dimension, F.pow("n", F.lit(power)).alias("target"))


def _together(cells: DataFrame, count: int) -> DataFrame:
    """Up to ``CELLS_A_TASK`` cells in one partition, in which sums and joins need no shuffle."""
    return cells.coalesce(1) if count <= CELLS_A_TASK else cells


def _raked(dimensions: list[str], budget: float, sweeps: int, tolerance: float):
    """The sweeps over all cells of one partition; ``__aim_...`` is the target of a cell's value."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [pdf for pdf in batches if len(pdf)]
        if not got:
            return
        pdf = pd.concat(got).sort_values(dimensions, ignore_index=True)  # any layout gives the same sums
        tokens, weight = pdf["tokens"].to_numpy(float), pdf["weight"].to_numpy(float)
        marks = []
        for d in dimensions:
            _, first, code = np.unique(pdf[d].to_numpy(str), return_index=True, return_inverse=True)
            marks.append((code, pdf[f"__aim_{d}"].to_numpy(float)[first]))
        for _ in range(sweeps):
            old = weight
            for code, aim in marks:
                own = np.bincount(code, weight)
                factor = np.divide(aim, own, out=np.zeros(len(aim)), where=own > 0)
                weight = np.minimum(weight * factor[code], tokens)
            if (np.abs(weight - old) <= tolerance * tokens).all():
                break
        yield pdf.assign(weight=weight, old=old)

    return run


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep_share: float, sweeps: int = 1000, tolerance: float = 1e-6) -> DataFrame:
    """``cells(*dimensions, tokens)`` with ``weight``, the tokens to keep of each cell: its marginal
    shares meet the targets, and no cell gives more than it has.

    Starts from ``keep_share`` of every cell; each sweep scales one dimension after the other to its
    targets (shares of all tokens to keep) and trims what exceeds a cell's tokens. It ends when a sweep
    changes no cell's kept share by more than ``tolerance``, or after ``sweeps``; targets that are then
    missed (trimmed cells cannot meet them) and an end by ``sweeps`` are warned of. A value without a
    target keeps its present share. Up to ``CELLS_A_TASK`` cells are raked in one task, as jobs of many
    tasks a sweep would fill the driver; beyond, sums are combined before each shuffle, so a source with
    a third of the cells is no hot group, and the joins are merge joins (split when skewed)."""
    total, count = cells.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    budget = float(total) * keep_share
    cells = _together(cells, count)
    now = cells.withColumn("weight", F.col("tokens") * F.lit(keep_share))
    aims = {}
    for d, given in targets.items():
        share = given.select(d, "target").join(now.groupBy(d).agg((F.sum("tokens") / F.lit(float(total))).alias("own")), d, "right")
        known = share.agg(F.sum("target"), F.sum(F.when(F.col("target").isNotNull(), F.col("own")))).first()
        scaled = F.col("target") / F.lit(known[0] or 1.0) * F.lit(known[1] or 0.0)
        aims[d] = _together(cut(share.select(d, (F.coalesce(scaled, "own") * F.lit(budget)).alias("target"))), count)
    if count <= CELLS_A_TASK:
        for d, aim in aims.items():
            now = now.join(aim.withColumnRenamed("target", f"__aim_{d}").hint("merge"), d)
        schema = StructType([*now.schema.fields, StructField("old", DoubleType())])
        now = cut(now.coalesce(1).mapInPandas(_raked(list(aims), budget, sweeps, tolerance), schema).drop(*[f"__aim_{d}" for d in aims]))
        moved = now.agg(F.max(_moved())).first()[0]
    else:
        for _ in range(sweeps):
            now = now.withColumn("old", F.col("weight"))
            for d, aim in aims.items():
                factor = (now.groupBy(d).agg(F.sum("weight").alias("own")).join(aim.hint("merge"), d)
                          .select(d, F.when(F.col("own") > 0, F.col("target") / F.col("own")).otherwise(0.0).alias("factor")))
                now = (now.join(factor.hint("merge"), d).withColumn("weight", F.least(F.col("weight") * F.col("factor"), F.col("tokens").cast("double")))
                       .drop("factor"))
            now = cut(now)
            moved = now.agg(F.max(_moved())).first()[0]
            if moved <= tolerance:
                break
    missed = []
    for d, aim in aims.items():
        gap = F.abs(F.col("own") - F.col("target")) / F.lit(budget)
        off = (now.groupBy(d).agg(F.sum("weight").alias("own")).join(aim.hint("merge"), d)
               .agg(F.count_if(gap > 10 * tolerance), F.max_by(d, gap), F.max(gap))).first()
        if off[0]:
            missed.append(f"{off[0]} of {d} (most: {off[1]!r} by {off[2]:.2g} of all tokens to keep)")
    if missed or moved > tolerance:
        warnings.warn(f"raking {'ended' if moved <= tolerance else f'stopped after {sweeps} sweeps, the last of which still changed a kept share by {moved:.2g},'}"
                      f" with targets missed: {', '.join(missed) or 'none'}", stacklevel=2)
    return now.drop("old")


def _moved() -> Column:
    """By how much the last sweep changed a cell's kept share."""
    return F.abs(F.col("weight") - F.col("old")) / F.greatest("tokens", F.lit(1))


def calibrated_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", power: float = 0.9, keep_share: float = 0.8,
                      topic_col: str | None = None, targets: dict[str, DataFrame] | None = None, seed: int = 17,
                      probability: str = "p_keep") -> DataFrame:
    """The sampled rows of ``docs`` with their probability ``p_keep``.

    ``docs`` has columns source and lang (null: a value of its own); the topic is ``topic_col`` or the
    text's hashed vocabulary group. ``targets`` default to the present shares to the power ``power``. About
    ``keep_share`` of all tokens is kept; a cell's probability is its raked share of its own tokens, at
    most 1. A document is kept if the hash of its
    id lies below its probability: copies of a row share their fate, any layout gives the same sample.
    Documents without tokens weigh nothing and are left out; a null id hashes like a value. Extra
    columns pass; a clashing output name gets a leading underscore. An empty table gives none."""
    bounded_batches(docs.sparkSession)
    mark, prob = free_name(docs, "__mix", probability)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\u0000null"))
    stamped = docs.withColumn(mark, F.arrow_udf(_topics, "struct<topic string, tokens long>")(F.col(text_col)))
    topic = value(topic_col) if topic_col else F.col(mark)["topic"]
    stamped = stamped.withColumn(mark, F.struct(value("source").alias("source"), value("lang").alias("lang"), topic.alias("topic"), F.col(mark)["tokens"].alias("tokens")))
    cells = cut(stamped.select(f"{mark}.*").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"))
    cells = _together(cells, cells.count())
    raked = rake(cells, targets or {d: flattened_targets(cells, d, power) for d in DIMENSIONS}, keep_share)
    rates = raked.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], (F.col("weight") / F.col("tokens")).alias(prob))
    same = [F.col(mark)[d] == F.col(f"__{d}") for d in DIMENSIONS]
    u = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) / F.lit(float(1 << 53))
    return (stamped.filter(F.col(mark)["tokens"] > 0).join(rates, same).filter(u < F.col(prob))
            .drop(mark, *[f"__{d}" for d in DIMENSIONS]))
