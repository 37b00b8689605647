"""Quality classifier: a second-order factorisation machine.

Features of a document: its hashed words (counts scaled to unit length), statistics of its structure
and its length column, each cut into ranges of equal frequency with one indicator a range. A score is
w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, with the pairs in linear time from the identity
1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2), through a logistic link. Trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, free_name

BUCKETS = 4096   # hashed words
RANGES = 12      # per statistic
FACTORS = 6
_SLICE = 200_000  # words of a text held as objects at a time
_SPACES = b" \t\n\r\x0b\x0c"


def _class_table() -> np.ndarray:
    """(8, 256): letters, capitals, digits, white space, line ends, sentence marks, other signs, non-ASCII bytes."""
    t = np.zeros((8, 256))
    for b in range(256):
        ch = chr(b)
        if b >= 128:
            t[7, b] = 1
        elif ch.isalpha():
            t[0, b] = 1
            t[1, b] = ch.isupper()
        elif ch.isdigit():
            t[2, b] = 1
        elif ch in " \t\n\r\x0b\x0c":
            t[3, b] = 1
            t[4, b] = ch == "\n"
        elif ch in ".,;:'-":
            t[5, b] = 1
        else:
            t[6, b] = 1
    return t


_CLASSES = _class_table()
N_STATS = 15


def raw_features(text: str | None, length: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their unit-length weights, statistics) of one whole text."""
    raw = text.encode("utf-8") if text else b""
    counts = np.zeros(0, np.int64)
    buckets = np.zeros(0, np.int64)
    n_words = same = 0
    runs: list[np.ndarray] = []
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _SLICE * 8)
        while end < len(raw) and raw[end] not in _SPACES:
            end += 1
        words = raw[at:end].lower().split()
        at = end
        if words:
            runs.append(np.fromiter(map(crc32, words), np.uint32, len(words)))
    if runs:
        h = np.concatenate(runs)
        n_words = len(h)
        same = int((h[1:] == h[:-1]).sum())
        distinct, counts = np.unique(h, return_counts=True)
        tally = np.bincount(distinct % BUCKETS, counts, BUCKETS)
        buckets = np.flatnonzero(tally)
        weights = np.sqrt(tally[buckets])
        weights /= np.sqrt((weights * weights).sum())
    else:
        weights = np.zeros(0)
    b = _CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    letters = max(1.0, b[0] + b[7])
    w = max(1, n_words)
    lines = raw.split(b"\n")
    full = [x for x in lines if x]
    stats = np.array([
        np.log1p(len(raw)), np.log1p(n_words), len(counts) / w, (counts.max() if len(counts) else 0) / w, same / w,
        b[1] / letters, b[2] / n, b[5] / n, b[6] / n, b[7] / n, b[3] / n, len(raw) / w, len(lines) / w,
        len(set(full)) / max(1, len(full)), -1.0 if length is None or length != length else np.log1p(max(0.0, float(length)))])
    return buckets, weights, stats


class Machine:
    """Feature numbering and parameters; plain arrays, so that it travels with the tasks."""

    def __init__(self, edges: np.ndarray, seed: int):
        self.edges = edges  # (N_STATS, RANGES - 1)
        self.size = BUCKETS + N_STATS * RANGES
        rng = np.random.default_rng(seed)
        self.w0 = 0.0
        self.w = np.zeros(self.size)
        self.v = rng.normal(0, 0.05, (self.size, FACTORS))

    def row(self, buckets: np.ndarray, weights: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices and values of the sparse feature vector."""
        cell = (self.edges < stats[:, None]).sum(axis=1) + np.arange(N_STATS) * RANGES + BUCKETS
        return np.concatenate([buckets, cell]), np.concatenate([weights, np.full(N_STATS, N_STATS ** -0.5)])

    def margins(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the link, and sum v_if x_i, of rows that begin at ``starts`` (none is empty)."""
        vx = self.v[idx] * val[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (s * s - np.add.reduceat(vx * vx, starts, axis=0)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[idx] * val, starts) + pairs, s

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        idx = np.concatenate([i for i, _ in rows])
        val = np.concatenate([x for _, x in rows])
        starts = np.concatenate(([0], np.cumsum([len(i) for i, _ in rows])[:-1]))
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(idx, val, starts)[0], -30, 30)))

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, updates: int, batch: int, rate: float,
              decay: float, seed: int) -> None:
        """Adam on the log-loss over shuffled batches, both labels weighing the same in all."""
        rng = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1.0 - y.mean()))
        m = [np.zeros(self.size), np.zeros_like(self.v), 0.0]
        u = [np.zeros(self.size), np.zeros_like(self.v), 0.0]
        step = 0
        while step < updates:
            order = rng.permutation(len(y))
            for lo in range(0, len(y), batch):
                pick = order[lo:lo + batch]
                part = [rows[i] for i in pick]
                sizes = np.array([len(i) for i, _ in part])
                idx, val = np.concatenate([i for i, _ in part]), np.concatenate([x for _, x in part])
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                margin, s = self.margins(idx, val, starts)
                g = (1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - y[pick]) * weight[pick] / len(pick)
                gx = np.repeat(g, sizes) * val
                gw = np.bincount(idx, gx, self.size) + decay * self.w
                inner = gx[:, None] * (np.repeat(s, sizes, axis=0) - self.v[idx] * val[:, None])
                gv = np.column_stack([np.bincount(idx, inner[:, f], self.size) for f in range(FACTORS)]) + decay * self.v
                step += 1
                for k, grad in enumerate((gw, gv, float(g.sum()))):
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    u[k] = 0.999 * u[k] + 0.001 * grad * grad
                    move = rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(u[k] / (1 - 0.999 ** step)) + 1e-8)
                    if k == 0:
                        self.w -= move
                    elif k == 1:
                        self.v -= move
                    else:
                        self.w0 -= float(move)


def _sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [raw_features(t, n) for t, n in zip(pdf["text"], pdf["length"])]
        yield pd.DataFrame({"key": pdf["key"], "quality": pdf["quality"], "b": [b.tolist() for b, _, _ in got],
                            "w": [w.tolist() for _, w, _ in got], "s": [s.tolist() for _, _, s in got]})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
        label_col: str = "quality", sample_docs: int = 4000, updates: int = 250, batch: int = 256, rate: float = 0.03,
        decay: float = 1e-5, seed: int = 5) -> Machine | float:
    """A machine trained on at most ``sample_docs`` labelled ids (those of the smallest id hashes; of an
    id's labels the largest counts). Only that many ids, a proven bound, are broadcast to find their
    texts, and only their sparse features (at most ``BUCKETS`` words each) reach the driver. Null labels
    are not learned from; with fewer than two classes the result is the constant share of label 1 (0.5
    without any label)."""
    bounded_batches(docs.sparkSession)
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("quality")).filter("id IS NOT NULL AND quality IN (0, 1)")
              .groupBy("id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_docs))
    length = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), length.alias("length"))
             .join(F.broadcast(marked), "id").dropDuplicates(["id"]).withColumn("key", F.xxhash64("id")))
    rows = sorted(texts.select("key", "quality", "text", "length").mapInPandas(
        _sampled, "key long, quality int, b array<int>, w array<double>, s array<double>").collect(), key=lambda r: r["key"])
    y = np.array([r["quality"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    stats = np.array([r["s"] for r in rows])
    machine = Machine(np.quantile(stats, np.arange(1, RANGES) / RANGES, axis=0).T, seed)
    sparse = [machine.row(np.array(r["b"], np.int64), np.array(r["w"]), np.array(r["s"])) for r in rows]
    machine.train(sparse, y, updates, batch, rate, decay, seed)
    return machine


def quality_scores(docs: DataFrame, model: Machine | float, text_col: str = "text", length_col: str | None = "n_chars",
                   score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text (null and empty texts too: they score
    by their statistics). Only text and length go to the workers, nothing is shuffled, repeated rows
    score equally; a clashing output name gets a leading underscore."""
    bounded_batches(docs.sparkSession)
    (name,) = free_name(docs, score)
    if not isinstance(model, Machine):
        return docs.withColumn(name, F.lit(float(model)))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lengths in batches:
            rows = [model.row(*raw_features(t, n)) for t, n in zip(texts.to_pylist(), lengths.to_pylist())]
            yield pa.array(model.scores(rows) if rows else [], pa.float64())

    length = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")
    return docs.withColumn(name, F.arrow_udf(run, "double")(F.col(text_col), length))
