"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text is read as segments of bytes; in each, one gated recurrent layer runs forward and one backward,
every position gets a probability of each language from both states there, and a document's
probability is the mean over its positions that hold letters. Training is backpropagation through time
on labelled positions of a bounded sample of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, free_name

SEGMENT = 128  # bytes read from a zero state
LANES = 1024   # segments side by side
UND = "und"
_KEEP = 1e7    # gate input of the padding byte 0: the state stays as it is
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Network:
    """Light gated recurrent units (an update gate z and a candidate n, no reset gate):
    s' = z s + (1 - z) n with z, n from A [s; e(byte)], one A per direction, and a read-out W, c.

    e has ``width`` learned values per byte, a constant and a mark of the padding byte 0, which holds
    the gate open. Squashing is by softsign, s(x) = x / (1 + |x|), for the candidate and (1 + s(x)) / 2
    for the gate: several times cheaper than tanh, same range."""

    def __init__(self, labels: list[str], hidden: int, width: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden, self.width = labels, hidden, width
        f = np.float32
        self.p = {"E": rng.normal(0, 0.5, (width + 2, 256)).astype(f),
                  "A": (rng.normal(0, 0.8, (2, 2 * hidden, hidden + width + 2)) / np.sqrt(hidden)).astype(f),
                  "W": rng.normal(0, 0.3, (len(labels), 2 * hidden)).astype(f), "c": np.zeros((len(labels), 1), f)}
        self.freeze()

    def freeze(self) -> None:
        """The parts that are no parameters."""
        e, a = self.p["E"], self.p["A"]
        e[:, 0] = 0.0
        e[self.width] = 1.0
        e[self.width + 1] = 0.0
        e[self.width + 1, 0] = _KEEP
        a[:, :self.hidden, -1] = 1.0
        a[:, self.hidden:, -1] = 0.0

    def states(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """x: (L, B) bytes -> (L, 2, H, B) states in reading order: row t of the second direction
        belongs to place L - 1 - t."""
        steps, lanes = x.shape
        h, A = self.hidden, self.p["A"]
        e = np.take(self.p["E"], x, axis=1)  # (width + 2, L, B)
        out = np.empty((steps, 2, h, lanes), np.float32)
        s = np.zeros((2, h + self.width + 2, lanes), np.float32)
        a = np.empty((2, 2 * h, lanes), np.float32)
        spare = np.empty_like(a)
        state, z, n = s[:, :h], a[:, :h], a[:, h:]
        for t in range(steps):
            s[0, h:] = e[:, t]
            s[1, h:] = e[:, steps - 1 - t]
            np.matmul(A, s, out=a)
            if keep is not None:
                keep["s"].append(s.copy())
            np.abs(a, out=spare)
            spare += 1.0
            a /= spare
            z *= 0.5
            z += 0.5
            if keep is not None:
                keep["a"].append(a.copy())
            state -= n
            state *= z
            state += n
            out[t] = state
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(L, C, B) language probabilities of every place, from both directions' states there."""
        h, W = self.hidden, self.p["W"]
        logit = np.matmul(W[:, :h], states[:, 0])
        logit += np.matmul(W[:, h:], states[::-1, 1])
        logit += self.p["c"]
        logit -= logit.max(axis=1, keepdims=True)
        np.exp(logit, out=logit)
        logit /= logit.sum(axis=1, keepdims=True)
        return logit

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over the letters of a batch and its gradients (through time)."""
        steps, lanes = x.shape
        h, A, W = self.hidden, self.p["A"], self.p["W"]
        keep: dict[str, list] = {"s": [], "a": []}
        states = self.states(x, keep)
        prob = self.probabilities(states)
        mask = _LETTER[x].astype(np.float32)[:, None, :]
        total = max(1.0, float(mask.sum()))
        where = np.broadcast_to(y[None, None, :], (steps, 1, lanes))
        picked = np.take_along_axis(prob, where, axis=1)
        loss = float(-(np.log(picked + 1e-9) * mask).sum() / total)
        d = prob.copy()
        np.put_along_axis(d, where, picked - 1.0, axis=1)
        d *= mask / total
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=1)  # (L, 2H, B)
        grad["W"] = np.einsum("lcb,lhb->ch", d, both, optimize=True)
        grad["c"] = d.sum(axis=(0, 2))[:, None]
        back = np.matmul(W.T, d)  # (L, 2H, B)
        ds = np.zeros((2, h, lanes), np.float32)
        de = np.zeros((steps, self.width + 2, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            ds[0] += back[t, :h]
            ds[1] += back[steps - 1 - t, h:]
            s, z, n = keep["s"][t], keep["a"][t][:, :h], keep["a"][t][:, h:]
            da = np.concatenate([ds * (s[:, :h] - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2,  # s'(x) = (1 - |s(x)|)^2
                                 ds * (1 - z) * (1 - np.abs(n)) ** 2], axis=1)
            grad["A"] += np.matmul(da, s.transpose(0, 2, 1))
            dsum = np.matmul(A.transpose(0, 2, 1), da)
            de[t] += dsum[0, h:]
            de[steps - 1 - t] += dsum[1, h:]
            ds = ds * z + dsum[:, :h]
        flat = x.ravel()
        order = np.argsort(flat, kind="stable")
        seen, first = np.unique(flat[order], return_index=True)
        rows = de.transpose(0, 2, 1).reshape(-1, self.width + 2)[order]
        grad["E"][:, seen] = np.add.reduceat(rows, first, axis=0).T
        for part in (grad["E"][self.width:], grad["E"][:, :1], grad["A"][:, :, -1:]):
            part[...] = 0.0
        return loss, grad

    def train(self, windows: np.ndarray, y: np.ndarray, updates: int, lanes: int, rate: float, seed: int) -> float:
        """Adam over random batches of windows (n, L); returns the last smoothed loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        smooth = 0.0
        for step in range(1, updates + 1):
            pick = rng.integers(0, len(windows), lanes)
            loss, grad = self.gradients(windows[pick].T, y[pick])
            smooth = loss if step == 1 else 0.95 * smooth + 0.05 * loss
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            lr = rate * min(1.0, step / 20) * (1.0 - 0.9 * step / updates)
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            self.freeze()
        return smooth

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(n, C) mean probabilities over each whole text's letters; zeros where there is none."""
        sizes = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        total = np.zeros((len(texts), len(self.labels)))
        letters = np.zeros(len(texts))
        # all texts behind each other, each padded with byte 0 to whole segments
        flat = np.zeros(int(sizes.sum()) * SEGMENT, np.uint8)
        at = 0
        for t, n in zip(texts, sizes.tolist()):
            flat[at:at + len(t)] = np.frombuffer(t, np.uint8)
            at += n * SEGMENT
        rows = flat.reshape(-1, SEGMENT)
        for lo in range(0, len(rows), LANES):
            part = rows[lo:lo + LANES]
            used = int((part != 0).any(axis=0).nonzero()[0].max(initial=0)) + 1
            x = np.ascontiguousarray(part[:, :used].T)
            prob = self.probabilities(self.states(x))
            mask = _LETTER[x]
            who = owner[lo:lo + LANES]
            prob *= mask[:, None, :]
            sums = prob.sum(axis=0, dtype=np.float64)  # (C, lanes)
            for c in range(len(self.labels)):
                total[:, c] += np.bincount(who, sums[c], minlength=len(texts))
            letters += np.bincount(who, mask.sum(axis=0), minlength=len(texts))
        return total / np.maximum(letters, 1)[:, None]


def _windows(length: int, per_doc: int, seed: int):
    """Training windows spread over the whole of each sampled text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, text, lang in zip(pdf["key"], pdf["text"], pdf["lang"]):
                raw = text.encode("utf-8")
                rng = np.random.default_rng([seed, key & 0x7FFFFFFF])
                last = max(0, len(raw) - length)
                for at in sorted(set(rng.integers(0, last + 1, per_doc).tolist())):
                    rows.append((raw[at:at + length], lang))
            yield pd.DataFrame(rows, columns=["window", "lang"])

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 2400,
        windows_per_doc: int = 6, window: int = 64, hidden: int = 10, width: int = 6, updates: int = 400, lanes: int = 256,
        rate: float = 0.02, seed: int = 11) -> Network | None:
    """A network trained on the texts of at most ``sample_docs`` documents with a label and a letter, the
    same share of them for every language (those of the smallest id hashes, so the sample does not
    depend on the layout), ``windows_per_doc`` windows of ``window`` bytes each; the languages are
    balanced. Every label is learned as long as there are not more labels than ``sample_docs``; of more,
    the most frequent. Ids that repeat with other texts take part with each. None if nothing labelled
    holds a letter."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.xxhash64(id_col, F.lit(seed)).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL")
    docs = docs.filter(F.col("text").rlike(r"\p{L}"))
    common = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("key").alias("ids")).orderBy(F.desc("n"), "lang").limit(sample_docs).collect()
    if not common:
        return None
    quota = max(1, sample_docs // len(common))
    # keys are spread evenly, so a language's smallest lie below this bound; only those rows meet in its task
    bounds = docs.sparkSession.createDataFrame(
        [(r["lang"], min((1 << 63) - 1, -(1 << 63) + ((2 * quota + 200) * (1 << 64)) // max(1, r["ids"]))) for r in common], "lang string, bound long")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("key", "th"))
    chosen = (docs.join(F.broadcast(bounds), "lang").filter(F.col("key") <= F.col("bound")).select("lang", "key", F.xxhash64("text").alias("th"))
              .withColumn("nth", nth).filter(F.col("nth") <= quota).select("lang", "key", "th"))
    sample = (docs.withColumn("th", F.xxhash64("text")).join(F.broadcast(chosen.distinct()), ["lang", "key", "th"], "left_semi")
              .dropDuplicates(["lang", "key", "th"]))
    rows = sample.mapInPandas(_windows(window, windows_per_doc, seed), "window binary, lang string").collect()
    rows = sorted((bytes(r["window"]), r["lang"]) for r in rows)
    rows = [r for r in rows if _LETTER[np.frombuffer(r[0], np.uint8)].any()]
    if not rows:
        return None
    labels = sorted({lang for _, lang in rows})
    x = np.zeros((len(rows), window), np.uint8)
    for i, (raw, _) in enumerate(rows):
        x[i, :len(raw)] = np.frombuffer(raw, np.uint8)
    y = np.array([labels.index(lang) for _, lang in rows])
    most = max(np.bincount(y))
    rng = np.random.default_rng(seed)
    pick = np.concatenate([np.concatenate([np.flatnonzero(y == c), rng.choice(np.flatnonzero(y == c), most - (y == c).sum())])
                           for c in range(len(labels))])  # every language as often as the commonest
    net = Network(labels, hidden, width, seed)
    if len(labels) > 1:
        net.train(x[pick], y[pick], updates, lanes, rate, seed)
    return net


def _predict(net: Network | None):
    import re

    letter = re.compile(r"[^\W\d_]")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            known = [t if t and letter.search(t) else None for t in texts.to_pylist()]
            lang, score = [UND] * len(known), [0.0] * len(known)
            at = [i for i, t in enumerate(known) if t is not None]
            if net is not None and at:
                prob = net.documents([known[i].encode("utf-8") for i in at])
                for i, best, p in zip(at, prob.argmax(axis=1).tolist(), prob.max(axis=1).tolist()):
                    lang[i], score[i] = net.labels[best], min(1.0, max(0.0, p))
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return run


def predicted(net: Network | None, text: Column) -> Column:
    """Struct (lang, score) of a text column. ``und`` with score 0 if the text is null or has no letter
    (or nothing could be learned)."""
    return F.arrow_udf(_predict(net), "struct<lang string, score double>")(text)


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its mean probability over the whole text.

    Only the text column goes to the workers and nothing is shuffled; repeated rows give equal results,
    very long texts go through as more segments; clashing output names get a leading underscore."""
    bounded_batches(docs.sparkSession)
    mark, lang, score = free_name(docs, "__lang", lang, score)
    return (docs.withColumn(mark, predicted(net, F.col(text_col)))
            .withColumn(lang, F.col(mark)["lang"]).withColumn(score, F.col(mark)["score"]).drop(mark))
