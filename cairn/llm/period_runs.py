"""Periodic runs of words: scale-tiled distribution.

A run of period p is a longest stretch in which words p apart are equal. Periods are taken by octaves
2^k <= p < 2^(k+1). In an octave, boundaries stand every 2^k words, so every run holds one with the
whole run's matches around it: with Z(p) the words that match p further on from the boundary on, and
the same to the left of it, a run has at least p matches in both together. A tile holds a range of
boundaries and as many words around as their Z-functions read, so tiles are solved independently;
what a tile sees of a run is a fragment, and fragments of one (document, period) that overlap by a
period are one run. Tiles of small periods cover many boundaries, those of large ones a few.

Words become integers that are exact within a document. Hashes only choose the periods whose Z value
is worth computing; the Z values compare words. A document of one tile is solved where it is cut,
the tiles of longer ones are dealt over the cluster, and all fragments meet by document and period."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import bounded_batches, cut

CORE = 4096      # words whose boundaries a tile of small periods holds; a document of two has one tile
LEAST = 12       # words of the shortest run
FIRST = 3        # octaves below are one: periods 1 to 7, a boundary every 4 words
MANY = 16        # periods left at one boundary from which its whole Z-function is computed
CELLS = 1 << 20  # words compared at a time
SENT = 1 << 22   # bytes of tiles sent at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)


def octaves(n: int) -> int:
    """One more than the highest octave of a run within n words."""
    return max(FIRST, (n // 2).bit_length())


def tiles(n: int, core: int = CORE) -> list[tuple[int, int, int, int, int, int]]:
    """(first octave, end octave, first boundary, end of boundaries, first word, end word)."""
    top = octaves(n)
    if n <= 2 * core:
        return [(FIRST - 1, top, 0, n, 0, n)]
    small = min(top, max(FIRST, core.bit_length() - 3))  # a tile reads half a core further at most
    out = []
    for first, end in [(FIRST - 1, small)] + [(k, k + 1) for k in range(small, top)]:
        step = max(core, 4 << (end - 1))
        for at in range(0, n, step):
            out.append((first, end, at, min(at + step, n), max(0, at - (2 << (end - 1))), min(n, at + step + (4 << (end - 1)))))
    return out


def z_function(s: list[int]) -> list[int]:
    """z[i]: how many values from i on equal those from 0 on; linear."""
    z, lo, hi = [0] * len(s), 0, 0
    for i in range(1, len(s)):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < len(s) and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def _z_at(w: np.ndarray, c: int, periods: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(matches to the left, from the boundary on) of all these periods, from two Z-functions."""
    far = int(periods.max())
    right = z_function(w[c:c + far + reach].tolist())
    back = w[max(0, c - reach):c][::-1].tolist()
    left = z_function(back + [None] + w[max(0, c - reach):c + far][::-1].tolist())
    end = min(len(w), c + far)
    at = len(back) + 1 + (end - (c + periods))  # where the words before c + p start, backwards
    r = np.array([right[p] if p < len(right) else 0 for p in periods.tolist()], np.int64)
    le = np.array([left[a] if a < len(left) and a > len(back) else 0 for a in at.tolist()], np.int64)
    return np.minimum(le, reach), np.minimum(r, reach)


def _extend(w: np.ndarray, c: np.ndarray, p: np.ndarray, reach: int, step: int) -> np.ndarray:
    """How many words match p further on from c on (step 1) or before c (step -1), at most ``reach``."""
    out = np.zeros(len(c), np.int64)
    rows = max(1, CELLS // reach)
    along = np.arange(reach) * step - (step < 0)
    for lo in range(0, len(c), rows):
        i = c[lo:lo + rows, None] + along
        j = i + p[lo:lo + rows, None]
        ok = (i >= 0) & (j < len(w))
        same = ok & (w[np.where(ok, i, 0)] == w[np.where(ok, j, 0)])
        out[lo:lo + rows] = np.where(same.all(axis=1), reach, same.argmin(axis=1))
    return out


def _merge(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of one period that overlap by a period are one."""
    order = np.lexsort((hi, lo, p))
    p, lo, hi = p[order], lo[order], hi[order]
    if not len(p):
        return p, lo, hi
    # running maximum of the ends within a period: shift each period's values above all earlier ones
    lift = np.cumsum(np.concatenate(([0], p[1:] != p[:-1]))) * (int(hi.max()) + 1)
    top = np.maximum.accumulate(hi + lift) - lift
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (lo[1:] > top[:-1] - p[1:])))
    first = np.flatnonzero(new)
    return p[first], lo[first], np.maximum.reduceat(hi, first)


def _smallest(w: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments whose period is their smallest. A run of period p whose p words repeat q words, q a
    divisor of p, is the run of period q; every fragment of it shows that alike."""
    keep = np.ones(len(p), bool)
    order = np.argsort(lo, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lo[order])) + 1) if len(p) else []:
        at = int(lo[group[0]])
        z = z_function(w[at:at + int(p[group].max())].tolist()) if len(group) > MANY else None
        for i in group.tolist():
            x = int(p[i])
            for q in {x // r for r in _prime_factors(x)}:
                if z[q] >= x - q if z else (w[at:at + x - q] == w[at + q:at + x]).all():
                    keep[i] = False
                    break
    return p[keep], lo[keep], hi[keep]


def _prime_factors(x: int) -> set[int]:
    out, r = set(), 2
    while r * r <= x:
        while x % r == 0:
            out.add(r)
            x //= r
        r += 1
    return out | {x} if x > 1 else out


def solve(w: np.ndarray, sizes: np.ndarray, first: int, end: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, begin, end) of the fragments around the boundaries in [start, stop) of these octaves, of
    at least a period's matches each. ``w`` holds one tile, or whole documents one after another,
    longest first, with an integer of its own behind each; ``sizes`` are their lengths with it."""
    h = (w.astype(np.int64).view(np.uint64) + np.uint64(1)) * _ODD
    h ^= h >> np.uint64(29)
    span = 1
    found = (np.empty(0, np.int64),) * 3
    ends = np.cumsum(sizes)
    for k in range(FIRST - 1, end):
        base = k == FIRST - 1
        want = 2 if base else 1 << (k - 1)
        while span < want:  # hashes of twice as many words
            h = h[:len(h) - span] * np.uint64(0xBF58476D1CE4E5B9) + h[span:]
            h ^= h >> np.uint64(31)
            span *= 2
        if k < first:
            continue
        low = 1 if base else 1 << k
        many = int(np.searchsorted(-sizes, -max(LEAST, 2 * low), side="right"))  # documents long enough
        limit = min(stop, int(ends[many - 1]) if many else 0)
        if limit <= start or len(h) <= low:
            break
        c, p = _candidates(h, span, low, start, limit, base)
        if len(c):
            keep = np.ones(len(c), bool)
            for q, lo, hi in zip(*found):  # inside a run of period q its multiples give the same run
                if hi - lo >= 2 * low:
                    a, b = np.searchsorted(c, lo), np.searchsorted(c, hi, side="right")
                    keep[a:b] &= ~((p[a:b] % q == 0) & (c[a:b] + p[a:b] <= hi) & (hi - lo >= 2 * p[a:b]))
            c, p = c[keep], p[keep]
        if not len(c):
            continue
        reach = 16 if base else 4 * low
        left, right = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        _, at, size = np.unique(c, return_index=True, return_counts=True)
        crowded = size > MANY  # never at the boundaries of periods 1 to 7
        few = ~np.repeat(crowded, size)
        left[few] = _extend(w, c[few], p[few], reach, -1)
        right[few] = _extend(w, c[few], p[few], reach, 1)
        for a, s in zip(at[crowded].tolist(), size[crowded].tolist()):
            left[a:a + s], right[a:a + s] = _z_at(w, int(c[a]), p[a:a + s], reach)
        ok = left + right >= p
        got = _smallest(w, *_merge(p[ok], (c - left)[ok], (c + p + right)[ok]))
        found = tuple(np.concatenate(x) for x in zip(found, got))
    return found


def _candidates(h: np.ndarray, span: int, low: int, start: int, limit: int, base: bool) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) whose ``span`` words from the boundary on, or before it, seem to match."""
    if base:
        c0 = np.arange(-(-start // 4) * 4, limit, 4)
        cs, ps = [], []
        for p in range(1, 8):
            r = c0[c0 + p < len(h)]
            r = r[h[r] == h[r + p]]
            le = c0[(c0 >= span) & (c0 - span + p < len(h))]
            le = le[h[le - span] == h[le - span + p]]
            c = np.union1d(r, le)
            cs.append(c)
            ps.append(np.full(len(c), p))
        c, p = np.concatenate(cs), np.concatenate(ps)
        order = np.lexsort((p, c))
        return c[order], p[order]
    first = -(-start // low)
    rows = -(-limit // low) - first
    if rows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hit = np.zeros((rows, low), bool)
    for back in (0, span):
        # row r, column t: boundary (first + r) * low, period low + t; places outside never match
        a, size = first * low - back, rows * low
        near = np.arange(rows) * low + a
        here = np.where((near >= 0) & (near < len(h)), h[np.clip(near, 0, len(h) - 1)], np.uint64(1))
        lo, hi = a + low, a + low + size
        there = np.zeros(size, np.uint64)
        s, e = max(lo, 0), min(hi, len(h))
        valid = np.zeros(size, bool)
        if s < e:
            there[s - lo:e - lo] = h[s:e]
            valid[s - lo:e - lo] = True
        hit |= (there.reshape(rows, low) == here[:, None]) & valid.reshape(rows, low) & ((near >= 0) & (near < len(h)))[:, None]
    r, t = np.nonzero(hit)
    return (first + r) * low, low + t


_COLUMNS = [("kind", "int"), ("n", "long"), ("words", "string"), ("plain", "string"), ("period", "long"), ("lo", "long"), ("hi", "long"),
            ("first", "int"), ("end", "int"), ("start", "long"), ("stop", "long"), ("base", "long"), ("ids", "binary")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_DOC, _FRAGMENT, _TILE = 0, 1, 2


def _cut_and_solve(core: int, rewrite: Callable | None):
    """Rows (id, sha, text) -> documents (their words joined by one space only if they have a fragment
    or several tiles), fragments, and the tiles of documents of several."""

    def batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        names = ["id", "sha"] + [c for c, _ in _COLUMNS]
        types = [id_type, pa.binary()] + [_ARROW[t] for _, t in _COLUMNS]
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids: dict[bytes, int] = {}
            out, held = [], []  # rows; (row, text, integers) of the documents of one tile
            dealt, size = [], 0  # tiles
            for i, sha, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                words = (raw or b"").split()  # bytes split at ASCII white space only
                if rewrite is not None:
                    words = rewrite(i, words)
                text, n = b" ".join(words), len(words)
                doc = [i, sha, _DOC, n, None, sha256(text).hexdigest()]
                out.append(doc)
                if n < LEAST:
                    continue
                w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int32, n)
                if n <= 2 * core:
                    held.append((doc, text, w))
                    continue
                doc[4] = text.decode("utf-8")
                for first, end, start, stop, lo, hi in tiles(n, core):
                    dealt.append((i, sha, _TILE, n, None, None, None, None, None, first, end, start - lo, stop - lo, lo, w[lo:hi].tobytes()))
                    size += 4 * (hi - lo)
                    if size >= SENT:
                        yield batch(dealt, b.schema.field(0).type)
                        dealt, size = [], 0
            held.sort(key=lambda x: -len(x[2]))
            if held:
                sizes = np.array([len(w) + 1 for _, _, w in held])
                p, lo, hi = solve(np.concatenate([x for j, (_, _, w) in enumerate(held) for x in (w, np.array([-1 - j], np.int32))]),
                                  sizes, FIRST - 1, octaves(int(sizes[0])), 0, int(sizes.sum()))
                whole = hi - lo >= np.maximum(LEAST, 2 * p)  # these documents have no other tile
                owner = np.searchsorted(np.cumsum(sizes), lo, side="right")
                begin = np.cumsum(sizes) - sizes
                for j, q, s, e in zip(owner[whole].tolist(), p[whole].tolist(), (lo - begin[owner])[whole].tolist(), (hi - begin[owner])[whole].tolist()):
                    doc, text, _ = held[j]
                    doc[4] = text.decode("utf-8")
                    out.append([*doc[:2], _FRAGMENT, None, None, None, q, s, e])
            if dealt:
                yield batch(dealt, b.schema.field(0).type)
            for at in range(0, len(out), 10_000):
                yield batch([tuple(r) + (None,) * (len(_COLUMNS) + 2 - len(r)) for r in out[at:at + 10_000]], b.schema.field(0).type)

    return run


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles -> fragments, without those that are too short and end inside the tile."""
    for b in batches:
        for r in range(b.num_rows):
            n, first, end, start, stop, base, raw = (b.column(c)[r].as_py() for c in ("n", "first", "end", "start", "stop", "base", "ids"))
            w = np.frombuffer(raw, np.int32)
            p, lo, hi = solve(w, np.array([len(w) + 1]), first, end, start, min(stop, len(w)))
            open_end = ((lo == 0) & (base > 0)) | ((hi == len(w)) & (base + len(w) < n))
            keep = open_end | (hi - lo >= np.maximum(LEAST, 2 * p))  # a Z value cut short by its reach is longer
            count = int(keep.sum())
            yield pa.RecordBatch.from_arrays([b.column("id").slice(r, 1).take(pa.array(np.zeros(count, np.int64))), b.column("sha").slice(r, 1).take(pa.array(np.zeros(count, np.int64))),
                                              pa.array(p[keep]), pa.array(lo[keep] + base), pa.array(hi[keep] + base)], names=["id", "sha", "period", "lo", "hi"])


def stitched(fragments: DataFrame) -> DataFrame:
    """(id, sha, start, length, period) of the runs: fragments of a document and period that overlap by a
    period put together, runs too short left out."""
    w = Window.partitionBy("id", "sha", "period").orderBy("lo", "hi")
    so_far = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("lo") > so_far - F.col("period")).cast("int"), F.lit(1))
    marked = fragments.distinct().withColumn("opens", opens).withColumn("nth", F.sum("opens").over(w))
    whole = marked.groupBy("id", "sha", "period", "nth").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    whole = whole.filter(F.col("hi") - F.col("lo") >= F.greatest(F.lit(LEAST), 2 * F.col("period")))
    return whole.select("id", "sha", F.col("lo").alias("start"), (F.col("hi") - F.col("lo")).alias("length"), "period")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words without those inside a run after its first period."""
    for b in batches:
        texts = []
        for raw, runs in zip(b.column("words").cast(pa.binary()).to_pylist(), b.column("runs").to_pylist()):
            if not runs:
                texts.append(None)
                continue
            words = raw.split(b" ")
            depth = np.zeros(len(words) + 1, np.int64)
            for r in runs:
                depth[r["start"] + r["period"]] += 1
                depth[r["start"] + r["length"]] -= 1
            texts.append(b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]))
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), b.column("plain"), b.column("runs"), pa.array(texts, pa.binary()).cast(pa.string())],
                                         names=["id", "n", "plain", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable | None = None, core: int = CORE) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, runs, collapsed, words_sha256).

    ``runs``: all runs of at least 12 words as structs (start, period, length), ordered by start and
    period. ``collapsed``: the words joined by one space without the repetitions, null where there is
    no run; ``words_sha256``: of all words joined by one space. ``rewrite(id, words)`` may change a
    document's words (bytes) first. A null or empty text has no word and no run; a null id is an id
    like any other; rows repeated with id and text get equal results each; texts of any length are
    read whole. An empty table gives an empty result. Only the two columns are read, so further ones
    cannot clash."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("id", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("sha"), "text")
    key = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("sha", T.BinaryType())]
    kinds = {"int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType()}
    stored = cut(texts.mapInArrow(_cut_and_solve(core, rewrite), T.StructType(key + [T.StructField(c, kinds[t]) for c, t in _COLUMNS])))
    schema = T.StructType(key + [T.StructField(c, T.LongType()) for c in ("period", "lo", "hi")])
    dealt = stored.filter(F.col("kind") == _TILE).select("id", "sha", "n", "first", "end", "start", "stop", "base", "ids").repartition("id", "sha", "first", "base")
    fragments = stored.filter(F.col("kind") == _FRAGMENT).select("id", "sha", "period", "lo", "hi").unionAll(dealt.mapInArrow(_solve_tiles, schema))
    runs = stitched(fragments).groupBy("id", "sha").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    all_docs = stored.filter(F.col("kind") == _DOC)
    found = all_docs.filter("words IS NOT NULL").select("id", "sha", "n", "words", "plain").withColumnsRenamed({"id": "i", "sha": "s"})
    found = found.join(runs, F.col("i").eqNullSafe(F.col("id")) & (F.col("s") == F.col("sha")), "left").select(F.col("i").alias("id"), "n", "plain", "words", "runs")
    out = T.StructType([key[0], T.StructField("n", T.LongType()), T.StructField("plain", T.StringType()), found.schema["runs"], T.StructField("collapsed", T.StringType())])
    rest = all_docs.filter("words IS NULL").select("id", "n", "plain", F.lit(None).cast(found.schema["runs"].dataType).alias("runs"), F.lit(None).cast("string").alias("collapsed"))
    return found.mapInArrow(_collapse, out).unionAll(rest).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_words"), F.coalesce("runs", F.array().cast(found.schema["runs"].dataType)).alias("runs"), "collapsed",
        F.col("plain").alias("words_sha256"))
