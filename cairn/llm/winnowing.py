"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item. Of the k-gram hashes of a text the
smallest of every ``window - k + 1`` consecutive ones is kept (the last of equal ones), so whatever
two texts share a run of ``window`` words, both keep the same hash at the same place inside it.
Documents keep only runs of words around fingerprints that pass a fixed-size bitmap of the
benchmark's fingerprints; the fingerprints of these spans are joined with the benchmark's, and each
hit, a span and an item, is extended window by window to the full shared runs, which compares the
words themselves and takes time linear in the span however often a fingerprint repeats.

Items shorter than ``window`` are one window of their own length: their only k-gram (k = their
length) plays the fingerprint's part, with nothing to extend."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, cut

BITMAP_BITS = 1 << 23  # 1 MB: the bound of what is sent to every task
ITEM_WORDS = 1 << 20   # words of items whose windows a task keeps; beyond it the memory starts anew
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")  # bytes of non-ASCII letters are all above 0x7f
_P = 0x9E3779B97F4A7C15


def word_list(raw: bytes) -> list[bytes]:
    return _WORD.findall(raw.lower())  # bytes: lower-cases A-Z only


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); wraps around."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of the words, each distinct word hashed once a task."""
    from xxhash import xxh64_intdigest

    if len(memo) > 500_000:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = xxh64_intdigest(w, 9)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; the length takes part, so different k never meet."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, (k * _P) & (2**64 - 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(_P) + h[j:j + n]
    return _mix(out)


def winnowed(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the minimum of every w consecutive hashes (the rightmost of equal minima)."""
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, w):
        smaller = g[j:j + n] <= best
        best = np.where(smaller, g[j:j + n], best)
        at = np.where(smaller, np.arange(j, j + n), at)
    return np.unique(at)


def _slot(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(64 - BITMAP_BITS.bit_length() + 1)).astype(np.int64)


def _item_grams(window: int, k: int):
    """Fingerprints of the items: the winnowed k-grams, or the whole of a short item."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[bytes, int] = {}
        for pdf in batches:
            cls, grams, places = [], [], []
            for c, text in zip(pdf["cls"], pdf["words"]):
                words = text.encode("utf-8").split(b" ")
                h = word_hashes(words, memo)
                if len(words) < window:
                    at, g = np.zeros(1, np.int64), gram_hashes(h, len(words))
                else:
                    g = gram_hashes(h, k)
                    at = winnowed(g, window - k + 1)
                    g = g[at]
                cls += [c] * len(at)
                grams += g.view(np.int64).tolist()
                places += at.tolist()
            yield pd.DataFrame({"cls": cls, "g": grams, "at": places})

    return run


def _document_rows(window: int, k: int, short: tuple[int, ...], bitmap: bytes):
    """Per document its word count, the spans between fingerprints that pass the bitmap (with the
    words that a window could add on either side), and the places of grams as long as a short item."""
    reach = window - k

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[bytes, int] = {}
        bits = np.frombuffer(bitmap, np.uint8)

        def passing(at: np.ndarray, g: np.ndarray) -> np.ndarray:
            s = _slot(g)
            return at[(bits[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1]

        def join(words: list[bytes]) -> str:
            return b" ".join(words).decode("utf-8")

        for pdf in batches:
            counts, all_spans, all_short = [], [], []
            for text in pdf["text"]:
                words = word_list(text.encode("utf-8")) if text else []
                spans, places = [], {}
                h = word_hashes(words, memo)
                g = gram_hashes(h, k)
                at = winnowed(g, reach + 1)
                at = passing(at, g[at])
                if len(at):
                    breaks = np.flatnonzero(np.diff(at) > reach + 1) + 1
                    for part in np.split(at, breaks):
                        lo, hi = int(part[0]), int(part[-1]) + k
                        spans.append({"start": lo, "core": join(words[lo:hi]), "before": join(words[max(0, lo - reach):lo]),
                                      "after": join(words[hi:hi + reach])})
                for n in short:
                    g = gram_hashes(h, n)
                    for p in passing(np.arange(len(g)), g).tolist():
                        places.setdefault(join(words[p:p + n]), []).append(p)
                counts.append(len(words))
                all_spans.append(spans)
                all_short.append([{"gram": a, "places": b} for a, b in places.items()])
            yield pd.DataFrame({"id": pdf["id"], "th": pdf["th"], "n_words": counts, "spans": all_spans, "short": all_short})

    return run


def _core_grams(k: int):
    """The distinct k-grams of each distinct span: the training side of the fingerprint join."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[bytes, int] = {}
        for pdf in batches:
            for core in pdf["core"]:
                g = np.unique(gram_hashes(word_hashes(core.encode("utf-8").split(b" "), memo), k))
                yield pd.DataFrame({"core": core, "g": g.view(np.int64)})

    return run


def shared_runs(text: list[bytes], h: np.ndarray, item: list[bytes], windows: dict[int, list[int]], window: int) -> list[tuple[int, int]]:
    """The runs [lo, hi) of words that consecutive windows of the text share with the item; linear in the
    text. Hashes choose the windows, the words themselves decide."""
    runs: list[tuple[int, int]] = []
    for i, g in enumerate(gram_hashes(h, window).tolist()):
        places = windows.get(g)
        if places and any(text[i:i + window] == item[p:p + window] for p in places):
            if runs and runs[-1][1] >= i:
                runs[-1] = (runs[-1][0], i + window)
            else:
                runs.append((i, i + window))
    return runs


def _extend(window: int):
    """Extends each hit, a span and an item with a common fingerprint, over the span and the words
    around it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[bytes, int] = {}
        items: dict[str, tuple[list[bytes], dict[int, list[int]]]] = {}
        held = 0

        def windows_of(cls: str, words: str) -> tuple[list[bytes], dict[int, list[int]]]:
            nonlocal held
            if cls not in items:
                if held > ITEM_WORDS:
                    items.clear()
                    held = 0
                item = words.encode("utf-8").split(b" ")
                places: dict[int, list[int]] = {}
                for at, g in enumerate(gram_hashes(word_hashes(item, memo), window).tolist()):
                    known = places.setdefault(g, [])
                    if not any(item[p:p + window] == item[at:at + window] for p in known):  # equal windows once
                        known.append(at)
                items[cls] = item, places
                held += len(item)
            return items[cls]

        for pdf in batches:
            hits = []
            for start, core, before, after, cls, words in zip(pdf["start"], pdf["core"], pdf["before"], pdf["after"], pdf["cls"], pdf["words"]):
                lead = before.encode("utf-8").split()
                text = lead + core.encode("utf-8").split(b" ") + after.encode("utf-8").split()
                found = shared_runs(text, word_hashes(text, memo), *windows_of(cls, words), window)
                hits.append([{"lo": int(start) - len(lead) + lo, "hi": int(start) - len(lead) + hi, "cls": cls} for lo, hi in found])
            yield pd.DataFrame({"id": pdf["id"], "th": pdf["th"], "hits": hits})

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """Per row of ``docs``: ``(id, th, n_words, hits array<struct<lo, hi>>, n_hit, items array<string>)``.

    ``hits`` are the merged word ranges [lo, hi) inside occurrences of benchmark windows, ``items`` the
    ids (as strings, sorted) of the items with occurring windows, ``th`` the hash of the stored text.
    Null and word-less texts have no words, no hits; word-less items have no windows; equal rows give
    equal rows; items with the same words form one class, so copies of an item cost nothing more.
    Other columns are not read. Nothing is broadcast but a bitmap of ``BITMAP_BITS`` bits: a larger
    benchmark only lets more spans through to the exact join.

    The fingerprints of a passage that many documents share meet the benchmark's once (spans are grouped
    by their words first); each document's span is then extended by itself."""
    if not 1 < k < window:
        raise ValueError("k must lie between 1 and the window")
    spark = docs.sparkSession
    bounded_batches(spark)
    reach = window - k
    lowered = F.translate(F.col(item_text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    classes = cut(benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("words"))
                  .filter("words <> ''").groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("ids"))
                  .select(F.sha2("words", 256).alias("cls"), "words", "ids",
                          F.size(F.split("words", " ")).alias("n")))
    short = tuple(sorted(r["n"] for r in classes.filter(F.col("n") < window).select("n").distinct().collect()))
    prints = cut(classes.mapInPandas(_item_grams(window, k), "cls string, g long, at int"))
    slot = F.shiftrightunsigned("g", 64 - BITMAP_BITS.bit_length() + 1)
    cells = (prints.select(F.shiftright(slot, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(g, {64 - BITMAP_BITS.bit_length() + 1}) & 63 as int))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect())  # at most BITMAP_BITS / 64 rows
    board = np.zeros(BITMAP_BITS // 64, "<i8")
    for r in cells:
        board[r["cell"]] = r["bits"]

    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    base = cut(base.mapInPandas(
        _document_rows(window, k, short, board.tobytes()),
        f"id {id_type}, th long, n_words long, spans array<struct<start int, core string, before string, after string>>,"
        " short array<struct<gram string, places array<int>>>"))

    spans = base.select("id", "th", F.explode("spans").alias("s")).select("id", "th", "s.*")
    cores = spans.select("core").distinct()
    long_items = classes.filter(F.col("n") >= window)
    # a fingerprint that a text repeats counts once on either side
    met = cores.mapInPandas(_core_grams(k), "core string, g long").join(
        prints.join(long_items.select("cls"), "cls", "left_semi").select("cls", "g").distinct(), "g").select("core", "cls").distinct()
    hit = "array<struct<lo int, hi int, cls string>>"
    found = (spans.join(met, "core").join(long_items.select("cls", "words"), "cls")
             .select("id", "th", "start", "core", "before", "after", "cls", "words").mapInPandas(_extend(window), f"id {id_type}, th long, hits {hit}"))
    if short:
        grams = base.select("id", "th", F.explode("short").alias("s")).select("id", "th", "s.*")
        whole = grams.join(classes.filter(F.col("n") < window).select(F.col("words").alias("gram"), "cls", "n"), "gram")
        found = found.unionByName(whole.select("id", "th", F.transform("places", lambda p: F.struct(
            p.alias("lo"), (p + F.col("n")).alias("hi"), F.col("cls").alias("cls"))).cast(hit).alias("hits")))
    rows = cut(found.select("id", "th", F.explode("hits").alias("h")).select("id", "th", "h.*").distinct())
    item_ids = (rows.select("id", "th", "cls").distinct().join(classes.select("cls", "ids"), "cls")
                .groupBy("id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")))
    nothing = F.array().cast("array<struct<lo int, hi int>>")
    w = Window.partitionBy("id", "th").orderBy("lo", "hi")
    opens = F.coalesce((F.col("lo") > F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    merged = (rows.select("id", "th", "lo", "hi", opens.alias("opens")).withColumn("nth", F.sum("opens").over(w))
              .groupBy("id", "th", "nth").agg(F.struct(F.min("lo").alias("lo"), F.max("hi").alias("hi")).alias("x"))
              .groupBy("id", "th").agg(F.array_sort(F.collect_list("x")).alias("hits")))
    marked = (merged.withColumnsRenamed({"id": "i", "th": "t"}).join(item_ids, F.col("i").eqNullSafe(F.col("id")) & F.col("t").eqNullSafe(F.col("th")))
              .select(F.col("i").alias("hit_id"), F.col("t").alias("hit_th"), "hits", "items"))
    return (base.select("id", "th", "n_words")
            .join(marked, base["id"].eqNullSafe(marked["hit_id"]) & (base["th"] == marked["hit_th"]), "left")
            .select("id", "th", "n_words", F.coalesce("hits", nothing).alias("hits"),
                    F.coalesce(F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + (x["hi"] - x["lo"])),
                               F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
