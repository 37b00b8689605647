"""Decontamination of texts that repeat one word or phrase: exact, and linear in their length."""

import random
import time

import numpy as np

from cairn.llm.winnowing import benchmark_hits, gram_hashes, shared_runs, word_hashes


def brute(docs, items, window=10):
    out = {}
    for i, text in docs:
        words, hit, names = text.split(), set(), set()
        for name, item in items:
            w = item.split()
            n = min(window, len(w))
            shared = {tuple(w[a:a + n]) for a in range(len(w) - n + 1)}
            for a in range(len(words) - n + 1):
                if tuple(words[a:a + n]) in shared:
                    hit.update(range(a, a + n))
                    names.add(str(name))
        out[i] = (len(words), len(hit), sorted(names))
    return out


def test_repeated_words_and_phrases(spark):
    rng = random.Random(4)
    docs = [(0, "x " * 60), (1, "x " * 9), (2, "a b " * 30 + "x " * 30), (3, "a b c " * 8 + "q " + "a b c " * 3)]
    docs += [(10 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 80)))) for i in range(40)]
    items = [(1, "x " * 40), (2, "a b " * 12), (3, "a b c " * 5), (4, "b"), (5, " ".join(rng.choice("ab") for _ in range(300)))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in benchmark_hits(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)


def test_time_grows_with_the_length_only(spark):
    """An item of 30,000 equal words against documents of 20,000: all pairs of places would be 10^9."""
    docs = spark.createDataFrame([(i, "x " * 20000) for i in range(3)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "x " * 30000)], "item_id long, text string")
    benchmark_hits(docs.limit(1), items.limit(1)).collect()
    at = time.time()
    got = benchmark_hits(docs, items).collect()
    assert [r["n_hit"] for r in got] == [20000] * 3 and time.time() - at < 60


def test_runs_compare_words_not_hashes():
    words = [b"a", b"b", b"c", b"d", b"e"]
    h = word_hashes(words, {})
    g = gram_hashes(h, 3)
    windows = {int(x): [0] for x in g}          # every window said to be the item's first
    assert shared_runs(words, h, [b"b", b"c", b"d"], windows, 3) == [(1, 4)]
    assert shared_runs(words, h, [b"x", b"c", b"d"], windows, 3) == []
    assert shared_runs([], np.empty(0, np.uint64), [b"b"], windows, 3) == []
