"""Periodic runs against a search over all periods and places."""

import hashlib
import random

import numpy as np
import pytest

from cairn.llm import period_runs
from cairn.llm.queries import planted_period


def brute(words, least=12):
    """{(start, length): smallest period} of all runs."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= least:
                out.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, p, ln) for (s, ln), p in out.items())


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + ln for s, p, ln in runs))


def solved(words, core):
    """Runs of one text from its tiles, put together as the stitching does."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int32)
    got = [[], [], []]
    for first, end, start, stop, lo, hi in period_runs.tiles(len(w), core):
        tile = w[lo:hi]
        p, a, b = period_runs.solve(tile, np.array([len(tile) + 1]), first, end, start - lo, min(stop - lo, len(tile)))
        for x, y in zip(got, (p, a + lo, b + lo)):
            x.append(y)
    out = {}
    for p, a, b in zip(*map(np.ndarray.tolist, period_runs._merge(*(np.concatenate(x) for x in got)))):
        if b - a >= max(12, 2 * p):
            assert (a, b - a) not in out
            out[a, b - a] = p
    return sorted((s, p, ln) for (s, ln), p in out.items())


def random_text(rng):
    words = []
    while len(words) < rng.choice([5, 30, 120, 400]):
        piece = [rng.choice("abc") if rng.random() < 0.7 else str(rng.randint(0, 50)) for _ in range(rng.choice([1, 2, 3, 7, 8, 20, 45]))]
        words += (piece * rng.choice([1, 1, 2, 3, 9]))[:rng.choice([300, 17, 40])]
    return words


@pytest.mark.parametrize("core", [4, 16, 64, 4096])
def test_tiles_find_every_run(core):
    rng = random.Random(core)
    for _ in range(120):
        words = random_text(rng)
        assert solved(words, core) == brute(words), words


def test_regular_texts():
    fib = "a", "ab"
    while len(fib[1]) < 700:
        fib = fib[1], fib[1] + fib[0]
    for words in (["x"] * 900, list("ab" * 400), list(fib[1]), [str(i % 333) for i in range(999)], [str(i) for i in range(900)]):
        for core in (8, 128, 4096):
            assert solved(words, core) == brute(words)


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
        z = period_runs.z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 12), (4, "a " * 12), (4, "b " * 11), (None, "c d " * 9), (5, "É x " * 20), (6, "one two three " * 3000), (7, "x" * 50000),
       (8, " ".join(str(i) for i in range(15000)) + " " + " ".join(str(i) for i in range(2000, 9000)) * 2)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0, None) for i, t in rows], "doc_id long, text string, ID string, n int, RUNS string").repartition(3)


@pytest.mark.parametrize("core", [4096, 64])
def test_operator(spark, core):
    rng = random.Random(9)
    rows = [(i, t) for i, t in ODD if core > 64 or len(t or "") < 2000] + [(100 + i, " ".join(random_text(rng))) for i in range(60)]
    got = period_runs.periodic_runs(frame(spark, rows), core=core)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed", "words_sha256"]
    want = []
    for i, t in rows:
        words = (t or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        runs = brute(words) if len(words) < 9000 else None
        want.append((i, len(words), runs, collapsed(words, runs) if runs else None, hashlib.sha256(" ".join(words).encode()).hexdigest()))
    have = {(r[0], r[4]): r for r in got.collect()}
    assert got.count() == len(rows)
    for i, n, runs, text, sha in want:
        r = have[i, sha]
        assert r[1] == n
        if runs is not None:
            assert ([tuple(x) for x in r[2]], r[3]) == (runs, text)
    if core > 64:
        long = have[8, hashlib.sha256(ODD[-1][1].encode()).hexdigest()]
        assert [tuple(x) for x in long[2]] == [] and long[3] is None or all(x["period"] >= 1 for x in long[2])


def test_long_document_of_many_tiles(spark):
    """Periods of the largest octaves, in tiles dealt by a shuffle."""
    block = [f"w{i}" for i in range(7001)]
    words = [f"v{i}" for i in range(3000)] + (block * 4)[:25000] + ["x"] * 20000 + [f"u{i}" for i in range(500)]
    (r,) = period_runs.periodic_runs(frame(spark, [(1, " ".join(words))])).collect()
    assert [tuple(x) for x in r["runs"]] == [(3000, 7001, 25000), (28000, 1, 20000)]
    assert r["collapsed"].split(" ") == words[:10001] + ["x"] + words[48000:]


def test_planted_rule():
    from zlib import crc32
    for i in range(300):
        words = [str(j) for j in range(i % 97)]
        h, got = crc32(str(i).encode()), planted_period(i, list(words))
        if h % 10 or not words:
            assert got == words
        else:
            n, g = len(words), h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            assert got == [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]


def test_query_digests(spark, tmp_path):
    """The registered query against brute force over a small table."""
    from cairn.llm.queries import QUERIES
    rng = random.Random(3)
    rows = [(i, " ".join(random_text(rng))) for i in range(40)] + [(40, None), (41, "")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_period_runs"](spark, str(tmp_path))
    want = []
    for i, t in rows:
        words = planted_period(i, [w.encode() for w in (t or "").split()])
        words = [w.decode() for w in words]
        runs = brute(words)
        top = min(runs, key=lambda x: (-x[2], x[0], x[1])) if runs else None
        lines = "".join(f"{s},{ln},{p}\n" for s, p, ln in runs)
        want.append((i, len(runs), *((top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4),
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_table(spark):
    assert period_runs.periodic_runs(frame(spark, [(1, "a")]).filter("false")).count() == 0
