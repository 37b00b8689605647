"""Training-data operators against brute force and on odd inputs (whole-table equality with DuckDB
runs through the registered queries)."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "null id text here"), (5, "!!! 123"),
       (6, "É́ ß İ 漢字  x"), (7, "word " * 30000), (8, "a" * 50000)]


def odd_docs(spark):
    """Nulls, empties, repeats, very long texts, and extra columns with clashing names."""
    df = spark.createDataFrame([(i, t, None, "s", None, 1, 2.0) for i, t in ODD],
                               "doc_id long, text string, lang string, source string, n_chars long, N_TOKENS int, Score double")
    return df.repartition(3)


# ------------------------------------------------------------------ op1
def test_min_cut_is_a_minimum():
    from cairn.llm.html_mincut import min_cut
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        odds = [rng.randint(-9, 9) for _ in range(n)]
        arcs = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(side):
            return (sum(-o for o, s in zip(odds, side) if o < 0 and s) + sum(o for o, s in zip(odds, side) if o > 0 and not s)
                    + sum(c for i, j, c in arcs if side[i] != side[j]))

        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(min_cut(odds, arcs)) == best


def test_html_extraction():
    from cairn.llm.html_mincut import main_text
    long = "A sentence that is long enough to count as prose, surely."
    page = (f'<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>'
            f'<div id="cookie-notice">{long}</div><script>var a="</p><p>{long}";</script><!-- {long} --><main><h2>Title</h2>'
            f'<p>First &lt;b&gt; &amp;amp; <b>bo</b>ld.\n  {long}<p>Second&nbsp; one<br>line. {long}<aside>{long}</aside></main>'
            f'<div class="ad">{long}</div><section class="comments"><article><p>{long}</p></article></section>'
            f'<form>{long}<input></form><footer>&copy; {long}</footer>')
    assert main_text(page) == f"Title\nFirst <b> &amp; bold. {long}\nSecond one line. {long}"
    assert main_text(None) == main_text("") == main_text("<p> </p>") == main_text("<script>x") == ""
    assert main_text("plain text without any tag, but with enough words to be content.").startswith("plain")
    deep = "<div>" * 5000 + f"<p>{long}</p>" + "</div>" * 5000
    assert main_text(deep) == long
    assert main_text("<p>" + "<" * 3000) is not None and main_text('<a href="' * 2000) is not None


def test_html_keeps_text_around_embedded_elements():
    from cairn.llm.html_mincut import blocks_of, main_text
    long = "A sentence that is long enough to count as prose, surely."
    for tag in ("object", "video", "select", "svg", "math", "template", "audio", "canvas", "noscript"):
        assert main_text(f"<article><p>{long}<{tag}><p>{long}<p>{long}</article>") == f"{long}\n{long}\n{long}", tag
        assert main_text(f"<article><p>{long}</p><div><{tag}><{tag}></{tag}></div><p>{long}</article>") == f"{long}\n{long}", tag
    assert main_text(f"<article><p>{long} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> {long}</article>") == f"{long} x=1 {long}"
    assert main_text(f"<article><object><object><p>{long}</object><p>{long}</object></article>") == f"{long}\n{long}"
    assert main_text(f"<article><p>{long} <svg><path d='M0'/></svg> {long}</article>") == f"{long} {long}"
    page = f"<article><p>{long}<svg><svg><text>inner</text></svg><text>{long}</text></svg></p><select><option>One<option>Two</select><video>no video</video><p>{long}</article>"
    assert main_text(page) == f"{long}\n{long}" and [b.text for b in blocks_of(page)][1] == f"inner{long}"


def test_html_end_tags_reach_any_depth():
    from cairn.llm.html_mincut import main_text
    long = "A sentence that is long enough to count as prose, surely."
    assert main_text("<body><nav>" + "<a href=x>go<font>" * 400 + f"</nav><article><p>{long}</p></article>") == long
    assert main_text("<article><p>" + "<b>" * 40 + f"{long}<p>{long}</article>") == f"{long}\n{long}"
    assert main_text("<article><ul><li class=ad>" + "<b>" * 60 + f"x<li>{long}</ul></article>") == long
    assert main_text("<a>" * 100000 + "</nav></b>" * 100000 + long) is not None


def test_extract_keeps_rows(spark):
    from cairn.llm.html_mincut import extract_main_text
    pages = spark.createDataFrame([(1, None, 9), (1, None, 9), (2, "", 9)], "page_id long, html string, Text int")
    rows = extract_main_text(pages).collect()
    assert [(r["_text"], r["n_chars"]) for r in rows] == [("", 0)] * 3
    assert extract_main_text(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ op2
def test_forest_recall_and_ties(spark):
    from cairn.llm.lsh_forest import nearest
    rng = np.random.default_rng(0)
    x = rng.standard_normal((6000, 24)).astype(np.float32) * rng.uniform(0.5, 2, (6000, 1)).astype(np.float32)
    x[5] = x[4]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(10000, None), (10001, [0.0] * 24), (10002, [float("nan")] * 24), (10003, [1.0, None] * 12), (10004, [1.0]), (None, [1.0] * 24), (20, x[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(df, "vec_id % 100 = 0", k=10, trees=12, shard_rows=1500, query_block=20, sample_rows=1500, least=64).toPandas()
    assert set(got["query_id"]) == set(range(0, 6000, 100)) and (got.groupby("query_id").size() == 10).all()
    scores = x.astype(float) @ x.astype(float).T
    hits = 0
    for q, part in got.groupby("query_id"):
        mine = scores[q].copy()
        mine[q] = -np.inf
        hits += len(set(np.argsort(-mine)[:10]) & set(part["id"]))
        assert part.sort_values("rank")["score"].is_monotonic_decreasing
    assert hits / (10 * 60) >= 0.9


def test_forest_copies(spark):
    from cairn.llm.lsh_forest import nearest
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(200)] + [(500, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["id"] for r in nearest(df, "vec_id IN (3, 150, 500)", k=4).collect()}
    assert [got[3, r] for r in (1, 2, 3, 4)] == [0, 1, 2, 4] and [got[150, r] for r in (1, 2, 3, 4)] == [0, 1, 2, 3]
    assert [got[500, r] for r in (1, 2, 3, 4)] == [0, 1, 2, 3]
    assert nearest(df.limit(0), "true").count() == 0


# ------------------------------------------------------------------ op3, op7
def _toy(n):
    rng = random.Random(2)
    words = {"aa": ["the", "with", "ing", "house"], "bb": ["der", "und", "ung", "haus"]}
    return [(i, " ".join(rng.choice(words["aa" if i % 2 else "bb"]) for _ in range(40)), "aa" if i % 2 else "bb") for i in range(n)]


def test_language_network_learns_and_is_exact_on_odd_texts(spark):
    from cairn.llm.bigru_langid import Network, fit, identify
    net = Network(["a", "b"], 4, 3, 1)
    rng = np.random.default_rng(0)
    x, y = rng.integers(60, 120, (7, 5)), np.array([0, 1, 0, 1, 1])
    _, grad = net.gradients(x, y)
    for name in ("E", "A", "W", "c"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old, losses = net.p[name][at], []
        for d in (0.01, -0.01):
            net.p[name][at] = old + d
            losses.append(net.gradients(x, y)[0])
        net.p[name][at] = old
        assert abs((losses[0] - losses[1]) / 0.02 - grad[name][at]) < 0.02 * abs(grad[name][at]) + 1e-3
    # padding and neighbours in the batch change nothing
    alone = net.documents([b"hello world"])
    assert np.allclose(alone, net.documents([b"x" * 1000, b"hello world", b""])[1], atol=1e-5)
    docs = spark.createDataFrame(_toy(200), "doc_id long, text string, lang string")
    model = fit(docs, updates=120)
    out = identify(docs, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    odd = identify(odd_docs(spark), model)
    got = {r["doc_id"]: r for r in odd.collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["_score"] == 0.0 for i in (1, 2, 3, 5)) and got[7]["lang_pred"] in ("aa", "bb")
    assert fit(odd_docs(spark)) is None and identify(docs.limit(0), None).count() == 0


def test_factorisation_machine(spark):
    from cairn.llm.fm_quality import Machine, fit, quality_scores
    rng = np.random.default_rng(3)
    m = Machine(np.zeros((15, 11)), 1)
    m.w = rng.normal(size=m.size)
    idx, val = np.array([3, 70, 9, 800]), rng.normal(size=4)
    naive = m.w0 + m.w[idx] @ val + sum(m.v[idx[i]] @ m.v[idx[j]] * val[i] * val[j] for i in range(4) for j in range(i + 1, 4))
    assert np.isclose(m.margins(idx, val, np.array([0]))[0][0], naive)
    rows = [(i, t if i % 2 else (t.split()[0] + " ") * 40, 100) for i, t, _ in _toy(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i, _, _ in rows] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = fit(docs, labels, updates=60)
    got = quality_scores(docs, model).collect()
    assert np.mean([(r["score"] >= 0.3) == bool(r["doc_id"] % 2) for r in got]) > 0.97
    odd = quality_scores(odd_docs(spark).drop("Score"), model)
    assert odd.count() == len(ODD) and odd.filter("score BETWEEN 0 AND 1").count() == len(ODD)
    assert fit(docs, labels.limit(0)) == 0.5 and quality_scores(docs.limit(0), model).count() == 0


# ------------------------------------------------------------------ op5, op6
def test_covering_masks_cover():
    from cairn.llm.covering_simhash import covering_masks, linked
    rng = random.Random(4)
    for positions, r in ((list(range(64)), 4), (list(range(3, 35)), 3)):
        masks = covering_masks(positions, r)
        for _ in range(3000):
            flip = sum(1 << p for p in rng.sample(positions, r))
            assert any(not flip & m for m in masks)
    a, b = linked(np.array([0, 1, 3, 255, 254], np.uint64), 1)
    assert len(a) == 3


def test_simhash_components_brute_force(spark):
    from cairn.llm.covering_simhash import fingerprint_links, one_per_component, simhash_components
    from cairn.llm.common import components
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(20):
            x = s
            for p in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << p
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for cap in (4096, 3):  # 3: through the second level of masks
        got = {r["node"]: r["root"] for r in components(fingerprint_links(df, 4, cap)).collect()}
        assert all(got.get(x, x) == find(x) for x in fps)
    odd = simhash_components(odd_docs(spark)).collect()
    assert len(odd) == len(ODD)
    none = {r["component_id"] for r in odd if r["doc_id"] in (1, 2, 3)}
    assert none == {1}
    assert sorted(str(r["doc_id"]) for r in one_per_component(odd_docs(spark)).collect()) == sorted(["1", "4", "None", "5", "6", "7", "8"])
    assert simhash_components(odd_docs(spark).limit(0)).count() == 0


def test_components_long_path_and_hub(spark):
    from cairn.llm.common import components
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[1000 + i] == 1000 for i in range(60)) and 5000 not in got


def test_components_by_one_task_and_by_rounds(spark, monkeypatch):
    """Few edges are connected by one task, with the roots that the rounds give and fewer stages."""
    from cairn.llm import common
    rng = random.Random(11)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5, None), (None, 7), (7000, 7000), edges[0], edges[0][::-1]]
    texts = [tuple(None if x is None else f"{'é' if x % 2 else 'z'}{x}" for x in e) for e in edges]
    for kind, rows in (("long", edges), ("string", texts)):
        df = spark.createDataFrame(rows, f"a {kind}, b {kind}").repartition(3)
        got = []
        for most in (common.TASK_EDGES, 0):
            monkeypatch.setattr(common, "TASK_EDGES", most)
            cuts = []
            monkeypatch.setattr(common, "cut", lambda x, cut=common.cut: cuts.append(x) or cut(x))
            got.append((sorted(map(tuple, common.components(df).collect())), len(cuts)))
            monkeypatch.undo()
        assert got[0][0] == got[1][0] and len(got[0][0]) > 500
        assert got[0][1] == 2 < got[1][1]  # the edges and their components; else a table a round


def test_cut_leaves_no_shuffle_files(spark):
    """The shuffle files of a stored table go with the run that wrote it, also while the plan is still held."""
    import os
    import time

    from cairn.llm import common
    folders = [f.getPath() for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    df = spark.range(20000).groupBy((F.col("id") % 700).alias("k")).count()
    old, setting, until = shuffles(), spark.conf.get(common.SHUFFLE_CLEANUP), time.time() + 20
    got = common.cut(df)
    while shuffles() - old and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - old
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == setting
    assert got.count() == df.count() == 700 and got.exceptAll(df).count() == 0


def test_edit_similarity():
    from cairn.llm.fuzzy_lines import edit_similarity_at_least
    rng = random.Random(6)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for _ in range(2000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        for least in (0.5, 0.8):
            longest = max(len(a), len(b))
            assert edit_similarity_at_least(a, b, least) == (lev(a, b) <= (1 - least) * longest + 1e-9)


def _simhash(norm: bytes) -> int:
    """Plain form: the majority bit of the hashes of all 4-byte windows."""
    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
        x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
        return x ^ x >> 31

    w = [mix(int.from_bytes(norm[i:i + 4], "little") * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for i in range(len(norm) - 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in w) > len(w))


def test_line_prints():
    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(11)
    seen = {}
    for n in range(300):
        text = "".join(rng.choice("aB1 \t\né\u2028") for _ in range(rng.randint(0, 80) if n else 3000))
        lines = text.encode().split(b"\n")
        got = {at: (h, s & (1 << 64) - 1) for at, h, s in zip(*(x.tolist() for x in fl.line_prints(text.encode(), 9)))}
        assert set(got) == {at for at, x in enumerate(lines) if fl.normalise(x)}
        for at, (h, s) in got.items():
            norm = fl.normalise(lines[at])
            assert seen.setdefault(h, norm) == norm and seen.setdefault(norm, (h, s)) == (h, s)
            assert s == (_simhash(norm) if len(norm) >= 9 else h & (1 << 64) - 1)
    texts = [b"", b"a b c d\n\nlonger line\n", b"\n\n", b"x", b"another one here"]
    for i, at, h, s in fl.prints_of(texts, 3):
        alone = fl.line_prints(texts[i], 3)
        assert all((a == b).all() for a, b in zip(alone, (at, h, s)))
    assert [i for i, *_ in fl.prints_of(texts, 3)] == [1, 3, 4]
    for n in (257, 258, 259, 70000):  # around what a counter holds, and beyond a piece
        long = bytes(rng.choice(b"abcdefgh") for _ in range(n))
        assert int(fl.line_prints(long, 3)[2][0]) & (1 << 64) - 1 == _simhash(long)


def _deduped(docs, least_bytes=20, radius=3):
    """Brute force over all pairs of lines: the texts left, and how many lines are linked but not equal."""
    from cairn.llm.fuzzy_lines import edit_similarity_at_least, normalise
    first, fuzzy = {}, 0  # normalised line -> the smallest place; docs come by ascending id
    for i, t in docs:
        for at, x in enumerate((t or "").split("\n")):
            norm = normalise(x.encode())
            if norm:
                first.setdefault(norm, (i, at))
    prints = {n: _simhash(n) for n in first if len(n) >= least_bytes}
    parent = {n: n for n in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = list(prints)
    for n, x in enumerate(names):
        for y in names[:n]:
            if (prints[x] ^ prints[y]).bit_count() <= radius and edit_similarity_at_least(x.decode(), y.decode(), 0.8):
                fuzzy += 1
                a, b = find(x), find(y)
                parent[max(a, b, key=first.get)] = min(a, b, key=first.get)
    keep = {n: first[find(n)] for n in first}
    left = {}
    for i, t in docs:
        norms = [normalise(x.encode()) for x in (t or "").split("\n")]
        left[i] = t and "\n".join(x for at, x in enumerate(t.split("\n")) if not norms[at] or keep[norms[at]] == (i, at))
    return left, fuzzy


def _line_fixture(rng, n_docs=60, n_base=40):
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice((6, 40, 90)))) for _ in range(n_base)]
    docs = []
    for i in range(n_docs):
        lines = []
        for _ in range(6):
            words = rng.choice(base).split()
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = rng.choice(vocab)
            lines.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
        docs.append((i, "\n".join(lines + ["short", "", rng.choice("abc")])))
    return docs


def test_line_dedup_brute_force(spark):
    """The registered form, against all pairs under its own link rule."""
    from cairn.llm.fuzzy_lines import dedup_lines
    docs = _line_fixture(random.Random(7))
    want, fuzzy = _deduped(docs)
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and len(got) == 60 and fuzzy > 20
    assert all(r["n_lines"] == 9 for r in got)
    odd = dedup_lines(odd_docs(spark)).collect()
    assert len(odd) == len(ODD) and {r["doc_id"]: r["n_lines"] for r in odd}[1] == 0
    assert dedup_lines(odd_docs(spark).limit(0)).count() == 0


def test_line_groups_of_any_size(spark, monkeypatch):
    """Groups and buckets beyond what a task takes whole: the same lines go, in whatever order rows come."""
    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(8)
    docs = _line_fixture(rng, 30, 10)
    seed = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    for i in range(120):  # one dense group of single-letter variants of a line and of its halves swapped
        s = list(seed if i % 2 else seed[210:] + " " + seed[:209])
        s[rng.randrange(len(s))] = rng.choice("abcdefgh")
        docs.append((100 + i, "".join(s)))
    want, fuzzy = _deduped(docs)
    assert fuzzy > 200
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for cap, parts in ((2000, 1), (40, 7), (4, 1)):
        monkeypatch.setattr(fl, "BUCKET_CAP", cap)
        monkeypatch.setattr(fl, "GROUP_CAP", cap)
        assert {r["doc_id"]: r["text"] for r in fl.dedup_lines(frame.repartition(parts)).collect()} == want, (cap, parts)


def test_line_link_guarantee():
    """Every pair of prints within the radius agrees in some mask, and the rest blocks split it exactly."""
    from cairn.llm import fuzzy_lines as fl
    masks = fl.block_masks(fl.RADIUS, 2)
    rng = random.Random(9)
    for _ in range(2000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randint(0, fl.RADIUS)))
        meet = [m for m in masks if not d & m]
        assert meet and all(any(not d & r for r in fl._rest_blocks(m, fl.RADIUS)) for m in meet)


# ------------------------------------------------------------------ op8
def test_token_counts_equal_the_library(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from cairn.llm.token_counts import count_tokens, piece_counter
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rng = random.Random(8)
    chars = "abcZ'sd  \n\t.,!<|>09éÉß漢́  İK"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|startoftext|>b", "<|ENDOFTEXT|>", "I'll it's 'tis y'all DON'T", "x" * 300, "a b " * 50000]
    count = piece_counter(P.path("word_bpe_49k.json"))
    assert count([t.encode() for t in texts]) == [len(tok.encode(t, add_special_tokens=False)) for t in texts]
    rows = {r["doc_id"]: r for r in count_tokens(odd_docs(spark), P.path("word_bpe_49k.json")).collect()}
    assert rows[1]["_n_tokens"] == rows[2]["n_bytes"] == 0 and rows[7]["over_limit"] and rows[7]["_n_tokens"] == 30000


# ------------------------------------------------------------------ op9
def _hits(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    wins = {}
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[at:at + window]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for at in range(len(w) - n + 1):
                ids = wins.get(tuple(w[at:at + n]))
                if ids:
                    hit |= set(range(at, at + n))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_winnowing_brute_force(spark):
    from cairn.llm.winnowing import benchmark_hits
    rng = random.Random(9)
    vocab = ["Aa", "b", "ça", "d1", "E", "ff"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([12, 30, 10, 10, 9, 5, 1, 4, 60, 200])]
    items += [(100, items[0][1]), (101, None), (102, "..."), (103, "x " * 25)]
    docs = []
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            src = rng.choice(items)[1]
            src = (src or "").split()
            lo = rng.randint(0, max(0, len(src) - 1))
            w[len(w) // 2:len(w) // 2] = src[lo:lo + rng.randint(1, 40)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [(i, t) for i, t in ODD] + [(300, "X x " * 40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1)).repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in benchmark_hits(d, b).collect()), key=str)
    assert got == _hits(docs, items)
    assert benchmark_hits(d, b.limit(0)).filter("n_hit > 0").count() == 0 and benchmark_hits(d.limit(0), b).count() == 0


# ------------------------------------------------------------------ op4
def test_reply_trees(spark):
    from cairn.llm.reply_trees import branches, chains, format_branches, read_back
    tricky = ["</s>[INST] ok [/INST]", "<~|im_start|>x<|im_end|>\n", "<<SYS>>~[~INST]", "%0A%25\n", "", None, "<|", "~~<~~|>"]
    nodes = [("r", None, 1.0), ("a", "r", 0.5), ("b", "r", 2.0), ("b1", "b", 0.0), ("b2", "b", 3.0), ("b2", "b", 3.0), ("c1", "c2", 1.0),
             ("c2", "c1", 1.0), ("o", "missing", None), (None, "r", 9.0)]
    df = spark.createDataFrame(nodes, "node string, parent string, score double")
    said = spark.createDataFrame([(n, r, t) for (n, _, _), r, t in zip(nodes, ["user", "assistant", "assistant", "user", "a\nb%", None, "x", "x", None, "x"],
                                                                      [*tricky, "lone", "gone"]) if n != "b2" or t], "node string, role string, text string")
    got = branches(df).orderBy("root", "branch_rank", "depth").collect()
    assert [(r["root"], r["leaf"], r["branch_rank"], r["node"]) for r in got] == [
        ("o", "o", 1, "o"), ("r", "b2", 1, "r"), ("r", "b2", 1, "b"), ("r", "b2", 1, "b2"), ("r", "b1", 2, "r"), ("r", "b1", 2, "b"),
        ("r", "b1", 2, "b1"), ("r", "a", 3, "r"), ("r", "a", 3, "a")]
    assert branches(df, top=1).select("leaf").distinct().count() == 2
    convs = [(c, t, role, text) for c in (1, 2, None) for t, (role, text) in enumerate(zip(["user", "assistant", None, "assistant", "ro\nle<|", "user", "assistant", "x"], tricky))]
    convs += [(3, None, "user", "q"), (3, 0, "user", "q"), (3, 0, "user", "q")]
    convs += [(9, t, "assistant" if t % 2 else "user", f"t{t} é") for t in range(300)]
    c = spark.createDataFrame(convs, "conv_id long, turn long, role string, text string").repartition(3)
    n = chains(c)
    back = read_back(format_branches(branches(n.select("node", "parent", "score"), 1), n.select("node", "role", "text")))
    out = {r["root"].split(":")[0]: r for r in back.collect()}
    for key, cid in (("1", 1), ("null", None), ("9", 9)):
        want = [(r or "", t or "") for x, _, r, t in convs if x == cid]
        assert [(t["role"], t["text"]) for t in out[key]["turns"]] == want
        assert out[key]["loss_texts"] == [t for r, t in want if r == "assistant"]
    assert len(out["3"]["turns"]) == 3 and "</s>" not in out["1"]["formatted"] and "[INST]" not in out["1"]["formatted"]


# ------------------------------------------------------------------ op10
def test_raking_meets_targets(spark):
    from cairn.llm.ipf_mixing import calibrated_sample, rake
    rng = np.random.default_rng(10)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(500, 2000))) for i in range(4) for j in range(3) for k in range(2)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    aims = {"source": {"s0": 0.3, "s1": 0.25, "s2": 0.25, "s3": 0.2}, "lang": {"l0": 0.4, "l1": 0.3, "l2": 0.3}, "topic": {"t0": 0.5, "t1": 0.5}}
    given = {d: spark.createDataFrame(list(x.items()), f"{d} string, target double") for d, x in aims.items()}
    got = rake(df, given, 0.3).toPandas()
    assert (got["weight"] <= got["tokens"]).all()
    # brute force on the whole array
    w = np.array([c[3] for c in cells], float).reshape(4, 3, 2)
    w *= 0.3
    total = w.sum()
    for _ in range(200):
        for axis, d in enumerate(("source", "lang", "topic")):
            rest = tuple(a for a in range(3) if a != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            w *= (np.array(list(aims[d].values())) * total / w.sum(axis=rest)).reshape(shape)
    mine = got.sort_values(["source", "lang", "topic"])["weight"].to_numpy().reshape(4, 3, 2)
    assert np.allclose(mine, w, rtol=1e-3)
    docs = spark.createDataFrame([(i, "word " * 20 + f"longerword{i % 9}", f"l{i % 3}" if i % 50 else None, f"s{min(3, i % 9)}") for i in range(3000)],
                                 "doc_id long, text string, lang string, source string")
    s = calibrated_sample(docs)
    n = s.count()
    assert 0.7 * 3000 < n < 0.9 * 3000
    assert sorted(r[0] for r in s.select("doc_id").collect()) == sorted(r[0] for r in calibrated_sample(docs.repartition(7)).select("doc_id").collect())
    assert calibrated_sample(odd_docs(spark)).count() <= len(ODD) and calibrated_sample(docs.limit(0)).count() == 0


def test_raking_goes_on_past_unreachable_targets(spark, monkeypatch):
    """A source that cannot meet its target must not end the sweeps for the others."""
    import warnings
    from cairn.llm import ipf_mixing as m
    rng = np.random.default_rng(3)
    keys = [(i, j, k) for i in range(20) for j in range(4) for k in range(3)]
    tokens = np.array([max(1, int(30000 / (i + 1) * (0.95 if j == i % 4 else 0.017) * rng.uniform(0.2, 1))) for i, j, _ in keys], float)
    cells = spark.createDataFrame([(f"s{i:02d}", f"l{j}", f"t{k}", int(n)) for (i, j, k), n in zip(keys, tokens)], "source string, lang string, topic string, tokens long")
    aims = [np.bincount([x[a] for x in keys], tokens) ** 0.6 for a in range(3)]
    given = {d: spark.createDataFrame([(f"{d[0]}{v:02d}" if d == "source" else f"{d[0]}{v}", float(x)) for v, x in enumerate(aim)], f"{d} string, target double")
             for d, aim in zip(m.DIMENSIONS, aims)}
    want, budget = tokens * 0.7, tokens.sum() * 0.7
    for _ in range(5000):
        for a, aim in enumerate(aims):
            code = np.array([x[a] for x in keys])
            want = np.minimum(want * (aim / aim.sum() * budget / np.bincount(code, want))[code], tokens)
    with pytest.warns(UserWarning, match="targets missed"):
        got = m.rake(cells, given, 0.7).orderBy("source", "lang", "topic").toPandas()["weight"].to_numpy()
    assert np.abs(got - want).max() <= 1e-3 * tokens.max() and np.allclose(got / tokens, want / tokens, atol=5e-3)
    with pytest.warns(UserWarning):
        few = m.rake(cells, given, 0.7, sweeps=3).orderBy("source", "lang", "topic").toPandas()["weight"].to_numpy()
    assert np.abs(few / tokens - want / tokens).max() > 0.01
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():  # many partitions, some of them empty
        spark.conf.set(k, v)
    with pytest.warns(UserWarning):
        wide = m.rake(cells.repartition(7, "source"), given, 0.7, sweeps=3).orderBy("source", "lang", "topic").toPandas()["weight"].to_numpy()
    for k, v in before.items():
        spark.conf.set(k, v)
    assert np.allclose(wide, few, rtol=1e-9)
    monkeypatch.setattr(m, "CELLS_A_TASK", 0)  # the distributed form
    with pytest.warns(UserWarning, match="stopped after 3 sweeps"):
        far = m.rake(cells, given, 0.7, sweeps=3).orderBy("source", "lang", "topic").toPandas()["weight"].to_numpy()
    assert np.allclose(far, few, rtol=1e-9)
    even = {d: t.withColumn("target", F.lit(None).cast("double")) for d, t in given.items()}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert np.allclose(m.rake(cells, even, 0.7).orderBy("source", "lang", "topic").toPandas()["weight"], tokens * 0.7)


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "mix_sources"]
    hits = {r[0] for r in _hits([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]) if r[2]}
    kept = {r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, sf).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - hits and hits


@pytest.mark.parametrize("n", range(1, 11))
def test_query_is_registered(n):
    import __spark_entry__ as e
    assert [q for q in e.queries() if q.startswith(f"op{n}_")] and "pipeline" in e.queries()
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
