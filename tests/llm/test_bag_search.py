"""Ranked lexical search against the formula evaluated for every document and item."""

import math
import random
import re

import pytest

from cairn.llm import bag_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (4, "One two"), (None, "two null"), (None, None), (6, "É́ ß İ 漢字  x\u0085y"), (7, "two " * 30000), (8, "a" * 50000),
       (9, "one-two_three{four}~five"), (10, "ONE one"), (11, "İstanbul K")]


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in set(items):
        found = []
        for i, w in bags:
            m = 100 - 75 + (75 * len(w) * n_docs) // n_terms if w else 0
            score = 0
            for t in terms(text):
                tf = w.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, TERMS string, n int, score int").repartition(3)
    return d, spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, ID int")


def check(spark, docs, items, **kw):
    got = bag_search.ranked(*frames(spark, docs, items), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, items, **kw)


def test_odd_rows(spark):
    check(spark, ODD, [(1, "two ONE two x y"), (2, None), (3, "nowhere found"), (None, "one"), (5, "É ß 漢字 istanbul k"), (5, "three"), (5, "three"), (6, "")])


def test_copies_and_ties(spark):
    """A third of the rows has one text, another third differs from it outside the vocabulary only."""
    rng = random.Random(4)
    docs = [(i, "alpha beta") for i in range(300)] + [(i, f"beta w{i}") for i in range(300, 600)]
    docs += [(i, " ".join(rng.choices("alpha beta gamma delta eps zeta".split(), k=rng.randint(0, 9)))) for i in range(600, 900)]
    rng.shuffle(docs)
    items = [(j, " ".join(rng.choices("alpha beta gamma delta eps zeta eta".split(), k=rng.randint(0, 6)))) for j in range(30)]
    check(spark, docs, items)
    check(spark, docs, items, k=3)


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(bag_search, "ITEM_TERMS", 7)
    monkeypatch.setattr(bag_search, "PRODUCTS", 16)
    monkeypatch.setattr(bag_search, "SLICE", 5)
    rng = random.Random(5)
    docs = [(i, " ".join(f"t{int(rng.paretovariate(0.6)) % 40}" for _ in range(rng.randint(0, 30)))) for i in range(200)]
    check(spark, docs, [(j, " ".join(f"t{rng.randint(0, 40)}" for _ in range(5))) for j in range(20)])


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_nothing_to_find(spark, docs, items):
    d, i = frames(spark, docs or [(1, "a")], items or [(1, "a")])
    assert bag_search.ranked(d if docs else d.filter("false"), i if items else i.filter("false")).count() == 0
