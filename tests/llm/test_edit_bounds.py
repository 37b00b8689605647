"""Line dedup: the cheap bounds before the edit table lose no link and spare far lines the table."""

import random

import numpy as np


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _edited(rng: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        out[at:at + rng.randrange(2)] = rng.choice(["", "x", "é"])
    return "".join(out)


def test_bounds_agree_with_the_table():
    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(3)
    for size in (4, 40, 130, 260):
        for _ in range(40):
            a = "".join(rng.choice("abc é") for _ in range(size))
            b = _edited(rng, a, rng.randrange(size // 3 + 1)) if rng.random() < 0.8 else "".join(rng.choice("abc é") for _ in range(size))
            far = _distance(a, b)
            allowed = int(0.2 * max(len(a), len(b)) + 1e-9)
            assert fl.edit_similarity_at_least(a, b, 0.8) == (far <= allowed)
            assert fl._script_cost(a, b, allowed) >= min(far, allowed + 1)
            if fl._apart(a, b, allowed):
                assert far > allowed
            if far <= allowed:
                assert fl._Grams([a, b], 0.8).possible(0, np.array([1])) == [1]


def test_far_lines_of_a_group_are_not_compared(monkeypatch):
    """Lines whose prints are near by chance but whose letter pairs differ never reach the edit comparison."""
    import pandas as pd

    from cairn.llm import fuzzy_lines as fl
    calls = []
    was = fl.edit_similarity_at_least
    monkeypatch.setattr(fl, "edit_similarity_at_least", lambda *a: calls.append(a) or was(*a))
    texts = [c * 60 + d * 60 for c in "abcdef" for d in "ghijkl"] + ["a" * 60 + "g" * 58]
    pdf = pd.DataFrame({"h": range(len(texts)), "sim": 0, "root": 1, "norm": texts})
    got = pd.concat(fl._grouped(3, 0.8)(iter([pdf])))
    assert sorted(got["h"]) == [0, 36]
    assert len(calls) == 1


def test_pairs_judged_together_agree_with_the_table():
    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(5)
    pairs = []
    for size in (90, 100, 260, 700):
        for _ in range(30):
            a = "".join(rng.choice("abcdefgh é") for _ in range(size))
            b = _edited(rng, a, rng.randrange(size // 2)) if rng.random() < 0.6 else "".join(rng.choice("abcdefgh é") for _ in range(size + rng.randrange(size // 8)))
            allowed = int(0.2 * max(len(a), len(b)) + 1e-9)
            if abs(len(a) - len(b)) <= allowed:
                pairs.append((a, b, allowed))
    pairs += [("x" * 120, "x" * 130, 26), ("", "", 0), ("ab", "ba", 1)]
    far = fl.far_pairs([p[:2] for p in pairs], np.array([p[2] for p in pairs]))
    assert far.sum() > 20
    for (a, b, allowed), gone in zip(pairs, far.tolist()):
        if gone:
            assert _distance(a, b) > allowed


def test_lines_of_like_letter_pairs_skip_the_whole_table(monkeypatch):
    """Lines of one vocabulary share their letter pairs: their first columns are judged together, and few
    whole tables are filled; copies with many edits are still linked, in a group and across its flushes."""
    import pandas as pd

    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(7)
    words = ["ción", "que", "mente", "osa", "ll", "ie", "ado", "rr", "ez", "de", "la"]
    texts = ["".join(rng.choice(words) for _ in range(80)) for _ in range(60)]
    copies = []
    for text in texts[:6]:
        out = list(text)
        for at in range(0, len(out), 8):
            out[at] = "#"
        copies.append("".join(out))
    texts += copies
    tables, scalars = [], []
    table, apart = fl._in_table, fl._apart
    monkeypatch.setattr(fl, "_in_table", lambda *a: tables.append(a) or table(*a))
    monkeypatch.setattr(fl, "_apart", lambda *a: scalars.append(a) or apart(*a))
    pdf = pd.DataFrame({"h": range(len(texts)), "sim": 0, "root": 1, "norm": texts})
    want = {frozenset((i, 60 + i)) for i in range(6)}
    parts = []
    for pending in (fl._PENDING, 50):
        monkeypatch.setattr(fl, "_PENDING", pending)
        got = pd.concat(fl._grouped(3, 0.8)(iter([pdf])))
        parts.append({frozenset(x) for x in got.groupby("root")["h"].agg(list)})
    assert parts == [want, want]
    assert len(scalars) < 400 and len(tables) < 60  # of some 4,000 pairs


def test_a_task_without_any_link_ends(spark):
    """Halves that change places leave nearly the same windows and so near prints, but unlike lines: the
    group is judged, nothing is linked, and its task gives no row."""
    from cairn.llm import fuzzy_lines as fl
    rng = random.Random(3)
    one, two = (" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(150)) for _ in range(2))
    swapped = [f"{one} {two}", f"{two} {one}"]
    near = [int(sim[0]) for _, _, _, sim in fl.prints_of([x.encode() for x in swapped], 20)]
    assert (near[0] ^ near[1]).bit_count() <= fl.RADIUS and not fl.edit_similarity_at_least(*swapped, 0.8)
    got = fl.dedup_lines(spark.createDataFrame(list(enumerate(swapped)), "doc_id long, text string"))
    assert {tuple(r) for r in got.select("doc_id", "text", "n_dropped").collect()} == {(i, x, 0) for i, x in enumerate(swapped)}
    # beside a group that has a link
    docs = [*enumerate(swapped), (2, one), (3, one[:-1] + "#")]
    got = fl.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: (r["text"], r["n_dropped"]) for r in got.collect()} == {0: (swapped[0], 0), 1: (swapped[1], 0), 2: (one, 0), 3: ("", 1)}
