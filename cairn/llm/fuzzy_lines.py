"""Fuzzy line dedup: SimHash of normalised lines, join on pigeonhole blocks, edit similarity, one
occurrence kept per connected group.

Equal normalised lines are one node from the start. Two fingerprints within ``radius`` bits agree in at
least ``agree`` of ``agree + radius`` blocks, so they meet in the table of those blocks. Tables see
fingerprints only and give the groups of prints that the radius connects. Only the lines of such groups
are looked up in the texts, each once, and compared inside their group: a link needs both the radius and
an edit similarity of at least ``similarity``. Groups too large for a task go through the tables again
with their lines, by the same rule."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, broadcast_if_small, components, cut, free_name
from cairn.llm.covering_simhash import linked

SLOTS = 1 << 23    # bits, 1 MB: the bound of what is sent to every task
BUCKET_CAP = 2000      # larger buckets are split by one more block; none is cut short
GRAM = 4               # bytes of a window of a line
RADIUS = 3             # bits in which linked lines may differ
GROUP_CAP, GROUP_BYTES = BUCKET_CAP, 16 << 20  # groups of more lines or more text go through the tables
PAIRED = 32            # prints of a bucket up to which all its pairs are compared at once
_SEEN = 200_000        # texts a task remembers
_COUNTED = 2000        # texts whose letter pairs are kept counted, 4 KB each
_CHECKED = 16          # allowed edits from which the first columns are judged alone
_PENDING, _PENDING_LETTERS = 16384, 32 << 20  # pairs, and their letters, that wait to be judged together
_TOGETHER = 8          # pairs from which judging together is cheaper than one by one
_CODES = 64            # letters are taken modulo this there: that lowers distances only
_WORDS = 4096          # words of rows that take a step at once
_STEPS = (1.5, 2.0)  # columns, in allowed edits, after which far pairs leave
_RUN, _SKIPS = 12, (0, 1, 2, 4, 8, 16, 32)  # equal letters at which an edit script goes on, and how far it looks for them
_PIECE = 1 << 19       # bytes of short texts that go through the arithmetic together
_WINDOWS = 1 << 16     # windows whose bits are counted at a time
_COUNTER = 255         # what a counter of one byte holds
_FACTOR = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def normalise(line: bytes) -> bytes:
    """Lower-cased (A-Z), digits as 0, white space as single spaces."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def block_masks(radius: int, agree: int) -> list[int]:
    """One mask per choice of ``agree`` out of ``agree + radius`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, agree + radius + 1).round().astype(int).tolist()
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _allowed(longest: int, least: float) -> int:
    return int((1.0 - least) * longest + 1e-9)


def edit_similarity_at_least(a: str, b: str, least: float, defer: bool = False) -> bool | None:
    """1 - Levenshtein / longer length >= least; bit-parallel over the longer string's columns, after
    equal ends are stripped and the lengths alone have been judged. With ``defer``, None where only the
    edit table of long strings could tell."""
    allowed = _allowed(max(len(a), len(b)), least)
    if abs(len(a) - len(b)) > allowed:
        return False
    a, b = _stripped(a, b)
    if not a or not b or max(len(a), len(b)) <= allowed:
        return max(len(a), len(b)) <= allowed
    if _script_cost(a, b, allowed) <= allowed:
        return True
    if allowed >= _CHECKED:
        if defer:
            return None
        if _apart(a, b, allowed):
            return False
    return _in_table(a, b, allowed)


def _stripped(a: str, b: str) -> tuple[str, str]:
    """Both without their equal ends."""
    lo, top = 0, min(len(a), len(b))
    while lo < top and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < top - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    return a[lo:len(a) - end], b[lo:len(b) - end]


def _in_table(a: str, b: str, allowed: int) -> bool:
    """Whether the edit distance is at most ``allowed``, by the whole table."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, score = full, 0, len(a)
    for j, ch in enumerate(b):
        eq = where.get(ch, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        if score - (len(b) - 1 - j) > allowed:
            return False
        ph = (ph << 1 | 1) & full
        mh = mh << 1 & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
    return score <= allowed


def far_pairs(pairs: list[tuple[str, str]], allowed: np.ndarray) -> np.ndarray:
    """Which pairs the first columns of their edit tables alone show to be farther than ``allowed``: the
    rule of ``_apart`` for many pairs at once, in words of 64 rows. What is not marked is undecided."""
    size = np.array([(len(a), len(b)) for a, b in pairs], np.int64)
    far = np.zeros(len(pairs), bool)
    order = np.argsort(allowed, kind="stable")
    lo = 0
    while lo < len(order):  # pairs of about the same number of allowed edits share the columns
        top = int(allowed[order[lo]]) * 5 // 4
        words = int((_STEPS[-1] + 1) * top) + 64 >> 6
        hi = min(int(np.searchsorted(allowed[order], top, "right")), lo + max(1, _WORDS // words))
        part = order[lo:hi]
        if len(part) >= _TOGETHER and int(allowed[part[0]]):
            far[part] = _far_together([pairs[i] for i in part.tolist()], size[part], allowed[part])
        lo = hi
    return far


def _coded(texts: list[str], size: int) -> np.ndarray:
    """(text, letter) codes of the first ``size`` letters; what stands behind a text's end is never read."""
    letters = "".join(t[:size].ljust(size) for t in texts).encode("utf-32-le", "surrogatepass")
    return (np.frombuffer(letters, np.uint32).reshape(len(texts), size) & np.uint32(_CODES - 1)).astype(np.int64)


def _far_together(pairs: list[tuple[str, str]], size: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """The tables are filled slantwise, a word of rows one column behind the word above it, so that all words
    of all pairs take a step at once."""
    most, columns = int(allowed.max()), int(size[:, 1].min())
    steps = sorted({min(columns, int(s * most)) for s in _STEPS})
    n_words = min(int(size[:, 0].max()), steps[-1] + most) + 63 >> 6
    one, high, live = np.uint64(1), np.uint64(63), np.arange(len(pairs))
    words = np.arange(n_words)[:, None] * (len(pairs) * _CODES) + live * _CODES  # place of a word's and pair's codes
    rows = _coded([a for a, _ in pairs], 64 * n_words).reshape(len(pairs), n_words, 64)
    where = np.zeros(n_words * len(pairs) * _CODES, np.uint64)  # bits of the rows that have a code
    np.add.at(where, (rows + words.T[:, :, None]).ravel(), np.tile(one << np.arange(64, dtype=np.uint64), n_words * len(pairs)))
    letters = np.ascontiguousarray(_coded([b for _, b in pairs], steps[-1]).T)
    plus, minus = np.full((n_words, len(pairs)), ~np.uint64(0)), np.zeros((n_words, len(pairs)), np.uint64)
    far, done = np.zeros(len(pairs), bool), 0
    for step in steps:
        up, down = np.ones((n_words + 1, len(live)), np.uint64), np.zeros((n_words + 1, len(live)), np.uint64)  # into a word's first row
        for at in range(done, step + n_words - 1):
            lo, hi = max(0, at - step + 1), min(n_words, at - done + 1, (at + most) // 65 + 1)  # rows farther off than the allowed edits wait
            if lo >= hi:
                continue
            pv, mv = plus[lo:hi], minus[lo:hi]
            eq = where.take(letters[at - hi + 1:at - lo + 1][::-1] + words[lo:hi])
            xv = eq | mv
            eq |= down[lo:hi]
            xh = eq & pv
            xh += pv
            xh ^= pv
            xh |= eq
            mh = pv & xh
            xh |= pv
            ph = np.invert(xh, out=xh)
            ph |= mv
            np.right_shift(ph, high, out=eq)
            ph <<= one
            ph |= up[lo:hi]
            up[lo + 1:hi + 1] = eq
            np.right_shift(mh, high, out=eq)
            mh <<= one
            mh |= down[lo:hi]
            down[lo + 1:hi + 1] = eq
            np.bitwise_and(ph, xv, out=mv)
            xv |= ph
            np.invert(xv, out=xv)
            np.bitwise_or(mh, xv, out=pv)
        done = step
        used = min(n_words, done + most + 63 >> 6)
        bits = [np.unpackbits(np.ascontiguousarray(x[:used].T).view(np.uint8), axis=1, bitorder="little").view(np.int8) for x in (plus, minus)]
        column = np.full((len(live), 64 * used + 1), done, np.int32)
        column[:, 1:] += np.cumsum(bits[0] - bits[1], axis=1, dtype=np.int32)
        place = np.arange(64 * used + 1, dtype=np.int32)
        column += np.abs((size[live, 0] - size[live, 1] + done).astype(np.int32)[:, None] - place)
        column[place > size[live, 0][:, None]] = np.iinfo(np.int32).max
        near = column.min(axis=1) <= allowed[live]
        far[live[~near]] = True
        live, words = live[near], words[:, near]
        if not len(live):
            break
        letters, plus, minus = (np.ascontiguousarray(x[:, near]) for x in (letters, plus, minus))
    return far


def _apart(a: str, b: str, allowed: int) -> bool:
    """Whether the first columns of the edit table alone show that the distance is over ``allowed``: every
    way through it passes the last of them, at a value (given by the bits of their differences) to which the
    difference of the lengths that are left is added. Rows farther than ``allowed`` from it are left out."""
    done = allowed + allowed // 2
    rows = done + allowed
    if rows >= min(len(a), len(b)):
        return False
    where: dict[str, int] = {}
    for i, ch in enumerate(a[:rows]):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << rows) - 1
    plus, minus = full, 0
    for ch in b[:done]:
        eq = where.get(ch, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = (minus | ~(xh | plus) & full) << 1 & full | 1
        plus, minus = (plus & xh) << 1 & full | ~(xv | ph) & full, ph & xv
    up, down = (np.unpackbits(np.frombuffer(x.to_bytes(rows + 7 >> 3, "little"), np.uint8), count=rows, bitorder="little").view(np.int8) for x in (plus, minus))
    column = np.concatenate((np.zeros(1, np.int64), np.cumsum(up - down, dtype=np.int64))) + done
    return int((column + np.abs(len(a) - np.arange(rows + 1) - (len(b) - done))).min()) > allowed


def _script_cost(a: str, b: str, allowed: int) -> int:
    """The cost of one edit script found by skipping to the next common run, ``allowed + 1`` if there is
    none as cheap: the distance is at most this."""
    i = j = cost = 0
    while i < len(a) and j < len(b):
        step = 64
        while step:  # equal as far as it goes
            if i + step <= len(a) and a[i:i + step] == b[j:j + step]:
                i, j = i + step, j + step
            else:
                step >>= 1
        if i == len(a) or j == len(b):
            break
        for skip in _SKIPS:
            run = a[i + skip:i + skip + _RUN]
            at = b.find(run, j, j + 2 * skip + 2 * _RUN) - j if len(run) == _RUN else -1
            if at >= 0:
                break
        else:
            break
        while skip and at and a[i + skip - 1] == b[j + at - 1]:
            skip, at = skip - 1, at - 1
        cost += max(skip, at)
        if cost > allowed:
            return allowed + 1
        i, j = i + skip, j + at
    return min(allowed + 1, cost + max(len(a) - i, len(b) - j))


class _Grams:
    """Counts of the letter pairs of a group's texts, in hashed bins: an edit takes at most two of them away,
    so texts with too few in common are not compared (no text that is similar enough is lost)."""

    def __init__(self, texts: list[str], least: float):
        self.texts, self.least, self.counts = texts, least, {}
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))

    def of(self, x: int) -> np.ndarray:
        if x not in self.counts:
            if len(self.counts) >= _COUNTED:
                self.counts.clear()
            letters = np.frombuffer(self.texts[x].encode("utf-32-le", "surrogatepass"), np.uint32)
            pairs = (letters[:-1] * np.uint32(0x9E3779B1) + letters[1:]) * np.uint32(0x85EBCA6B)
            pairs = (pairs ^ pairs >> np.uint32(15)) * np.uint32(0x9E3779B1) >> np.uint32(22)
            self.counts[x] = np.bincount(pairs, minlength=1024).astype(np.int32)
        return self.counts[x]

    def possible(self, x: int, others: np.ndarray) -> list[int]:
        longest = np.maximum(self.sizes[others], self.sizes[x])
        allowed = ((1.0 - self.least) * longest + 1e-9).astype(np.int64)
        of_length = np.abs(self.sizes[others] - self.sizes[x]) <= allowed
        if not of_length.any():
            return []
        mine, needed = self.of(x), longest - 1 - 2 * allowed
        return [y for y, least in zip(others[of_length].tolist(), needed[of_length].tolist()) if int(np.minimum(mine, self.of(y)).sum()) >= least]


def _top(up, x):
    """The root of x in a union-find forest."""
    while up[x] != x:
        up[x] = x = up[up[x]]
    return x


class _Pairs:
    """Links of one task's groups: lines within the radius, possible by their letter pairs and similar. A
    group grows one component at a time and a line that has been reached is not compared again, so a dense
    group costs about one comparison a line. Pairs that only an edit table can judge wait and are judged
    together, across groups: most of them are far, which a part of their tables shows."""

    def __init__(self, radius: int, least: float):
        self.radius, self.least = radius, least
        self.waiting: list[tuple] = []  # two texts, their names
        self.letters = 0
        self.up: dict = {}  # what has been linked while they wait
        self.out: list[tuple] = []

    def group(self, names: list, sims: np.ndarray, texts: list[str], earlier: list[np.uint64] = ()) -> None:
        """Takes in a group; pairs of lines that agree under a mask of ``earlier`` are left to its table."""
        grams = _Grams(texts, self.least)
        pool, todo, here, reached = np.arange(len(names)), [], {}, set()
        while len(pool) > (not todo):
            if not todo:
                todo, pool = [int(pool[0])], pool[1:]
                reached = {names[todo[0]]}
            x = todo.pop()
            differ = sims[pool] ^ sims[x]
            new = np.bitwise_count(differ) <= self.radius
            if earlier and new.any():
                for m in earlier:
                    new &= (differ & m) != 0
            hit = []
            for y in grams.possible(x, pool[new]):
                similar = edit_similarity_at_least(texts[x], texts[y], self.least, True)
                if similar:
                    hit.append(y)
                    self._link(names[x], names[y])
                elif similar is None:
                    self.waiting.append((texts[x], texts[y], names[x], names[y]))
                    self.letters += len(texts[x]) + len(texts[y])
                    here[names[y]] = y
            if len(self.waiting) >= _PENDING or self.letters >= _PENDING_LETTERS:
                reached.update(names[y] for y in hit)
                linked_now = [here[b] for a, b in self.judge() if a in reached and b in here]
                hit = np.intersect1d([*hit, *linked_now], pool).tolist()
                here = {}
            if hit:
                todo += hit
                reached.update(names[y] for y in hit)
                stay = np.ones(len(pool), bool)
                stay[np.searchsorted(pool, hit)] = False
                pool = pool[stay]

    def judge(self) -> list[tuple]:
        """The links among the pairs that wait."""
        waiting, self.waiting, self.letters = self.waiting, [], 0
        allowed = np.array([_allowed(max(len(a), len(b)), self.least) for a, b, _, _ in waiting], np.int64)
        far = far_pairs([(a, b) for a, b, _, _ in waiting], allowed)
        got = []
        for i in np.flatnonzero(~far).tolist():
            a, b, x, y = waiting[i]
            if _top(self.up, self.up.setdefault(x, x)) != _top(self.up, self.up.setdefault(y, y)) and self._near(a, b, int(allowed[i])):
                self._link(x, y)
                got.append((x, y))
        self.up = {}
        return got

    def _link(self, x, y) -> None:
        self.out.append((x, y))
        x, y = (_top(self.up, self.up.setdefault(z, z)) for z in (x, y))
        self.up[y] = x

    @staticmethod
    def _near(a: str, b: str, allowed: int) -> bool:
        a, b = _stripped(a, b)
        return not _apart(a, b, allowed) and _in_table(a, b, allowed)

    def links(self) -> list[tuple]:
        """What has been linked since the last call."""
        if self.waiting:
            self.judge()
        out, self.out = self.out, []
        return out


def _full_add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three words, bit by bit."""
    odd = a ^ b
    return odd ^ c, a & b | odd & c


def _bit_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 15 words of each column have each bit: (columns, 8) integers of
    eight 8-bit counters."""
    planes, level = [], list(words)
    while level:  # words of one weight become one word and carries of the next weight
        carries = []
        while len(level) > 1:
            one, carry = _full_add(*level[:3])
            level = [*level[3:], one]
            carries.append(carry)
        planes.append(np.unpackbits(level[0].view(np.uint8), bitorder="little").view(np.uint64))
        level = carries
    total = planes.pop()
    while planes:  # counters of eight bits, none of which runs over
        total += total
        total |= planes.pop()
    return total.reshape(-1, 8)


def gram_simhashes(b: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash over the ``GRAM``-byte windows, repeats included, of each line ``b[start:start + size]``
    (none is shorter than a window): a bit is 1 if more than half of the windows' hashes have it. Bits are
    counted for 15 windows at once by full adders, in parts of at most 255 windows, and then summed; a
    bounded number of windows is in hand at a time."""
    counts = sizes - GRAM + 1
    n_parts = -(-counts // _COUNTER)
    head = np.cumsum(n_parts) - n_parts
    line = np.repeat(np.arange(len(starts)), n_parts)
    done = (np.arange(len(line)) - head[line]) * _COUNTER
    size, at = np.minimum(_COUNTER, counts[line] - done), starts[line] + done
    ends = np.cumsum(size)
    ones = np.empty((len(line), 64), np.uint8)
    fill = np.zeros(15, np.uint64)
    lo = 0
    while lo < len(line):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _WINDOWS)))
        piece = np.ascontiguousarray(b[at[lo]:at[hi - 1] + size[hi - 1] + GRAM - 1])
        gram = np.ndarray((len(piece) - GRAM + 1,), f"<u{GRAM}", piece, strides=(1,)).astype(np.uint64)  # a window at every byte
        gram *= np.uint64(_FACTOR)
        h = np.concatenate((_mix(gram), fill))
        groups = -(-size[lo:hi] // 15)
        group = np.cumsum(groups) - groups
        place = np.repeat(at[lo:hi] - at[lo] - 15 * group, groups) + 15 * np.arange(int(groups.sum()))
        words = np.empty((15, len(place)), np.uint64)
        for i, row in enumerate(words):
            h[i:].take(place, out=row, mode="clip")
        last = group + groups - 1  # what lies behind a part's end does not count
        words[:, last] *= np.arange(15)[:, None] < size[lo:hi] - 15 * (groups - 1)
        ones[lo:hi] = np.add.reduceat(_bit_counts(words), group, axis=0).view(np.uint8).reshape(hi - lo, 64)
        lo = hi
    total = np.add.reduceat(ones, head, axis=0, dtype=np.int64)
    return np.packbits(2 * total > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); wraps around."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(factor: int, size: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, factor, np.uint64))))


def _runs(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the runs of bytes that make up ``letters``: a polynomial in the place within
    the run (that in the place overall, divided by the power at the run's start), mixed."""
    first = np.cumsum(sizes) - sizes
    terms = letters.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _powers(_FACTOR, len(letters))
    h = np.add.reduceat(terms, first)
    h *= _powers(pow(_FACTOR, -1, 1 << 64), len(letters))[first]
    h += sizes.astype(np.uint64)
    return _mix(h)


def line_prints(raw: bytes, least_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash of the normalised line, its SimHash; signed) of the lines of a text that are not
    empty. A line whose normalised form has less than ``least_bytes`` has its hash for a SimHash, too: it
    takes part by equality only."""
    none = (np.empty(0, np.int64),) * 3
    b = np.frombuffer(raw.lower().translate(_DIGITS) + b"\n", np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return none
    size = ends - starts + 1  # a word and what separates it from the next one
    first = np.cumsum(size) - size
    kept = ~space
    kept[ends] = True
    norm = b[kept]
    norm[first + size - 1] = 32
    line = np.searchsorted(np.flatnonzero(b == 10), starts)
    head = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))  # first word of each line
    at, sizes = first[head], np.add.reduceat(size, head) - 1
    inside = np.ones(len(norm), bool)
    inside[at + sizes] = False
    h = _runs(norm[inside], sizes)
    sim = h.copy()
    long = sizes >= max(least_bytes, GRAM)
    if long.any():
        sim[long] = gram_simhashes(norm, at[long], sizes[long])
    return line[head], h.view(np.int64), sim.view(np.int64)


def prints_of(texts: list[bytes], least_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, positions, hashes, SimHashes) of each text with such lines; short texts go through
    the arithmetic together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < _PIECE):
            size += len(texts[end])
            end += 1
        line, h, sim = line_prints(b"\n".join(texts[at:end]), least_bytes)
        first = np.cumsum([0] + [t.count(b"\n") + 1 for t in texts[at:end]])
        owner = np.searchsorted(first, line, "right") - 1
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(line)]) if len(line) else ():
            yield at + int(owner[lo]), line[lo:hi] - first[owner[lo]], h[lo:hi], sim[lo:hi]
        at = end


def _prints(least_bytes: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
            sizes = np.zeros(len(raw) + 1, np.int32)
            parts = []
            for i, *arrays in prints_of(raw, least_bytes):
                sizes[i + 1] = len(arrays[0])
                parts.append(arrays)
            at, h, sim = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
            rows = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(h), pa.array(sim)], ["at", "h", "sim"])
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), rows)

    return run


def _near_prints(radius: int):
    """Links of prints (rows sorted by bucket): all pairs within the radius of small buckets, spanning
    forests of the others."""
    def close(bucket: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        size = np.diff(np.append(first, len(bucket)))
        several = (size > 1) & (size <= PAIRED)
        bucket = np.repeat(np.arange(int(several.sum())), size[several])
        prints = sim[np.repeat(several, size)]
        a, b = [], []
        for off in range(1, PAIRED):
            one, two = prints[:-off], prints[off:]
            near = (bucket[:-off] == bucket[off:]) & (np.bitwise_count(one ^ two) <= radius)
            a.append(one[near])
            b.append(two[near])
        for lo, n in zip(first[size > PAIRED].tolist(), size[size > PAIRED].tolist()):
            x, y = linked(np.unique(sim[lo:lo + n]), radius)
            a.append(np.asarray(x, np.uint64))
            b.append(np.asarray(y, np.uint64))
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def closed() -> pa.RecordBatch:
            a, b = close(*(np.concatenate(x) for x in zip(*held))) if held else (np.empty(0, np.uint64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, sim = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            sim = sim.view(np.uint64)
            last = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on in the next batch
            if last:
                held.append((bucket[:last], sim[:last]))
            if last or held and held[-1][0][-1] != bucket[0]:
                yield closed()
                held = []
            held.append((bucket[last:], sim[last:]))
        yield closed()

    return run


def _slot(th, at):
    """Place of a line in the bitmap of wanted lines, from its text's hash and its position."""
    return F.shiftrightunsigned(th, 64 - (SLOTS.bit_length() - 1)).bitwiseXOR(at.cast("long").bitwiseAND(SLOTS - 1))


def _looked_up(bitmap: bytes):
    """Normalised lines at the places that the bitmap marks; a text that a task has just had is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(bitmap, np.uint8)
        shift = np.uint64(64 - (SLOTS.bit_length() - 1))
        seen: set[int] = set()
        for batch in batches:
            th = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows: list[tuple] = []
            for name, first, raw in zip(th.tolist(), (th.view(np.uint64) >> shift).astype(np.int64).tolist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if raw is None or name in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(name)
                slot = first ^ np.arange(raw.count(b"\n") + 1) & SLOTS - 1
                wanted = np.flatnonzero(marks[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                if len(wanted):
                    lines = raw.split(b"\n")
                    rows += [(name, i, normalise(lines[i]).decode("utf-8")) for i in wanted.tolist()]
            ths, ats, norms = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ths, pa.int64()), pa.array(ats, pa.int32()), pa.array(norms, pa.string())], ["th", "at", "norm"])

    return run


def _texts_of(lines: DataFrame, base: DataFrame) -> DataFrame:
    """``lines(h, sim, root, keep)`` with their normalised texts, read where ``keep`` points. A bitmap of a
    fixed size lets a line pass before anything is shuffled; the join then decides."""
    cells = (lines.select(_slot(F.col("keep.th"), F.col("keep.at")).alias("slot"))
             .select(F.shiftright("slot", 6).alias("cell"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect())  # at most SLOTS / 64 rows
    board = np.zeros(SLOTS // 64, "<i8")
    for r in cells:
        board[r["cell"]] = r["bits"]
    texts = base.select("th", "text").mapInArrow(_looked_up(board.tobytes()), "th long, at int, norm string")
    places = lines.select("h", "sim", "root", F.col("keep.th").alias("th"), F.col("keep.at").alias("at"))
    return texts.join(places, ["th", "at"]).dropDuplicates(["h", "sim"]).select("h", "sim", "root", "norm")


def _grouped(radius: int, least: float):
    """Components (one line's h and sim, line's h and sim) of the links inside each group (sorted by
    root)."""
    def components_of(links: list[tuple[int, int]], size: int) -> np.ndarray:
        up = list(range(size))
        for x, y in links:
            x, y = _top(up, x), _top(up, y)
            up[max(x, y)] = min(x, y)
        return np.array([_top(up, x) for x in range(size)], np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def closed() -> pd.DataFrame:
            if not held:
                return pd.DataFrame([], columns=["root", "h", "sim"])
            pdf = pd.concat(held, ignore_index=True)
            root = pdf["root"].to_numpy(np.int64)
            h, sims, texts = pdf["h"].to_numpy(np.int64), pdf["sim"].to_numpy(np.int64), pdf["norm"].tolist()
            edges = [0, *(np.flatnonzero(root[1:] != root[:-1]) + 1).tolist(), len(root)]
            pairs = _Pairs(radius, least)
            for lo, hi in zip(edges, edges[1:]):
                pairs.group(list(range(lo, hi)), sims[lo:hi].view(np.uint64), texts[lo:hi])
            first = components_of(pairs.links(), len(root))
            size = np.bincount(first, minlength=len(root))
            found = np.flatnonzero(size[first] > 1)
            names = pd.Series([f"{h[x]}:{sims[x]}" for x in first[found].tolist()], dtype=object)  # a text column where nothing is linked, too
            return pd.DataFrame({"root": names, "h": h[found], "sim": sims[found]})

        for pdf in batches:
            if not len(pdf):
                continue
            root = pdf["root"].to_numpy(np.int64)
            last = int(np.searchsorted(root, root[-1]))  # the last group may go on in the next batch
            if last:
                held.append(pdf.iloc[:last])
            if last or held and held[-1]["root"].iloc[-1] != root[0]:
                yield closed()
                held = []
            held.append(pdf.iloc[last:])
        yield closed()

    return run


def _verified(radius: int, least: float, masks: list[int]):
    """Links between lines of one bucket (sorted by t, k): within the radius and similar enough. Two lines
    that also meet in an earlier table are compared there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = None
        line: list[str] = []
        sims: list[int] = []
        texts: list[str] = []

        pairs = _Pairs(radius, least)

        def close() -> None:
            if len(line) > 1:
                pairs.group(line, np.array(sims, np.int64).view(np.uint64), texts, [np.uint64(m) for m in masks[:key[0]]])

        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[["t", "k", "t2", "k2"]].to_numpy(np.int64)
            names, prints, norms = pdf["line"].tolist(), pdf["sim"].tolist(), pdf["norm"].tolist()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                now = tuple(keys[lo].tolist())
                if now != key:
                    close()
                    key, line, sims, texts = now, [], [], []
                line += names[lo:hi]
                sims += prints[lo:hi]
                texts += norms[lo:hi]
            out, pairs.out = pairs.out, []
            yield pd.DataFrame(out, columns=["a", "b"])
        close()
        yield pd.DataFrame(pairs.links(), columns=["a", "b"])

    return run


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, drops in batches:
        out = []
        for text, drop in zip(texts.to_pylist(), drops.to_pylist()):
            if text is not None and drop:
                gone = set(drop)
                text = "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone)
            out.append(text)
        yield pa.array(out, pa.string())


def line_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = 20, radius: int = RADIUS,
                agree: int = 2, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(occurrences ``(id, th, at, h, sim)`` of the lines that take part, groups ``(h, sim, keep)`` of the
    lines that occur more than once or are linked; keep = struct of the kept occurrence's place)."""
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    occ = cut(base.select("id", "th", F.explode(F.arrow_udf(_prints(least_bytes), "array<struct<at int, h long, sim long>>")("text")).alias("x"))
              .select("id", "th", "x.at", "x.h", "x.sim"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "at")
    heads = cut(occ.groupBy("h", "sim").agg(F.min(place).alias("keep"), F.count(F.lit(1)).alias("n")))
    linked_lines = cut(_linked_lines(base, heads.filter("sim <> h"), radius, agree, similarity))
    members = linked_lines.join(heads, ["h", "sim"])
    best = members.groupBy("root").agg(F.min("keep").alias("best"))
    fuzzy = members.join(best, "root").select("h", "sim", F.col("best").alias("keep"))
    exact = heads.filter("n > 1").join(linked_lines, ["h", "sim"], "left_anti").select("h", "sim", "keep")
    return occ, fuzzy.unionByName(exact)


def _linked_lines(base: DataFrame, heads: DataFrame, radius: int, agree: int, similarity: float) -> DataFrame:
    """Components ``(root, h, sim)`` of the lines within the radius and of the edit similarity."""
    masks = block_masks(radius, agree)
    masked = F.array(*[F.lit(_signed(m)) for m in masks])
    in_tables = lambda df: df.select("*", F.posexplode(F.transform(masked, lambda m: F.col("sim").bitwiseAND(m))).alias("t", "k"))
    sims = cut(heads.groupBy("sim").agg(F.count(F.lit(1)).alias("lines")))
    key = F.col("sim").bitwiseAND(F.element_at(masked, F.col("t") + 1))  # reckoned again behind the shuffle
    marks = F.array(*[F.lit(_signed((t + 1) * _FACTOR % (1 << 64))) for t in range(len(masks))])
    bucket = key.bitwiseXOR(F.element_at(marks, F.col("t") + 1))  # one long sorts fast; buckets that it throws together only meet in vain
    near = components(sims.select(F.explode(F.lit(list(range(len(masks))))).alias("t"), "sim").repartition("t", key)
                      .select(bucket.alias("bucket"), "sim").sortWithinPartitions("bucket")
                      .mapInArrow(_near_prints(radius), "a long, b long"))
    alone = sims.filter("lines > 1").select("sim").join(near, F.col("sim") == F.col("node"), "left_anti")
    tied = cut(near.select(F.col("node").alias("sim"), "root").unionAll(alone.select("sim", F.col("sim").alias("root"))))
    suspects = cut(heads.select("h", "sim", "keep").join(broadcast_if_small(tied), "sim"))
    lines = cut(_texts_of(suspects, base))
    sizes = lines.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("norm")).alias("bytes"))
    too_large = (F.col("size") > GROUP_CAP) | (F.col("bytes") > GROUP_BYTES)
    large = broadcast_if_small(cut(sizes.filter(too_large).select("root")))
    small = (lines.join(large, "root", "left_anti").repartition("root").sortWithinPartitions("root")
             .mapInPandas(_grouped(radius, similarity), "root string, h long, sim long"))
    return small.unionByName(_linked_by_tables(lines.join(large, "root").drop("root"), in_tables, masks, radius, similarity))


def _linked_by_tables(lines: DataFrame, in_tables, masks: list[int], radius: int, similarity: float) -> DataFrame:
    """The same for lines of groups too large for a task: bucket by bucket, then connected."""
    lines = lines.withColumn("line", F.concat(F.hex("h"), F.lit("-"), F.hex("sim")))
    places = in_tables(lines.select("line", "sim"))
    masked = F.array(*[F.lit(_signed(m)) for m in masks])
    differ = F.bit_or("sim").bitwiseXOR(F.bit_and("sim")).alias("differ")
    # where all lines of a bucket also meet in one earlier table, all its pairs are compared there
    sizes = (places.groupBy("t", "k").agg(F.count(F.lit(1)).alias("size"), differ).filter("size > 1")
             .filter(~F.exists(F.slice(masked, 1, F.col("t")), lambda m: F.col("differ").bitwiseAND(m) == 0)).drop("differ"))
    spread = places.join(sizes, ["t", "k"]).drop("sim").join(lines.select("line", "sim", "norm"), "line")
    small = spread.filter(F.col("size") <= BUCKET_CAP).select("t", "k", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("k2"), "line", "sim", "norm")
    # the other bits once more in radius + 1 blocks, one of which must agree
    again = F.array(*[F.array(*[F.lit(_signed(x)) for x in _rest_blocks(m, radius)]) for m in masks])
    large = (spread.filter(F.col("size") > BUCKET_CAP)
             .select("t", "k", "line", "sim", "norm", F.posexplode(F.transform(F.element_at(again, F.col("t") + 1), lambda m: F.col("sim").bitwiseAND(m))).alias("t2", "k2"))
             .select("t", "k", "t2", "k2", "line", "sim", "norm"))
    edges = (small.unionAll(large).repartition("t", "k", "t2", "k2").sortWithinPartitions("t", "k", "t2", "k2")
             .mapInPandas(_verified(radius, similarity, masks), "a string, b string"))
    roots = components(edges)
    return roots.join(lines.select(F.col("line").alias("node"), "h", "sim"), "node").select("root", "h", "sim")


def _rest_blocks(mask: int, radius: int) -> list[int]:
    free = [p for p in range(64) if not mask >> p & 1]
    return [sum(1 << p for p in part.tolist()) for part in np.array_split(free, radius + 1)]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = 20, radius: int = RADIUS,
                agree: int = 2, similarity: float = 0.8, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and the counts of its lines before and of
    the lines dropped.

    Of every group of equal or linked lines the occurrence of the smallest (id, text hash, position)
    stays; rows equal in id and text are one occurrence and stay equal. Lines are what line feeds
    separate. Two lines are linked if their SimHashes over 4-byte windows differ in at most ``radius`` bits
    and their edit similarity is ``similarity`` or more; lines whose normalised form is shorter than
    ``least_bytes`` go by equality only, lines of white space take no part. A null text stays null with 0
    lines, an empty one has one empty line. Null ids come after all others. Extra columns pass; clashing
    count names get a leading underscore. ``agree``: 2 suits up to some ten million distinct lines, each
    further block 60 times as many; the links found are the same."""
    occ, groups = line_groups(docs, id_col, text_col, least_bytes, radius, agree, similarity)
    gone = (occ.join(groups, ["h", "sim"])
            .filter(~(F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "at").eqNullSafe(F.col("keep"))))
            .groupBy("id", "th").agg(F.collect_set("at").alias("__drop"))
            .withColumnsRenamed({"id": "__id", "th": "__th"}))
    th, before, dropped = free_name(docs, "__text_hash", n_lines, n_dropped)
    stamped = docs.withColumn(th, F.xxhash64(F.col(text_col)))
    got = stamped.join(gone, stamped[id_col].eqNullSafe(gone["__id"]) & (stamped[th] == gone["__th"]), "left")
    count = F.coalesce(F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    return (got.withColumn(before, count.cast("long"))
            .withColumn(dropped, F.coalesce(F.array_size("__drop"), F.lit(0)).cast("long"))
            .withColumn(text_col, F.arrow_udf(_without, "string")(F.col(text_col), F.col("__drop")))
            .drop("__id", "__th", "__drop", th))
