"""HTML main-text extraction by minimum-cut labelling.

A page becomes a list of text blocks. A linear classifier (fixed weights over the block's place in the
page, its class and id words, links, length and punctuation) gives each block the costs of calling it
content or boilerplate; they are the capacities of its arcs to the two terminals. Blocks next to each
other and blocks near each other in the DOM are tied by smoothness arcs. The minimum cut, found by
maximum flow, is the cheapest labelling as a whole."""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, free_name

SCALE = 1000  # capacities are whole thousandths, so that the flow is exact

# Weights of the classifier's log-odds for content.
BIAS = -1.0
IN_ARTICLE, IN_MAIN, IN_BOILER_TAG, BOILER_NAME = 3.0, 2.0, -7.0, -6.0
PER_LOG_WORDS, LOG_WORDS_FROM, SENTENCE_END = 0.8, 2.0, 0.8
LINK_SHARE, RIGHTS_MARK, HEADING = -5.0, -2.0, 0.5
# Smoothness: per pair of neighbouring blocks, less by their distance in the DOM; per next block of one parent.
NEIGHBOUR, SIBLING = 0.6, 0.4

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>(?:"[^"]*"|'[^']*'|[^'">])*)|[^>]*)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_RAW = {t: re.compile(rf"</{t}\s*/?>|</{t}\s[^>]*>", re.I) for t in
        ("script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes")}  # text up to the end tag, or to the page's end
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
                   "summary table tbody td tfoot th thead tr ul".split())
_BOILER_TAG = frozenset("nav footer aside form menu button dialog search label fieldset head".split())
# What they hold is furniture, apart from the text around; without its own end tag one is an ordinary element.
_APART_TAG = frozenset("select svg template audio video canvas noscript".split())
_ENDS_P = _BLOCK - {"body", "html", "head"}
_SELF_CLOSING = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)), "tr": ("tr", ("table",)),
                 "td": ("th", ("tr", "table")), "th": ("td", ("tr", "table"))}
# Class, id and role words that mark page furniture, matched as whole words.
_BOILER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promotions?|sidebars?|side-?bar|menus?|"
    r"nav(?:bar|igation)?|footers?|masthead|site-?header|page-?header|topbar|breadcrumbs?|cookies?|consent|gdpr|notices?|notification|alerts?|"
    r"popups?|modal|overlay|newsletter|subscribe|subscription|signup|login|comments?|commentlist|respond|repl(?:y|ies)|disqus|share|sharing|"
    r"social|related|recommend(?:ed|ations)?|widgets?|pagination|pager|tags?-?cloud|toolbar|copyright|disclaimer|skip-?link|complementary|"
    r"contentinfo|search-?form|teasers?)(?=$|[\s_-])", re.I)
_ARTICLE, _MAIN, _BOILER, _NAMED, _LINK, _HEAD, _APART = 1, 2, 4, 8, 16, 32, 64


class Block:
    __slots__ = ("text", "flags", "parent", "depth", "linked", "size")

    def __init__(self, text, flags, parent, depth, linked, size):
        self.text, self.flags, self.parent, self.depth, self.linked, self.size = text, flags, parent, depth, linked, size


def blocks_of(html: str) -> list[Block]:
    """The non-empty text blocks of a page in page order, character references decoded."""
    out, unclosed = _parsed(html, frozenset())
    return _parsed(html, unclosed)[0] if unclosed else out


def _parsed(html: str, ordinary: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """(blocks, numbers of the elements of ``_APART_TAG`` that miss their end tag); elements ``ordinary``
    are not set apart."""
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # tag, flags of itself and its ancestors, element number
    out: list[Block] = []
    buf: list[str] = []
    linked = size = 0
    element = 0
    places: dict[str, list[int]] = {}  # of the open elements of a name
    blocks: list[int] = []  # of the open block-level elements
    unclosed: set[int] = set()
    place = stack[0]
    apart = 0
    depth = 0

    def shut(at: int) -> None:
        for name, *_ in stack[at:]:
            places[name].pop()
            if name in _BLOCK:
                blocks.pop()
        del stack[at:]

    def innermost(names: tuple[str, ...]) -> int:
        """The place of the innermost open element of these names, 0 if there is none."""
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def flush() -> None:
        nonlocal buf, linked, size
        if buf:
            text = _SPACE.sub(" ", "".join(buf)).strip()
            if text:
                out.append(Block(text, place[1], place[2], depth, linked, size))
            buf, linked, size = [], 0, 0

    def say(raw: str) -> None:
        nonlocal linked, size, place, depth, apart
        text = unescape(raw) if "&" in raw else raw
        if buf and stack[-1][1] & _APART != apart and not text.isspace():
            flush()
        if not buf:
            if not text or text.isspace():
                return
            apart = stack[-1][1] & _APART
            at = len(stack) - 1  # a block belongs to the nearest block-level element, or one set apart
            while at and stack[at][0] not in _BLOCK and not (apart and stack[at][0] in _APART_TAG):
                at -= 1
            place, depth = stack[at], at
        buf.append(text)
        n = len(text) - text.count(" ")
        size += n
        if stack[-1][1] & _LINK:
            linked += n

    pos, end = 0, len(html)
    while pos < end:
        m = _TOKEN.search(html, pos)
        if m is None:
            say(html[pos:])
            break
        if m.start() > pos:
            say(html[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag closes up to its element; without one it is ignored
            if tag in _BLOCK:
                flush()
            at = innermost((tag,))
            if at:
                unclosed.discard(stack[at][2])
                shut(at)
            continue
        if tag in _RAW:
            if tag in _BLOCK:
                flush()
            if not m[3].endswith("/"):
                close = _RAW[tag].search(html, pos)
                pos = close.end() if close else end
            continue
        if tag in _BLOCK:
            flush()
            if tag in _ENDS_P:
                if blocks and stack[blocks[-1]][0] == "p":
                    shut(blocks[-1])
            if tag in _SELF_CLOSING:
                twin, within = _SELF_CLOSING[tag]
                at = innermost((tag, twin))
                if at > innermost(within):
                    shut(at)
        elif tag == "br":
            if buf:
                buf.append(" ")
            continue
        if tag in _VOID:
            continue
        flags = stack[-1][1]
        if tag == "article":
            flags |= _ARTICLE
        elif tag == "main":
            flags |= _MAIN
        elif tag in _BOILER_TAG or tag == "header" and not flags & _ARTICLE:
            flags |= _BOILER
        elif tag == "a":
            flags |= _LINK
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            flags |= _HEAD
        if m[3] and tag not in ("html", "body"):
            for n in _NAMES.finditer(m[3]):
                if _BOILER_NAME.search(n[1] or n[2] or n[3] or ""):
                    flags |= _NAMED
        if m[3].endswith("/") and tag not in _BLOCK:
            continue
        element += 1
        if tag in _APART_TAG:
            unclosed.add(element)
            if element not in ordinary:
                flags |= _BOILER | _APART
        places.setdefault(tag, []).append(len(stack))
        if tag in _BLOCK:
            blocks.append(len(stack))
        stack.append((tag, flags, element))
    flush()
    return out, frozenset(unclosed)


def log_odds(b: Block) -> float:
    """The classifier: log-odds that the block is content."""
    f = b.flags
    s = BIAS + PER_LOG_WORDS * (math.log1p(b.text.count(" ") + 1) - LOG_WORDS_FROM) + LINK_SHARE * (b.linked / b.size if b.size else 0.0)
    if f & _ARTICLE:
        s += IN_ARTICLE
    if f & _MAIN:
        s += IN_MAIN
    if f & _BOILER:
        s += IN_BOILER_TAG
    if f & _NAMED:
        s += BOILER_NAME
    if f & _HEAD:
        s += HEADING
    if b.text[-1] in ".!?…:;\"'”»)。！？":
        s += SENTENCE_END
    if b.text[0] in "©®" or b.text.startswith("(c) "):
        s += RIGHTS_MARK
    return s


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Arcs (i, j, capacity): neighbours in the page, and each block with its parent's next one."""
    arcs = []
    last: dict[int, int] = {}
    for j, b in enumerate(blocks):
        if j:
            a = blocks[j - 1]
            apart = 0 if a.parent == b.parent else 1 + abs(a.depth - b.depth)
            furniture = bool(a.flags & (_BOILER | _NAMED)) != bool(b.flags & (_BOILER | _NAMED))
            arcs.append((j - 1, j, int(SCALE * NEIGHBOUR / (1 + apart + 4 * furniture))))
        i = last.get(b.parent)
        if i is not None:
            arcs.append((i, j, int(SCALE * SIBLING)))
        last[b.parent] = j
    return arcs


def min_cut(odds: list[int], arcs: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's (content) side of a minimum cut; undecided ones do not.

    ``odds``: source capacity less sink capacity of each node (the part both share is cut anyway).
    Blocking flows on level graphs, without recursion."""
    n = len(odds)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[int] = []

    def arc(u, v, c, back):
        head[u].append(len(to))
        to.append(v)
        cap.append(c)
        head[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i, c in enumerate(odds):
        if c > 0:
            arc(s, i, c, 0)
        elif c < 0:
            arc(i, t, -c, 0)
    for i, j, c in arcs:
        if c > 0:
            arc(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for e in head[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    todo.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                cutoff = 0
                for k, e in enumerate(path):
                    cap[e] -= push
                    cap[e ^ 1] += push
                for k, e in enumerate(path):
                    if not cap[e]:
                        cutoff = k
                        break
                u = to[path[cutoff] ^ 1]
                del path[cutoff:]
                continue
            edges, k = head[u], nxt[u]
            while k < len(edges) and not (cap[edges[k]] and level[to[edges[k]]] == level[u] + 1):
                k += 1
            nxt[u] = k
            if k < len(edges):
                path.append(edges[k])
                u = to[edges[k]]
            elif path:
                e = path.pop()
                u = to[e ^ 1]
                nxt[u] += 1
            else:
                break


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined in page order by line feeds."""
    if not html:
        return ""
    blocks = blocks_of(html)
    if not blocks:
        return ""
    odds = [round(SCALE * log_odds(b)) for b in blocks]
    arcs = smoothness(blocks)
    content = [o > 0 for o in odds]
    if any(content) and not all(content):
        content = min_cut(odds, arcs)
    return "\n".join(b.text for b, keep in zip(blocks, content) if keep)


def _texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([main_text(h) for h in pages.to_pylist()], pa.string())


def extract_main_text(pages: DataFrame, html_col: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with the main text of each whole page and its length in code points.

    A null or empty page, and one without content blocks, gives the empty text. White space inside a
    block becomes one space; nothing else is changed or cut. Pages are independent: repeated rows give
    equal results, and a page that many sites share is no hot key, as nothing is shuffled. Output names
    that clash with columns of ``pages`` get a leading underscore."""
    bounded_batches(pages.sparkSession)
    t, n = free_name(pages, text, n_chars)
    return pages.withColumn(t, F.arrow_udf(_texts, "string")(F.col(html_col))).withColumn(n, F.char_length(t).cast("long"))
