"""Main text of web pages by minimum cut.

A page is read once into blocks: runs of text between block-level tags, with the number of linked characters, the parent
element and what the elements around say (tag, class, id, role). A linear classifier turns that into the log-odds s of
content. The labelling that costs least is a minimum cut: a block of s > 0 is tied to the source with capacity s, one of
s < 0 to the sink with -s; blocks that follow one another, and blocks of the same parent, are tied to each other with a
capacity that falls with their distance in the tree. Max-flow separates content from boilerplate: doubtful blocks follow
their surroundings. Blocks whose terminal capacity exceeds all their ties keep their side in every minimum cut; they are
settled first, so the flow runs over the doubtful ones only and the cut is still exact.

The weights are fixed log-odds: pages come without labels to learn from.

Defined cases: null and empty pages give an empty text; comments, declarations, scripts, styles, titles and templates are
never text; unclosed and stray tags are read as browsers do, roughly; a page without any mark-up is one block; character
references are decoded, white space in a block becomes one blank, blocks are joined in page order by an empty line.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import carried, map_batches, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^<>]*>?|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
RAW = frozenset("script style title textarea noscript iframe template svg math object canvas noframes".split())
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
#: What a start tag closes if it is open (within the nearest element of the second set).
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "a": ({"a"}, BLOCK),
}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are boilerplate by their tag; a header inside an article may hold its title.
CHROME = frozenset("nav footer aside form menu dialog button select fieldset".split())
#: Words of class, id and role that mark boilerplate: of a page's layout, and of parts that hold articles themselves.
LAYOUT_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert advertisement adsense sponsor sponsored "
    "banner toolbar topbar breadcrumb breadcrumbs pagination pager search login signup contentinfo complementary".split())
PART_WORDS = frozenset(
    "comment comments disqus reply replies respond discussion related recommended recommendations teaser promo promotion "
    "newsletter subscribe subscription share sharing social cookie cookies consent gdpr notice notices alert popup modal "
    "overlay paywall widget widgets copyright legal disclaimer hidden".split())
CONTENT_WORDS = frozenset("article content main post entry story body text prose markdown".split())
_SMALL_PRINT = re.compile(r"©|\(c\)|copyright|all rights reserved|cookie|subscribe|sign up|log in|privacy policy", re.I)

#: Log-odds of the classifier.
IN_CHROME, IN_CONTENT, LINKED, SENTENCE, SMALL_PRINT, BIAS = -9.0, 3.5, -5.0, 0.6, -2.5, -1.2
#: Capacity of a tie between neighbours of one parent; each step apart in the tree halves it. Unit of capacities.
TIE, UNIT = 0.9, 1000


@dataclass
class Block:
    """text; linked: linked characters; parent: element number; path: element numbers from the root."""

    text: str
    linked: int
    parent: int
    path: tuple[int, ...]
    chrome: bool
    content: bool
    heading: bool


@dataclass
class _Element:
    name: str
    number: int
    path: tuple[int, ...]
    by_tag: bool  # boilerplate by tag or by a part's words
    by_layout: bool
    content: bool


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=lambda: [_Element("", 0, (0,), False, False, False)])
    texts: list[str] = field(default_factory=list)
    linked: int = 0
    elements: int = 0

    def flush(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                holder = next(e for e in reversed(self.stack) if e.name in BLOCK or not e.name)
                self.blocks.append(Block(text, self.linked, holder.number, holder.path,
                                         holder.by_tag or holder.by_layout, holder.content,
                                         any(e.name in _HEADINGS for e in self.stack[-4:])))
            self.texts, self.linked = [], 0

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.flush()
            # A block ends an open paragraph, with whatever is open inside it.
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].name == "p":
                    del self.stack[k:]
                    break
                if self.stack[k].name in BLOCK:
                    break
        if name in _CLOSES:
            same, within = _CLOSES[name]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].name in same:
                    del self.stack[k:]
                    break
                if self.stack[k].name in within:
                    break
        if name in VOID:
            if name == "br":
                self.texts.append(" ")
            return
        top = self.stack[-1]
        self.elements += 1
        by_tag, by_layout, content = top.by_tag, top.by_layout, top.content
        words, hidden = _marks(attributes) if attributes else (frozenset(), False)
        if name in ("article", "main"):
            by_layout, content = False, True
        elif name not in ("html", "body", "head"):
            by_layout = by_layout or bool(words & LAYOUT_WORDS)
            content = content or bool(words & CONTENT_WORDS and not words & LAYOUT_WORDS)
        if name not in ("html", "body"):
            by_tag = by_tag or hidden or name in CHROME or bool(words & PART_WORDS)
            by_layout = by_layout or name == "header" and not content
        self.stack.append(_Element(name, self.elements, (*top.path, self.elements) if name in BLOCK else top.path,
                                   by_tag, by_layout, content))

    def close(self, name: str) -> None:
        block = name in BLOCK
        if block:
            self.flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name == name:
                del self.stack[k:]
                return
            if not block and self.stack[k].name in BLOCK:
                return


def _marks(attributes: str) -> tuple[frozenset[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            words.update(w.lower() for w in _PART.findall(value))
        elif name == "style":
            hidden = hidden or "display:none" in value.replace(" ", "").lower()
        else:
            hidden = hidden or name == "hidden" or value.lower() == "true"
    return frozenset(words), hidden


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    reader, at, n = _Reader(), 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        token = m[0]
        if token[0] != "<" or token == "<":
            text = unescape(token) if "&" in token else token
            reader.texts.append(text)
            if any(e.name == "a" for e in reader.stack[-4:]):
                reader.linked += len(text)
        elif m[2]:
            name = m[2].lower()
            if m[1]:
                reader.close(name)
            elif name in RAW:
                end = _RAW_END[name].search(html, at)
                if not m[3].endswith("/"):
                    at = end.end() if end else n
            else:
                reader.open(name, m[3])
        elif token.startswith("<![CDATA["):
            reader.texts.append(token[9:].removesuffix("]]>"))
    reader.flush()
    return reader.blocks


def log_odds(b: Block) -> float:
    """The classifier: positive for content."""
    n = len(b.text)
    s = BIAS + min(3.0, n / 80.0) + LINKED * min(1.0, b.linked / n)
    if b.chrome:
        s += IN_CHROME
    if b.content:
        s += IN_CONTENT
    if b.heading:
        s += 0.5
    if b.text[-1] in ".!?…:;\"'”’)":
        s += SENTENCE
    if n < 200 and not b.content and _SMALL_PRINT.search(b.text):
        s += SMALL_PRINT
    return s


def ties(found: list[Block]) -> dict[tuple[int, int], int]:
    """Capacities between blocks: neighbours in the page, and neighbours under one parent."""
    out: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            a = found[i - 1]
            shared = 0
            for x, y in zip(a.path, b.path, strict=False):
                if x != y:
                    break
                shared += 1
            apart = len(a.path) + len(b.path) - 2 * shared
            out[i - 1, i] = round(UNIT * TIE * 0.5 ** apart)
        for parent in b.path[-2:]:  # its own element and the one around it
            j = last.get(parent)
            if j is not None and j != i:
                key = (j, i)
                out[key] = out.get(key, 0) + round(UNIT * TIE / 4)
            last[parent] = i
    return {k: c for k, c in out.items() if c > 0}


def minimum_cut(terminal: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """True for the source side of the minimum cut that is smallest on the source side.

    terminal: capacity from the source if positive, to the sink if negative. edges: both ways.
    """
    n = len(terminal)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    side: list[bool | None] = [None] * n
    left = list(terminal)
    queue = deque(range(n))
    while queue:  # settle what no tie can turn; its ties become terminal capacities of the neighbours
        i = queue.popleft()
        if side[i] is None and abs(left[i]) > sum(near[i].values()):
            side[i] = left[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                left[j] += c if side[i] else -c
                queue.append(j)
            near[i] = {}
    doubtful = [i for i in range(n) if side[i] is None]
    if doubtful:
        for i, s in zip(doubtful, _max_flow(doubtful, left, near), strict=True):
            side[i] = s
    return [bool(s) for s in side]


def _max_flow(nodes: list[int], terminal: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Dinic's algorithm; which nodes the source still reaches in the residual graph."""
    place = {i: k + 2 for k, i in enumerate(nodes)}  # 0: source, 1: sink
    graph: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    to: list[int] = []
    room: list[int] = []

    def link(a: int, b: int, there: int, back: int) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(there)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in nodes:
        if terminal[i] > 0:
            link(0, place[i], terminal[i], 0)
        elif terminal[i] < 0:
            link(place[i], 1, -terminal[i], 0)
        for j, c in near[i].items():
            if i < j:
                link(place[i], place[j], c, c)
    while True:
        level = [-1] * len(graph)
        level[0] = 0
        queue = deque([0])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[1] < 0:
            return [level[place[i]] >= 0 for i in nodes]
        turn = [0] * len(graph)
        path: list[int] = []
        a = 0
        while True:
            if a == 1:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if room[e] == 0)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[a] < len(graph[a]):
                e = graph[a][turn[a]]
                if room[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(graph[a]):
                path.append(graph[a][turn[a]])
                a = to[path[-1]]
            elif a == 0:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]


def main_text(html: str | None) -> str:
    """The text of the blocks on the content side, joined by an empty line."""
    found = blocks(html) if html else []
    if not found:
        return ""
    side = minimum_cut([round(UNIT * log_odds(b)) for b in found], ties(found))
    return "\n\n".join(b.text for b, s in zip(found, side, strict=True) if s)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row."""
    schema = carried(pages, ["page_id", "url"], "text string")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                          names=["page_id", "url", "text"])

    return map_batches(pages.select("page_id", "url", "html"), work, schema, "html")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: main text and its length in code points."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
