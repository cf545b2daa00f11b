"""Main text of web pages by minimum cuts.

A page is read into blocks: the text between two block-level tags, outside scripts, styles and other
parts that are never shown as text. A classifier gives every block log odds of being content from its
length, share of link text, kind of tag, and what the elements around it are called. These odds are the
block's terminal capacities. Smoothness edges tie blocks that follow one another, more strongly the
nearer they are in the document tree, and every block to its element, every element to the one around
it. The minimum cut between content and boilerplate is the labelling that costs least: a short line
between paragraphs goes with them, a long notice in a list of links does not stay.

The odds are fixed, not learned, since pages carry no labels; they are parameters (``Costs``).
Names count where they are: an element called a menu, header, footer, sidebar, notice, advert, form or
comments speaks against all in it, unless it holds the article itself (a wrapper named after its
parts); an article or main element speaks for all in it.

A page is a row and is cut where it lies; nothing is shuffled. The flow is found along shortest paths
of residual capacity, phase by phase, in time near the page's length, since odds that agree need none.

Text: character references decoded, white space within a block made one space, ends trimmed, blocks
joined by a line feed in page order. Null, empty and unclosed pages, stray tags: read as far as they
go; null gives an empty text. Very long pages: a block list and a graph of their size in one task.
Repeated rows: each its own result. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.common import small_batches

# HTML's element kinds, and names that sites give to what is not the article.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "select", "option", "datalist", "textarea", "button", "canvas", "audio", "video"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "input", "link", "meta",
}
CLOSES = {  # an open element of the key's kind ends where one of these begins
    "p": {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"},
}
AGAINST_TAGS = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
FOR_TAGS = {"article", "main"}
AGAINST_NAMES = (
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus discussion "
    "footer form gdpr header hidden login masthead menu meta modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promoted recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar "
    "topbar warning widget alert"
).split()
FOR_NAMES = "article body content entry main post story text".split()
FIRM_NAMES = "comment comments discussion disqus recommended related replies reply".split()  # whatever they hold
AGAINST_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert", "alertdialog"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s=/>\"'])([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b", re.S)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Costs:
    """Log odds of content and strengths of the edges."""

    prior: float = -0.6
    per_root_word: float = 0.35  # times the square root of the words, up to ``most_words``
    most_words: float = 2.4
    linked: float = -4.0  # times the share of link characters
    heading: float = 1.0
    paragraph: float = 0.8
    sentence: float = 0.6  # ends like a sentence
    in_list: float = -0.5
    against: float = -9.0  # an element around it is called something that is not the article
    in_article: float = 4.0
    named_for: float = 1.0
    next_sibling: float = 1.2  # edge between neighbours with the same parent
    next_apart: float = 0.6  # halved for every level the tree lies between them
    to_element: float = 0.5
    to_outer: float = 0.25


@dataclass
class Element:
    tag: str
    parent: int
    against: bool = False
    firm: bool = False  # against, even if it holds articles
    favoured: bool = False
    named_for: bool = False
    in_article: bool = False
    holds_main: bool = False


@dataclass
class Block:
    text: str
    element: int
    tag: str
    linked: int
    start: int
    end: int


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1)])
    blocks: list[Block] = field(default_factory=list)


def _names(attributes: str) -> tuple[set[str], bool]:
    """Words of an element's class, id and role, and whether it says that it is hidden."""
    names: set[str] = set()
    hidden = False
    for key, a, b, c, flag in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            names.update(w.lower() for w in NAME.findall(value))
        elif key == "role":
            names.update(("role-against",) if value.lower() in AGAINST_ROLES else ("main",) if value.lower() == "main" else ())
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif flag or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
    return names, hidden


_AGAINST, _FOR, _FIRM = frozenset(AGAINST_NAMES), frozenset(FOR_NAMES), frozenset(FIRM_NAMES)


def _element(tag: str, attributes: str, at: int, around: Element) -> Element:
    """What an element's tag and names say about all in it."""
    names, hidden = _names(attributes) if "=" in attributes or "hidden" in attributes else (set(), False)
    called, named_for = _AGAINST & names, not _FOR.isdisjoint(names)
    if named_for and called == {"header"}:  # an article's header holds its title
        called = set()
    tagged = tag in AGAINST_TAGS and not (tag == "header" and around.in_article)
    against = tag not in ("html", "body") and (tagged or hidden or bool(called) or "role-against" in names)
    firm = against and (tag in ("nav", "footer", "aside") or hidden or not _FIRM.isdisjoint(names))
    favoured = not against and (tag in FOR_TAGS or "main" in names)
    return Element(tag, at, against, firm, favoured, named_for and not against, around.in_article or tag == "article")


def read(html: str) -> Page:
    """The blocks of a page and the elements they stand in."""
    page = Page()
    elements, blocks = page.elements, page.blocks
    stack: list[int] = [0]  # open elements, inline ones left out
    open_tags: Counter[str] = Counter()
    links = silent = 0  # open links, open elements that are never shown
    parts: list[str] = []
    linked, start, last = 0, 0, 0

    def flush(end: int) -> None:
        nonlocal linked, start
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                at = stack[-1]
                blocks.append(Block(text, at, elements[at].tag, min(linked, len(text)), start, end))
            parts.clear()
        linked = 0

    def shown(a: int, b: int) -> None:
        nonlocal linked, start
        if a < b and not silent:
            if not parts:
                start = a
            parts.append(html[a:b])
            if links:
                linked += b - a

    def leave() -> None:
        nonlocal links, silent
        tag = elements[stack.pop()].tag
        open_tags[tag] -= 1
        silent -= tag in HIDDEN
        links = 0

    at = 0
    while found := TOKEN.search(html, at):
        shown(last, found.start())
        at = last = found.end()
        name = found[2]
        if name is None:
            continue
        tag, closing = name.lower(), found[1] == "/"
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            elif tag == "br" and parts:
                parts.append(" ")
            continue
        if tag in RAW and not closing:
            flush(found.start())
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = last = end.end() if end else len(html)
            continue
        flush(found.start())
        if closing:
            left = open_tags[tag]
            while left and open_tags[tag] == left:  # with it end the elements left open in it
                leave()
            continue
        while len(stack) > 1 and tag in CLOSES.get(elements[stack[-1]].tag, ()):
            leave()
        if tag in VOID:
            continue
        while tag == "body" and silent:  # a head that was never closed
            leave()
        element = _element(tag, found[3], stack[-1], elements[stack[-1]])
        elements.append(element)
        stack.append(len(elements) - 1)
        open_tags[tag] += 1
        silent += tag in HIDDEN
        if element.favoured:  # wrappers around an article are not what their parts are called
            i = element.parent
            while i > 0 and not elements[i].holds_main:
                elements[i].holds_main = True
                i = elements[i].parent
    shown(last, len(html))
    flush(len(html))
    return page


def odds(page: Page, costs: Costs = Costs()) -> list[float]:
    """Log odds of content, block by block."""
    around: list[tuple[bool, bool, bool, bool]] = []  # against, in an article, named for, in a list
    for e in page.elements:
        above = around[e.parent] if e.parent >= 0 else (False,) * 4
        against = e.against and (e.firm or not e.holds_main)
        around.append((above[0] or against, above[1] or e.favoured, above[2] or e.named_for, above[3] or e.tag in ("li", "td", "dt", "dd")))
    out = []
    for b in page.blocks:
        against, article, named, listed = around[b.element]
        value = costs.prior + min(costs.most_words, costs.per_root_word * (b.text.count(" ") + 1) ** 0.5) + costs.linked * b.linked / max(len(b.text), 1)
        value += costs.heading * (b.tag in ("h1", "h2", "h3")) + costs.paragraph * (b.tag in ("p", "blockquote", "pre")) + costs.in_list * listed
        value += costs.sentence * (b.text[-1] in ".!?…。\"'”»:")
        value += costs.against * against + costs.in_article * (article and not against) + costs.named_for * (named and not against)
        out.append(value)
    return out


# --- Minimum cut ---------------------------------------------------------------------------------


class Network:
    """An undirected network with terminals; a node's terminal capacity is its signed excess."""

    def __init__(self, excess: list[float]):
        self.excess = list(excess)  # above 0: still reachable from the source; below: to the sink
        self.first: list[list[int]] = [[] for _ in excess]
        self.to: list[int] = []
        self.room: list[float] = []  # residual capacity; edge i ^ 1 is edge i backwards

    def join(self, a: int, b: int, capacity: float) -> None:
        self.first[a].append(len(self.to))
        self.first[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [capacity, capacity]

    def saturate(self) -> None:
        """Send all excess that fits from nodes above 0 to nodes below, in shortest-path phases."""
        excess, first, to, room = self.excess, self.first, self.to, self.room
        tiny = 1e-9
        while True:
            level = [0 if e > tiny else -1 for e in excess]
            queue = deque(i for i, e in enumerate(excess) if e > tiny)
            reached = False
            while queue:
                v = queue.popleft()
                for e in first[v]:
                    w = to[e]
                    if room[e] > tiny and level[w] < 0:
                        level[w] = level[v] + 1
                        queue.append(w)
                        reached = reached or excess[w] < -tiny
            if not reached:
                return
            nexts = [0] * len(excess)
            for root in range(len(excess)):
                while excess[root] > tiny:
                    path: list[int] = []
                    v = root
                    while not (excess[v] < -tiny and path):
                        edges = first[v]
                        while nexts[v] < len(edges):
                            e = edges[nexts[v]]
                            if room[e] > tiny and level[to[e]] == level[v] + 1:
                                break
                            nexts[v] += 1
                        if nexts[v] < len(edges):
                            path.append(edges[nexts[v]])
                            v = to[edges[nexts[v]]]
                        elif path:  # a dead end: back, and past the edge that led here
                            v = to[path.pop() ^ 1]
                            nexts[v] += 1
                        else:
                            break
                    if not path:
                        break
                    flow = min(excess[root], -excess[v], *(room[e] for e in path))
                    excess[root] -= flow
                    excess[v] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow

    def source_side(self) -> list[bool]:
        """The nodes that keep to the source in the cut with the fewest of them."""
        seen = [e > 1e-9 for e in self.excess]
        queue = deque(i for i, s in enumerate(seen) if s)
        while queue:
            for e in self.first[queue.popleft()]:
                w = self.to[e]
                if self.room[e] > 1e-9 and not seen[w]:
                    seen[w] = True
                    queue.append(w)
        return seen


def edges(page: Page, costs: Costs = Costs()) -> Iterator[tuple[int, int, float]]:
    """Smoothness edges over nodes: first the blocks, then the elements."""
    elements, n = page.elements, len(page.blocks)
    depth = [0] * len(elements)
    for i, e in enumerate(elements[1:], 1):
        depth[i] = depth[e.parent] + 1
    for i, (a, b) in enumerate(pairwise(page.blocks)):
        x, y, apart = a.element, b.element, 0
        siblings = elements[x].parent == elements[y].parent
        while x != y and apart < 12:
            if depth[x] >= depth[y]:
                x = elements[x].parent
            else:
                y = elements[y].parent
            apart += 1
        yield i, i + 1, costs.next_sibling if siblings or apart == 0 else costs.next_apart * 0.5 ** (apart - 1)
    used = {b.element for b in page.blocks}
    for i, b in enumerate(page.blocks):
        yield i, n + b.element, costs.to_element
    for i in range(len(elements) - 1, 0, -1):
        if i in used:
            used.add(elements[i].parent)
            yield n + i, n + elements[i].parent, costs.to_outer


def content(page: Page, costs: Costs = Costs()) -> list[bool]:
    """Which blocks are content: the source side of the minimum cut."""
    weights = odds(page, costs)
    if all(w > 0 for w in weights) or all(w <= 0 for w in weights):  # nothing to cut
        return [w > 0 for w in weights]
    network = Network([*weights, *([0.0] * len(page.elements))])
    for a, b, capacity in edges(page, costs):
        network.join(a, b, capacity)
    network.saturate()
    return network.source_side()[: len(weights)]


def main_text(html: str | None, costs: Costs = Costs()) -> str:
    page = read(html or "")
    return "\n".join(b.text for b, keep in zip(page.blocks, content(page, costs), strict=True) if keep)


def extract(pages: DataFrame, keep: list[str], costs: Costs = Costs(), names: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """Columns ``keep`` of pages with the main text of ``html`` and its code points."""
    small_batches(pages.sparkSession, "4m")
    schema = T.StructType([*pages.select(*keep).schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [main_text(h.as_py(), costs) for h in batch.column(len(keep))]
                lengths = pa.array(np.array([len(t) for t in texts], np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), lengths], names=schema.names)

    return pages.select(*keep, F.col("html").alias("_html")).mapInArrow(run, schema)


def blocks(pages: DataFrame, keep: list[str], costs: Costs = Costs()) -> DataFrame:
    """Every block of every page: its place, text, where it stands in the html (code points), the tag
    around it, its log odds and whether it is content."""
    small_batches(pages.sparkSession, "4m")
    added = "_block long, _text string, _start long, _end long, _tag string, _odds double, _content boolean"
    schema = T.StructType([*pages.select(*keep).schema.fields, *T._parse_datatype_string(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                page = read(batch.column(len(keep))[i].as_py() or "")
                if not page.blocks:
                    continue
                n = len(page.blocks)
                rows = [(j, b.text, b.start, b.end, b.tag) for j, b in enumerate(page.blocks)]
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                kept = [c.slice(i, 1).take(pa.array(np.zeros(n, np.int64))) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, *columns, pa.array(odds(page, costs)), pa.array(content(page, costs))], names=schema.names)

    return pages.select(*keep, F.col("html").alias("_html")).mapInArrow(run, schema)
