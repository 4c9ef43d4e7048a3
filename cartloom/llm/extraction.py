"""Main text of web pages by minimum cut.

A page's blocks of text are the nodes of a graph. What a classifier says of a block, from its place in the page, its links and
its sentences, becomes an edge to the source (content) or the sink (boilerplate); blocks that follow each other and
blocks of one parent are joined by edges that weigh more the closer they are in the element tree. The minimum cut
parts content from boilerplate: labels follow the classifier except where closeness outweighs it.

Defined cases: a null or empty page, and one without content, gives an empty text; pages of any length are read whole;
unclosed, crossed and cut-off markup is read as far as it goes, however deeply elements are nested; formulas and bylines
inside the main part are part of it, tables of contents, lists of tags and tooltips are menus and notices, what is for browsers
without scripts is markup; repeated rows and extra columns do no harm.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from cartloom.llm.shared import columns

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their text is never shown or never prose.
SILENT_TAGS = frozenset(
    "head script style noscript template svg iframe object canvas audio video button select option textarea input "
    "datalist label title".split()
)
# An opening tag of the first kind ends an open element of the second.
IMPLIED_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
MAIN_TAGS = frozenset(["article", "main"])
SIDE_TAGS = frozenset(["nav", "footer", "aside", "form", "menu", "dialog"])
MAIN_NAMES = frozenset("article articlebody body content entry main maincontent post story text".split())
SIDE_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus dropdown footer gdpr login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pager pagination popup promo promotion related recommended "
    "recommendations replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription taboola tags teaser toc toolbar tooltip topbar widget widgets".split()
)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
# What a container says of its parts or its state is not what it is.
STATE_NAME = re.compile(r"(has|with|without|no|is|js)[-_]", re.IGNORECASE)
NAME_PARTS = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SENTENCE = re.compile(r"[.!?…。！？]")

# Capacities: a block inside the main part, inside a side part, prose and links by their share of the text.
INSIDE, ASIDE, PROSE, LINKED, SHORT = 3.0, 8.0, 2.0, 3.0, 1.0
# Edges: neighbours in page order (divided by their distance in the tree), children of one parent.
NEIGHBOUR, SIBLING = 1.8, 0.4


@dataclass
class Element:
    tag: str
    parent: Element | None
    depth: int
    kind: int = 0  # of the nearest ancestor that tells: 1 main, -1 side, 0 none
    silent: bool = False
    sided: bool = False  # itself or an ancestor is a side part of its own
    block: Element | None = None  # the nearest block element, itself included


@dataclass
class Block:
    parent: Element
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def names_of(attributes: dict[str, str | None]) -> set[str]:
    named = " ".join(attributes.get(a) or "" for a in ("class", "id", "role"))
    named = " ".join(name for name in named.split() if not STATE_NAME.match(name))
    return set(NAME_PARTS.split(CAMEL.sub(" ", named).lower()))


def kind_of(tag: str, attributes: dict[str, str | None], parent: Element) -> int:
    """1 main, -1 side, 0 neither: by tag and by the words in class, id and role."""
    names = names_of(attributes) if tag not in ("html", "body") else set()
    if tag in SIDE_TAGS or names & SIDE_NAMES:
        return -1
    header = tag == "header" or "header" in names and not names & MAIN_NAMES
    if header and parent.kind < 1 or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return -1
    if HIDDEN_STYLE.search(attributes.get("style") or ""):
        return -1
    # The main part may lie in a container with a misleading name, but not inside another side part of its own.
    if tag in MAIN_TAGS and not parent.sided:
        return 1
    if names & MAIN_NAMES and parent.kind == 0:
        return 1
    return parent.kind


class BlockReader(HTMLParser):
    """Cuts a page into blocks: runs of text not parted by a block element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = Element("", None, 0)
        self.at.block = self.at
        self.by_tag: dict[str, list[Element]] = {}  # open elements, the innermost last
        self.links = 0
        self.blocks: list[Block] = []
        self.open: Block | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.add(" ")
        if tag in BLOCK_TAGS:
            self.open = None
            if tag not in ("li", "dt", "dd", "tr", "td", "th"):
                self.close_until("p", BLOCK_TAGS - {"p"})
        for ended in IMPLIED_ENDS.get(tag, ()):
            self.close_until(ended, {"ul", "ol", "dl", "table", "tr", "select"} - ({"tr"} if ended == "tr" else set()))
        if tag in VOID_TAGS:
            return
        parent = self.at
        self.at = Element(tag, parent, parent.depth + 1, 0, parent.silent or tag in SILENT_TAGS)
        self.at.kind = kind_of(tag, dict(attrs), parent)
        self.at.sided = parent.sided or tag in SIDE_TAGS or self.at.kind < 0 < parent.kind
        self.at.block = self.at if tag in BLOCK_TAGS else parent.block
        self.by_tag.setdefault(tag, []).append(self.at)
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.open = None
        self.close_until(tag, {"article", "main", "body"} if tag not in MAIN_TAGS | {"html", "body"} else set())

    def close_until(self, tag: str, stops: set[str] | frozenset[str]) -> None:
        """Close the nearest open ``tag`` and what is open inside it, unless one of ``stops`` lies between."""
        if not self.by_tag.get(tag):
            return
        element = self.by_tag[tag][-1]
        if any(self.by_tag[s][-1].depth > element.depth for s in stops if self.by_tag.get(s)):
            return
        while self.at is not element.parent:
            self.links -= self.at.tag == "a"
            self.by_tag[self.at.tag].pop()
            self.at = self.at.parent

    def handle_data(self, data: str) -> None:
        if not self.at.silent:
            self.add(data)

    def add(self, data: str) -> None:
        if self.at.silent:
            return
        if self.open is None:
            if not data.strip():
                return
            self.open = Block(self.at.block)
            self.blocks.append(self.open)
        self.open.pieces.append(data)
        if self.links:
            self.open.linked += len(data)


def evidence(block: Block, text: str) -> float:
    """How much speaks for content (positive) or boilerplate."""
    share = min(1.0, block.linked / max(len(text), 1))
    words = text.count(" ") + 1
    prose = PROSE * min(1.0, words / 25) if SENTENCE.search(text) else 0.0
    score = prose - (LINKED * share if share > 0.5 and block.parent.kind < 1 else 0.0)
    if block.parent.kind > 0:
        return score + INSIDE
    if block.parent.kind < 0:
        return score - ASIDE
    return score - (SHORT if words < 10 and not block.parent.tag.startswith("h") else 0.0)


def tree_distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut. A positive score is the capacity from the source, a
    negative one that to the sink. Augments along shortest paths, all of one length in a round."""
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        used = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while used[a] < len(heads[a]):
                e = heads[a][used[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                used[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                used[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_blocks(html: str | None) -> list[str]:
    """The content blocks of a page in page order."""
    reader = BlockReader()
    reader.feed(html or "")
    reader.close()
    found = [(b, t) for b in reader.blocks if (t := b.text)]
    scores = [evidence(b, t) for b, t in found]
    edges: list[tuple[int, int, float]] = []
    last_child: dict[int, int] = {}
    for i, (block, _) in enumerate(found):
        if i:
            edges.append((i - 1, i, NEIGHBOUR / (1 + tree_distance(found[i - 1][0].parent, block.parent))))
        above = id(block.parent.parent)
        if above in last_child and last_child[above] != i - 1:
            edges.append((last_child[above], i, SIBLING))
        last_child[above] = i
    # A node that no flow from the source reaches and that nothing speaks against is boilerplate, too.
    return [t for (_, t), content in zip(found, minimum_cut(scores, edges)) if content]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_blocks of each of ``pages`` (page_id, url, html)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [main_blocks(html) for html in batch.column("html").to_pylist()]
            texts = ["\n".join(b) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(b) for b in blocks], pa.int32()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    return columns(pages, ("page_id", "url", "html")).mapInArrow(
        read, "page_id long, url string, text string, n_chars long, n_blocks int"
    )
