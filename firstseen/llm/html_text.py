"""Main text of web pages by composite text density.

A page is read into a tree of block elements. Elements that by name or role are
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
comments are cut first. A class or id that says so only marks an element, since
layouts (``no-sidebar``) and topics (``related-work``) use the same words: what the
element holds of the page decides. So it does for forms, menus and the like around
a whole page. Each node then has a density: its characters
per tag, lowered where links hold much of the text, against the page's own share
of link text. Nodes are looked at from the body down, along paths whose nodes
are all at least as dense as the body; the one with the largest sum of its
children's densities is the main text. An article around it is taken whole; where
there is none, paragraphs and headings next to it belong to it as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
CUT = frozenset(
    "head script style textarea title noscript iframe template svg math xmp noembed noframes button select option "
    "dialog object video audio canvas".split()
)
# Cut as well, unless the page's text is inside.
FURNITURE = frozenset("nav footer aside form menu".split())
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
CUT_OUTSIDE_ARTICLE = frozenset(["header"])
KEEP = frozenset("html body main article".split())
CUT_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert menu menubar form".split())
CLOSED_BY_SAME = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "table", "th": "table", "option": "select"}
# Words of a class or id, between its dashes and underscores.
CUT_WORDS = re.compile(
    r"ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promotion|nav|navbar|"
    r"navigation|menus?|topbar|sidebars?|footer|header|masthead|cookies?|consent|gdpr|notices?|popups?|modal|overlay|"
    r"newsletters?|subscribe|subscription|signup|login|share|sharing|social|comments?|disqus|replies|respond|related|"
    r"recommended|breadcrumbs?|pagination|pager|widgets?|toolbar|skip"
)
# Words that before or after those leave their sense as it is.
BEFORE = frozenset("site top bottom left right global primary secondary main mobile desktop sticky google user".split())
AFTER = frozenset(
    "area articles author bar block body bottom box button buttons container content form icons inner item items label left "
    "link links list meta panel posts right section slot stories text thread title top unit wrap wrapper".split()
)
# Before these a word for the main text makes a part of it: an article's header.
OF_TEXT = frozenset("article blog entry news post story".split())
PARTS_OF_TEXT = frozenset("header footer notice notices menu menus title".split())
# What a page's main text has, of furniture only some.
LANDMARKS = frozenset("h1 main article".split())
# A marked element with this share of the page's unlinked characters may be a layout
# around the text; it is one if what lies outside is less than that part of it.
LARGE, LEFT_OUTSIDE = 0.5, 0.25
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)",
    re.DOTALL,
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


class _Node:
    __slots__ = ("name", "parent", "cut", "mark", "in_article", "chars", "tags", "link_chars", "links", "landmarks", "paragraphs", "first", "last", "sum")

    def __init__(self, name: str, parent: _Node | None, cut: bool, mark: int, first: int):
        self.name, self.parent, self.cut, self.mark, self.first, self.last = name, parent, cut, mark, first, -1
        self.landmarks, self.paragraphs = int(name in LANDMARKS), int(name in PARAGRAPHS)
        self.in_article = name in ("article", "main") or (parent is not None and parent.in_article)
        self.chars = self.tags = self.link_chars = self.links = 0
        self.sum = 0.0

    def density(self, page_chars: int, page_link_chars: int) -> float:
        """Characters per tag; a node without links keeps all of it."""
        if not self.chars:
            return 0.0
        tags, links = max(self.tags, 1), max(self.links, 1)
        link_chars, other = max(self.link_chars, 1), max(self.chars - self.link_chars, 1)
        base = log(self.chars / other * self.link_chars + page_link_chars / max(page_chars, 1) * self.chars + e)
        plain = self.chars / tags
        return plain * max(log(max(self.chars / link_chars * tags / links, 1.0)), 0.0) / log(max(base, e)) if base > e else plain


@lru_cache(4096)
def _strength(value: str) -> int:
    """2 if a word of a class or id says furniture, 1 if part of a word does."""
    found = 0
    for word in value.lower().split():
        parts = [part for part in re.split("[-_]+", word) if part]
        at = [k for k, part in enumerate(parts) if CUT_WORDS.fullmatch(part)]
        if not at:
            continue
        first, last = at[0], at[-1]
        before = BEFORE if parts[first] in PARTS_OF_TEXT else BEFORE | OF_TEXT
        plain = all(part in before for part in parts[:first]) and all(
            part in AFTER or CUT_WORDS.fullmatch(part) or any(c.isdigit() for c in part) for part in parts[first:]
        )
        found = max(found, 2 if plain else 1)
    return found


def _kind(name: str, rest: str, parent: _Node | None) -> tuple[bool, int]:
    """Is an element cut, and how strongly is it marked: 1 or 2 by class or id, 3 by
    name, 4 by its role or as a form, which may be around the whole page?"""
    if parent is not None and parent.cut or name in CUT:
        return True, 0
    if name in FURNITURE or (name in CUT_OUTSIDE_ARTICLE and not (parent and parent.in_article)):
        return False, 4 if name == "form" else 3
    if name in KEEP or "=" not in rest:
        return False, 0
    mark = 0
    for key, *values in _MARKS.findall(rest):
        value = values[0] or values[1] or values[2]
        if key.lower() == "role":
            if value.strip().lower() in CUT_ROLES:
                return False, 4
        else:
            mark = max(mark, _strength(value))
    return False, mark


class _Page:
    """Blocks of text in page order, and the tree of block elements around them."""

    def __init__(self, html: str):
        self.root = _Node("html", None, False, 0, 0)
        self.nodes = [self.root]
        # Parts of text; None ends a block.
        self.parts: list[str | None] = []
        self._open: list[tuple[str, _Node | None]] = []
        # Where the open elements of a name are, and the open block elements.
        self._places: dict[str, list[int]] = {}
        self._blocks: list[int] = []
        self._push("html", self.root)
        self._links = 0
        self._read(html)
        while self._open:
            self._pop()

    def _node(self) -> _Node:
        return self._open[self._blocks[-1]][1]

    def _push(self, name: str, node: _Node | None) -> None:
        self._places.setdefault(name, []).append(len(self._open))
        if node is not None:
            self._blocks.append(len(self._open))
        self._open.append((name, node))

    def _pop(self) -> None:
        name, node = self._open.pop()
        self._places[name].pop()
        if node is not None:
            self._blocks.pop()
            self.parts.append(None)
            node.last = len(self.parts)
        elif name == "a":
            self._links -= 1

    def _close(self, name: str, until: frozenset | set = frozenset()) -> None:
        """Close the innermost element of this name, if none of ``until`` is further in."""
        places = self._places.get(name)
        if not places or not places[-1]:
            return
        at = places[-1]
        if any(self._places[other][-1] > at for other in until if self._places.get(other)):
            return
        if name in INLINE and self._blocks[-1] > at:
            return
        while len(self._open) > at:
            self._pop()

    def _text(self, text: str) -> None:
        node = self._node()
        if node.name == "head" and not text.isspace():
            # Text has no place in the head: the body begins.
            self._close("head")
            node = self._node()
        if node.cut or not text:
            return
        text = unescape(text)
        self.parts.append(text)
        size = len(text) - text.count(" ") if text.isspace() else len(text)
        node.chars += size
        if self._links:
            node.link_chars += size

    def _start(self, name: str, rest: str) -> None:
        if name not in HEAD and self._node().name == "head":
            self._close("head")
        if name in INLINE:
            node = self._node()
            if name == "br":
                self._text(" ")
            elif name == "a":
                self._close("a")
                node.tags += 1
                node.links += 1
                self._links += 1
            if name not in VOID:
                self._push(name, None)
            return
        if name in ("html", "body") and self._places.get(name):
            return
        self._close("p", {"button", "td", "th", "caption", "object"})
        if name in CLOSED_BY_SAME:
            for same in ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,):
                self._close(same, set(CLOSED_BY_SAME[name].split()))
        parent = self._node()
        self.parts.append(None)
        if name in VOID:
            parent.tags += 1
            return
        node = _Node(name, parent, *_kind(name, rest, parent), len(self.parts))
        self.nodes.append(node)
        self._push(name, node)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            found = _TAG.search(html, at)
            if not found:
                self._text(html[at:])
                return
            if found.start() > at:
                self._text(html[at : found.start()])
            at = found.end()
            name = found["name"] or found["name2"]
            if not name:
                continue
            name = name.lower()
            if found["end"] or found["end2"]:
                self._close(name)
                continue
            rest = found["rest"] if found["rest"] is not None else found["rest2"]
            self._start(name, rest)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
                at = end.start() if end else size

    def _densest(self) -> _Node:
        """The node with the largest sum of densities; sums up what nodes hold."""
        for node in reversed(self.nodes[1:]):
            if not node.cut:
                above = node.parent
                above.chars += node.chars
                above.tags += node.tags + 1
                above.link_chars += node.link_chars
                above.links += node.links
                above.landmarks += node.landmarks
                above.paragraphs += node.paragraphs
        body = next((node for node in self.nodes if node.name == "body"), self.root)
        density = {}
        for node in self.nodes:
            if not node.cut:
                density[node] = node.density(body.chars, body.link_chars)
                if node.parent is not None:
                    node.parent.sum += density[node]
        # Parents come before their children.
        dense, best = {body}, body
        for node in self.nodes[self.nodes.index(body) + 1 :]:
            if node.parent in dense and not node.cut and density[node] >= density[body]:
                dense.add(node)
                if node.sum > best.sum:
                    best = node
        return best

    def _furniture(self, node: _Node, around: set[_Node]) -> bool:
        """Is a marked node furniture? ``around`` holds the densest text and what is around it."""
        if node.mark == 1:
            return node not in around and not node.landmarks and 2 * node.link_chars >= node.chars
        own, page = node.chars - node.link_chars, self.root.chars - self.root.link_chars
        alone, other = node.landmarks, self.root.landmarks - node.landmarks
        if own < LARGE * page:
            return not (node in around and alone and not other)
        if bool(alone) != bool(other):
            return bool(other)
        return page - own >= LEFT_OUTSIDE * own

    def _cut_furniture(self) -> None:
        """Cut elements that by name or role are furniture, but not around the text.

        The text is what lies in no such element. An element holds the page's text
        if hardly any lies outside, and its headings or article inside.
        """
        named = [node for node in self.nodes if node.mark >= 3]
        if not named:
            return
        # Unlinked characters, landmarks and paragraphs in no named element further in.
        free = {}
        for node in reversed(self.nodes):
            if node.cut:
                continue
            own = free.setdefault(node, [0, 0, 0])
            own[0] += node.chars - node.link_chars
            own[1] += node.name in LANDMARKS
            own[2] += node.name in PARAGRAPHS
            if node.mark < 3 and node.parent is not None:
                above = free.setdefault(node.parent, [0, 0, 0])
                for k in range(3):
                    above[k] += own[k]
        outside = list(free[self.root])
        for node in named:
            chars, landmarks, paragraphs = free[node]
            if outside[0] >= LEFT_OUTSIDE * chars or outside[1] or not (landmarks or paragraphs):
                continue
            path, above = [], node
            while above is not None:
                if above.mark >= 3:
                    path.append(above)
                above = above.parent
            # Without a heading only forms and roles are taken for the page's frame.
            if landmarks or all(one.mark == 4 for one in path):
                for one in path:
                    outside = [x + y for x, y in zip(outside, free[one], strict=True)]
                    one.mark = 0
        for node in self.nodes:
            node.cut = node.cut or node.mark >= 3 or (node.parent is not None and node.parent.cut)

    def _with_neighbours(self, best: _Node) -> _Node:
        """The subtree of the main text with the paragraphs next to it.

        Around the densest subtree up to the body, what holds a paragraph or a heading
        and is no list of links belongs to the text; what else is there is cut.
        """
        children: dict[_Node, list[_Node]] = {}
        for node in self.nodes[1:]:
            if not node.cut:
                children.setdefault(node.parent, []).append(node)
        top, other = best, []
        below, above = best, best.parent
        while above is not None and below.name != "body":
            for node in children[above]:
                if node is below or not node.chars:
                    continue
                if node.paragraphs and 2 * node.link_chars < node.chars:
                    top = above
                else:
                    other.append(node)
            below, above = above, above.parent
        for node in other:
            node.cut = True
        return top

    def main(self) -> _Node:
        """The node that holds the main text."""
        self._cut_furniture()
        marked = any(node.mark for node in self.nodes)
        held = [(node.chars, node.tags, node.link_chars, node.links, node.landmarks, node.paragraphs) for node in self.nodes]
        best = self._densest()
        if marked:
            around, above = set(), best
            while above is not None:
                around.add(above)
                above = above.parent
            furniture = {node for node in self.nodes if node.mark and not node.cut and self._furniture(node, around)}
            if furniture:
                for node, values in zip(self.nodes, held, strict=True):
                    node.cut = node.cut or node in furniture or (node.parent is not None and node.parent.cut)
                    node.chars, node.tags, node.link_chars, node.links, node.landmarks, node.paragraphs = values
                    node.sum = 0.0
                best = self._densest()
        article, above = None, best
        while above is not None:
            if above.name in ("article", "main"):
                article = above
            above = above.parent
        return article or self._with_neighbours(best)

    def blocks(self, node: _Node) -> Iterator[str]:
        parts, at = [], node.first
        for other in self.nodes:
            if other.cut and at <= other.first and other.last <= node.last:
                parts += self.parts[at : other.first]
                at = other.last
        held: list[str] = []
        for part in [*parts, *self.parts[at : node.last], None]:
            if part is not None:
                held.append(part)
            elif held:
                if text := " ".join("".join(held).split()):
                    yield text
                held = []


def main_text(html: str | None) -> str:
    """The main text, blocks joined by an empty line; empty if there is none."""
    if not html:
        return ""
    page = _Page(html)
    return "\n\n".join(page.blocks(page.main()))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(html) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page, without a shuffle.

    A null page is empty; null ids and addresses pass through; rows that repeat
    stay; other columns are left behind; an empty table gives no row. Pages are read
    whole, in time and memory that grow with their length, however deep or damaged.
    """
    columns = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return columns.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
