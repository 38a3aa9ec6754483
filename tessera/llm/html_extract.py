"""Main text of web pages by tree scoring.

Method: the page becomes a tree; paragraphs give points for their length and
commas to their ancestors, less with each level; a container's points are
discounted by its link density; the best container and those of its siblings that
score well, or read like prose, are kept, whatever their tag, with headings and
short paragraphs.  When sections, articles or large divs beside one of its
ancestors carry on the article, that ancestor's siblings are kept likewise.  Elements that are never article text
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments) are left out before, lists of nothing but short links after.  Names count
by their parts, written apart or together.  A name alone leaves out no ``main``, and no
element that holds most of the page's prose and is an ``article`` or has another name
of an article's container, nor one that holds all there is.  A button inside a
sentence is text.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line feed in page order; empty blocks
are left out.

Scale: no shuffle; a page is read by itself in linear time, whatever its length
or nesting (no recursion).

Defined cases: null and empty pages have the empty text.  Markup without any
element is one block of text.  A tag cut off by the page's end is dropped, a
character reference that is cut off stays as written.  Repeated rows and null ids
are rows of their own; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import c

#: What may stand in a tag after its name: a quote opens a value only after "=".
_REST = r"(?>[^>=]+|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?)*+"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)({_REST})>|</?[A-Za-z]{_REST}\Z", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z][\w-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article's text.
LEFT_OUT = frozenset(
    "script style title textarea iframe noscript noembed noframes template head nav header footer aside form button select option datalist dialog"
    " menu svg math canvas object embed applet audio video map input label fieldset".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
#: Parts of class and id names, written apart or together, that mark such an element: adverts, notices, comments and the like,
ALWAYS = re.compile(
    r"ads?|ad(box|slot|unit|block|space|sense)s?|advert\w*|banners?|breadcrumbs?|(user)?comments?(list|form|box|area|section|thread|body|wrap|wrapper|count)?|disqus\w*"
    r"|respond|responses?|repl(y|ies)|discussions?|cookies?(bar|box|notice|banner|consent)?|consent|gdpr|login|modal|newsletter\w*|notices?|alerts?|pager|pagination|paywall"
    r"|popups?|promos?|promot(ion|ions|ed)|promobox|recommend\w*|related(posts|links|articles|stories|content)?|share(d|bar|links|buttons|box|icons)?|sharing|signup|skip"
    r"|social(bar|links|icons|media|share)?|sponsor(s|ed|ship|box)?|subscri(be|ption|bers?)\w*|toolbars?"
)
#: and parts of the page's frame.
FRAME = re.compile(
    r"(left|right|main|top|bottom|sub|site|page|global|primary|secondary)?(footer|header|sidebar|navbar|nav|navigation|menu)s?|mastheads?|side(bar|nav|col|column)?\w*|aside"
    r"|widgets?(area|box|wrap)?|topbar|foot(er)?(links|nav|bar|wrap|menu|er)|nav(bar|igation|links|menu|list)\w*"
)
CONTAINER = frozenset("article body col column container content entry layout main page post story text wrapper wrap".split())
#: Parts that say something about the page, not what the element is ("no-sidebar", "ad-free", "category-social"),
ABOUT = frozenset("no not has have with without free category cat tag type format topic".split())
#: and parts with which a header is an article's own.
OF_ARTICLE = frozenset("article entry post story content".split())
#: Share of link text beyond which a list holds nothing but links; references have authors and years beside theirs.
LINK_LIST = 0.9
#: Average text of a link in a list of sources, at least; menus and related stories are shorter, and are no numbered lists.
SOURCE_TEXT = 30
PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption h1 h2 h3 h4 h5 h6".split())
#: Start tags that end open elements, if nothing but divs, paragraphs and inline elements lie between.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th"), "option": ("option",),
}


class Node:
    __slots__ = ("block", "commas", "drop", "inner", "items", "length", "link", "links", "named", "parent", "score", "special", "tag")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, named: str = ""):
        self.tag, self.parent, self.drop, self.named = tag, parent, drop, named
        self.items: list[Node | str] = []
        self.score, self.length, self.link, self.commas, self.links = 0.0, 0, 0, 0, 0
        # The block around (or this one) with its open inline elements, and the nearest element that ends implied ends.
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.inner: dict[str, int] = {}
        self.special = self if parent is None or tag == "option" or (tag in BLOCK and tag not in ("address", "div", "p")) else parent.special


def _dropped(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is left out for sure, and what its names say: "" (nothing), "other" or "container" (words of both kinds)."""
    if tag in LEFT_OUT:
        return True, ""
    if not attributes or tag in ("body", "html"):
        return False, ""
    named, container = False, tag == "article"
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id"):
            for token in value.split():
                bad, around = _name(token, tag)
                named, container = named or bad, container or around
        elif name == "role" and value.lower() in ROLES:
            return True, ""
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, ""
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, ""
    return False, "" if not named or tag == "main" else "container" if container else "other"


@lru_cache(maxsize=50_000)
def _name(token: str, tag: str) -> tuple[bool, bool]:
    """Whether one class or id marks an element that is left out, and whether it names an article's container."""
    parts = [w.lower() for w in WORD.findall(token)]
    if not parts or ABOUT.intersection(parts):
        return False, bool(CONTAINER.intersection(parts))
    bad = [p for p in parts if ALWAYS.fullmatch(p) or FRAME.fullmatch(p)]
    if bad in (["header"], ["headers"]) and OF_ARTICLE.intersection(parts):
        bad = []  # an article's own header
    if tag == "section" and bad in (["discussion"], ["discussions"]):
        bad = []  # a section of a paper
    return bool(bad), not bad and bool(CONTAINER.intersection(parts))


def _prose_lengths(root: Node) -> dict[int, int]:
    """Characters outside links of all nodes that are not left out."""
    out: dict[int, int] = {}
    for node, ending in _walk(root):
        if ending:
            own = sum(len(" ".join(x.split())) if isinstance(x, str) else out.get(id(x), 0) for x in node.items)
            out[id(node)] = 0 if node.tag == "a" else own
    return out


def _keep_buttons(root: Node) -> None:
    """A button inside a sentence is a word of it."""
    for node, ending in _walk(root):
        if not ending:
            for x in node.items:
                if isinstance(x, Node) and x.tag == "button" and x.drop:
                    text = sum(len(y.strip()) for y in node.items if isinstance(y, str))
                    x.drop = node.block.tag not in PARAGRAPHS or text < 25 or any(isinstance(y, Node) for y in x.items)


def drop_named(root: Node) -> None:
    """Leave out the elements that their names mark, but not those that hold most of the page's prose.

    Names without a word of an article's container spare an element only when no
    prose is left without it.
    """
    named = [x for x, ending in _walk(root) if ending and x.named]
    if not named:
        return
    whole = _prose_lengths(root)
    others = [x for x in named if x.named == "other"]
    for x in others:
        x.drop = True
    lengths = _prose_lengths(root)
    if others and not lengths[id(root)]:
        for x in others:
            x.drop = 2 * whole[id(x)] <= whole[id(root)]
        lengths = _prose_lengths(root)
    for x in named:
        if x.named == "container":
            x.drop = 2 * lengths.get(id(x), 0) <= lengths[id(root)]


def parse(page: str) -> Node:
    root = Node("html", None)
    now, at, size = root, 0, len(page)
    blocks_open: dict[str, int] = {}  # open block elements by tag

    def close(node: Node) -> Node:
        """End ``node`` and all that is open in it; returns what is around."""
        x = now
        while True:
            held = blocks_open if x.block is x else x.block.inner
            held[x.tag] -= 1
            if x is node:
                return node.parent
            x = x.parent

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            now.items.append(page[at:])
            break
        if m.start() > at:
            now.items.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            # The end of an inline element does not end the blocks around.
            if (blocks_open if tag in BLOCK else now.block.inner).get(tag, 0):
                node = now
                while node.tag != tag:
                    node = node.parent
                now = close(node)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in ("html", "body"):
            continue
        if tag in _ENDS:
            node, last = now.special, None
            while node.parent is not None and node.tag in _ENDS[tag]:
                node, last = node.parent.special, node
            if last is not None:
                now = close(last)
        elif tag in BLOCK:
            node = now.block
            if node.tag == "p" or (_HEADING.fullmatch(node.tag) and _HEADING.fullmatch(tag)):
                now = close(node)
        child = Node(tag, now, *_dropped(tag, m[3]))
        now.items.append(child)
        if tag not in VOID:  # a slash ends no HTML element, but drawings' ones
            if m[3].endswith("/") and tag in ("svg", "math"):
                continue
            now = child
            held = blocks_open if child.block is child else child.block.inner
            held[tag] = held.get(tag, 0) + 1
    _keep_buttons(root)
    drop_named(root)
    return root


_HEADING = re.compile("h[1-6]")


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """(node, whether it ends here) of all nodes that are not left out, in page order."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, ending = stack.pop()
        yield node, ending
        if not ending:
            stack.append((node, True))
            stack.extend((x, False) for x in reversed(node.items) if isinstance(x, Node) and not x.drop)


def _points(length: int, commas: int) -> float:
    return 1 + commas + min(length / 100, 3) if length >= 25 else length / 100


def score(root: Node) -> list[Node]:
    """Measure all nodes and pass the paragraphs' points up; returns the scored containers."""
    scored: dict[int, Node] = {}
    own: dict[int, tuple[int, int]] = {}
    for node, ending in _walk(root):
        if not ending:
            continue
        length = commas = 0
        for x in node.items:
            if isinstance(x, str):
                text = " ".join(x.split())
                length += len(text)
                commas += text.count(",") + text.count("，") + text.count("、")
        inline, inline_commas = length, commas
        for x in node.items:
            if isinstance(x, Node) and not x.drop:
                node.length += x.length
                node.link += x.link
                node.links += x.links
                node.commas += x.commas
                if x.tag not in BLOCK:
                    inline += own[id(x)][0]
                    inline_commas += own[id(x)][1]
        node.length += length
        node.commas += commas
        if node.tag == "a":
            node.link, node.links = node.length, 1
        own[id(node)] = (inline, inline_commas)
        if node.tag not in BLOCK and node.parent is not None:
            continue
        # Text that stands directly in a container counts as one paragraph of it;
        # a div without blocks is a paragraph.
        if inline:
            prose = 1 - node.link / node.length if node.length else 0
            points = _points(inline, inline_commas) * prose
            leaf = node.tag in PARAGRAPHS or (node.tag == "div" and not any(isinstance(x, Node) and x.tag in BLOCK and not x.drop for x in node.items))
            up = node.parent if leaf and node.parent is not None else node
            level = 0
            while up is not None and level < 6:
                if up.tag in BLOCK or up.parent is None:
                    up.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                    scored[id(up)] = up
                    level += 1
                up = up.parent
    return list(scored.values())


def _density(node: Node) -> float:
    return node.link / node.length if node.length else 0.0


def main_nodes(root: Node) -> list[Node]:
    """The best container or the ancestor it shares with the article's other parts; what is not kept of that is dropped."""
    scored = score(root)
    if not scored:
        return []
    best = max(scored, key=lambda x: x.score * (1 - _density(x)))
    if best.parent is None:
        return [best]
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    # The common ancestor of an article that is spread over siblings, at any level.
    level = 1
    for k in range(1, len(path)):
        branch = path[k - 1]
        if branch.tag in ("article", "main") or any(_like(x, branch) for x in path[k].items):
            level = k
    least = max(10.0, 0.2 * best.score * (1 - _density(best)))
    for k in range(1, level + 1):
        inline = [x for x in path[k].items if isinstance(x, Node) and x.tag not in BLOCK and not x.drop]
        bare = sum(len(x.strip()) for x in path[k].items if isinstance(x, str)) > sum(x.link for x in inline)
        for x in path[k].items:
            if isinstance(x, Node) and x is not path[k - 1] and x.score * (1 - _density(x)) < least and not (bare if x.tag not in BLOCK and x.link else _prose(x)):
                x.drop = True
    return [path[level]]


def _prose(x: Node) -> bool:
    return _density(x) < 0.25 and (x.length > 80 or x.commas > 0 or x.score > 0 or x.tag in PARAGRAPHS or x.tag not in BLOCK)


def _like(x: Node | str, branch: Node) -> bool:
    """A sibling that carries on the article of ``branch``."""
    if not isinstance(x, Node) or x is branch or x.drop or x.tag != branch.tag or x.tag not in ("section", "article", "div"):
        return False
    return _density(x) < 0.25 and x.score > 0 and (x.tag != "div" or x.score >= 10)


def _link_list(node: Node) -> bool:
    """A menu or a list of other pages: short links and nothing beside them.  Sources have long texts or numbers, and one link is no list."""
    if node.tag not in ("ul", "ol", "dl", "table", "div", "section") or not node.length or _density(node) <= LINK_LIST:
        return False
    return node.links > 1 and node.tag != "ol" and node.length < SOURCE_TEXT * node.links or (node.links == 1 and node.length < SOURCE_TEXT)


def blocks_of(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list[Node | str | None] = [top]
        flush()
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                held.append(x)
            elif x.tag == "br":
                held.append(" ")
            elif not x.drop and not (x is not top and _link_list(x)):
                if x.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(x.items))
        flush()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(blocks_of(main_nodes(parse(page)))) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(c(id_col).cast("long").alias("page_id"), c(url).alias("url"), c(page).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
