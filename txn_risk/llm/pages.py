"""Main text of web pages by composite text density.

Each node of a page's tree gets a density: characters per tag, adjusted by how many of its characters
and tags are links. Inline markup belongs to the text of its block: only blocks are summed and chosen. The node
with the largest sum of its children's densities is content; the least density on
its path from the root is the threshold. From the root down, of each node as dense as the threshold the
subtree with the largest sum is content as well, and what it leaves is searched in turn. Headings that
lead content inside its article or main come with it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the markup language.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# A start of the first closes an open one of the second, up to a boundary.
CLOSES = {
    **dict.fromkeys(BLOCKS - {"li", "dd", "dt", "td", "th", "tr", "body", "html"}, ("p",)),
    "li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "option": ("option",),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOUNDS = frozenset("article aside body div html main section table ul ol dl td th blockquote form nav".split())
# Never part of an article.
OUT = frozenset(
    "script style noscript template nav header footer aside button select option textarea input label "
    "iframe object embed svg canvas head title dialog menu xmp noembed noframes".split()
)
# Words of a class, id or role that mark what is not the article: a name is made of them alone, or of them
# and of words that say no more than where or what kind of box.
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disclaimer discussion footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promotion related replies reply respond share sharing "
    "sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo search".split()
)
BOX_NAMES = frozenset(
    "area bar bottom box block container global inner item items left links list outer posts primary right "
    "secondary section site slot top unit wrapper x".split()
)
# A form or a node so named is no noise if it holds this share (of 4) of the page's text and every article.
MOST = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAMES = re.compile(r"[a-z]+")


class Node:
    __slots__ = (
        "tag", "parts", "chars", "link_chars", "tags", "link_tags", "out", "marked", "parent", "density", "sum", "peak",
        "block",
    )

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.marked = False  # noise by its name, unless it is found to hold the page
        self.parts: list = []  # texts and nodes in page order
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        self.block = False  # a block, or holds one
        self.peak = self  # the node of its subtree with the largest sum, the first of equal ones


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes hide a node, and whether its class, id or role names noise."""
    named = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, named
        if name in ("class", "id", "role"):
            for one in value.split():
                words = set(_NAMES.findall(one))
                named = named or bool(words & OUT_NAMES) and words <= OUT_NAMES | BOX_NAMES
    return False, named


def _settle_marked(root: Node) -> None:
    """Marked nodes are out, but for those that hold most of the page."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node) and not p.out)
    if not any(node.marked for node in order):
        return
    chars: dict[int, int] = {}
    articles: dict[int, int] = {}  # characters in article and main
    for node in reversed(order):
        own = [p for p in node.parts if isinstance(p, Node) and not p.out]
        k = id(node)
        chars[k] = sum(chars[id(p)] for p in own) + sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        articles[k] = chars[k] if node.tag in ("article", "main") else sum(articles[id(p)] for p in own)
    for node in order:
        if node.marked:
            inside = 4 * chars[id(node)] >= MOST * chars[id(root)] and articles[id(node)] == articles[id(root)]
            node.out = not inside


def parse(page: str) -> Node:
    """The tree of a page; unclosed and stray tags are mended as browsers do."""
    root = at = Node("html", None, False)
    position, size = 0, len(page)

    def add_text(text: str) -> None:
        if text and not at.out:
            at.parts.append(html.unescape(text))

    while position < size:
        found = _TOKEN.search(page, position)
        if not found:
            add_text(page[position:])
            break
        add_text(page[position:found.start()])
        position = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            node = at
            while node is not root and node.tag != tag:
                # A stray end of an inline tag does not close a block around it.
                if node.tag in BOUNDS and tag not in BLOCKS:
                    node = root
                    break
                node = node.parent
            if node is not root:
                at = node.parent
            continue
        for closed in CLOSES.get(tag, ()):
            node = at
            while node is not root and node.tag != closed and node.tag not in BOUNDS:
                node = node.parent
            if node is not root and node.tag == closed:
                at = node.parent
        if tag in ("html", "body") and at is root:
            continue
        hidden, named = _marks(found[3]) if found[3] else (False, False)
        node = Node(tag, at, at.out or tag in OUT or hidden)
        node.marked = named or tag == "form"
        at.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, position)
            position = page.find(">", end.start()) + 1 or size if end else size
        elif tag not in VOID and not found[3].endswith("/"):
            at = node
    _settle_marked(root)
    return root


def _measure(root: Node) -> None:
    """Characters, tags and densities of every wanted node, children before parents."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append((node, linked))
        for part in node.parts:
            if isinstance(part, Node) and not part.out:
                stack.append((part, linked or part.tag == "a"))
    for node, linked in reversed(order):
        for part in node.parts:
            if isinstance(part, Node):
                if not part.out:
                    node.chars += part.chars
                    node.link_chars += part.link_chars
                    node.tags += part.tags + 1
                    node.link_tags += part.link_tags + (part.tag == "a")
            else:
                n = len(part.strip())
                node.chars += n
                node.link_chars += n if linked else 0
    share = root.link_chars / max(1, root.chars)
    for node, _ in reversed(order):
        c, t = node.chars, max(1, node.tags)
        lc, lt = node.link_chars, max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            inner = c / max(1, lc) * t / lt
            node.density = c / t * max(0.0, math.log(max(inner, 1e-9)) / base if base > 0 else 0.0)
        own = [p for p in node.parts if isinstance(p, Node) and p.block and not p.out]
        node.block = bool(own) or node.tag in BLOCKS
        node.sum = sum(p.density for p in own)
        for part in own:
            if part.peak.sum > node.peak.sum:
                node.peak = part.peak


def content(root: Node) -> list[Node]:
    """The chosen subtrees in page order."""
    _measure(root)
    best = root.peak
    if not best.sum:
        return [root]
    threshold, at = best.density, best
    while at is not None:
        threshold = min(threshold, at.density)
        at = at.parent
    taken: dict[int, Node] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.chars and node.block and node.density >= threshold:
            taken[id(node.peak)] = node.peak
        if id(node) not in taken:
            stack.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.out)
    # In page order, each with the nearest article or main around it, and the headings between.
    found: list[tuple[Node, Node | None]] = []
    around: list[tuple[Node, Node | None]] = [(root, None)]
    while around:
        node, article = around.pop()
        if id(node) in taken or article and node.tag in HEADINGS:
            found.append((node, article))
        else:
            article = node if node.tag in ("article", "main") else article
            around.extend((p, article) for p in reversed(node.parts) if isinstance(p, Node) and not p.out)
    out: list[Node] = []
    led: set[int] = set()  # articles with content after this place
    for node, article in reversed(found):
        if id(node) in taken or id(article) in led:
            out.append(node)
            led.add(id(article))
    return out[::-1]


def main_text(page: str | None) -> str:
    """Text of the content's blocks, white space in a block made one blank, blocks joined by a blank."""
    if not page:
        return ""
    blocks: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            blocks.append(text)

    for top in content(parse(page)):
        stack: list = [top]
        while stack:
            part = stack.pop()
            if part is None:
                close()
            elif isinstance(part, str):
                held.append(part)
            elif not part.out:
                block = part.tag in BLOCKS
                if block:
                    close()
                    stack.append(None)
                if part.tag == "br":
                    held.append(" ")
                stack.extend(reversed(part.parts))
        close()
    return " ".join(blocks)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` for each page.

    The whole page is read. A null or empty page, or one without content, gives an empty text of 0
    code points; a null id or url is carried on; repeated rows give repeated results; an empty table
    gives no rows; other columns are ignored. Pages of any depth are walked
    without recursion.
    """
    source = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [main_text(page) for page in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()),
                     pa.array([len(t) for t in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return source.mapInArrow(
        read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )


__all__ = ["extract", "main_text", "parse"]
