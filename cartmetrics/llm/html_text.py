"""Main text of web pages by composite text density.

A page is read into a tree. Parts that by tag or role are menus, notices, adverts, comments and the like
don't count, nor do those that are by name, unless they hold most of the page's text. Names that an article may use for
its own parts (legal, side, related, ...) only tell something about parts that are mostly links or stand beside the text.
Every other node gets its number of characters per tag, adjusted by the share of link text; a node's sum is that of its
children's densities. The search starts at the body: the path from it to the densest subtree gives the threshold, and
among the nodes at or above it the one with the largest sum is the main part.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks

#: Fixed values of HTML: elements without content, with raw text, starting a new block, closing an open p.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot dd dt li body html".split())
#: A start tag ends an open element of these names, up to the nearest of the given containers.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Elements that aren't main text, and the same by role and by words of class and id.
BOILERPLATE = frozenset("head nav header footer aside form button select dialog object embed canvas audio video menu".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar side rail widget footer header masthead toolbar cookie cookies consent gdpr notice alert"
    " popup modal overlay newsletter subscribe signup login share sharing social related recommended comment comments respond"
    " reply replies disqus discussion pagination pager skip copyright legal disclaimer paywall form search".split()
)
#: Of these, names that parts of an article have, too.
WEAK_NAMES = frozenset("side rail header related recommended discussion copyright legal disclaimer".split())
#: Names that hold the page rather than part of it are kept even if another word of theirs is listed above.
KEPT_NAMES = frozenset("article content main post story entry body text page".split())
#: Words before a listed one that say what a part has or lacks, not what it is.
HAVING = frozenset("has have no not non with without hide hidden show".split())
LANDMARKS = frozenset("article main".split())

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    tag: str
    skip: bool = False
    named: str = ""
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    sum: float = 0.0


def _is_boilerplate(tag: str, raw: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is boilerplate by tag, role or style, and if by its names: strong or weak. The header of an
    article is a part of it."""
    if tag in BOILERPLATE and not (tag == "header" and in_article):
        return True, ""
    if not raw.strip() or tag in ("html", "body"):
        return False, ""
    attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)}
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return True, ""
    if attributes.get("role", "").lower() in ROLES:
        return True, ""
    named = ""
    for name in ("class", "id"):
        for word in attributes.get(name, "").split():
            parts = [p.lower() for p in _NAME_PARTS.findall(word)]
            said = {p for i, p in enumerate(parts) if not HAVING & set(parts[:i])}
            if said & NAMES and not (said & KEPT_NAMES and not said & {"comment", "comments"}):
                if said & NAMES - WEAK_NAMES:
                    return False, "strong"
                named = "weak"
    return False, named


def skip_named(root: Node) -> None:
    """Skips what is boilerplate by name. A part with most of the page's text stays, unless an article or main element
    with text is outside of it. A weak name counts if half of the part's text is links, or if no other element than the
    page holds both it and most of the text."""
    nodes = list(_walk(root))
    if not any(n.named for n in nodes):
        return
    text, linked, marks = {}, {}, {}
    for node in reversed(nodes):
        inner = [c for c in node.children if isinstance(c, Node) and not c.skip]
        text[id(node)] = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str)) + sum(text[id(c)] for c in inner)
        linked[id(node)] = text[id(node)] if node.tag == "a" else sum(linked[id(c)] for c in inner)
        marks[id(node)] = sum(marks[id(c)] for c in inner) + (node.tag in LANDMARKS and text[id(node)] > 0)
    for node in nodes:
        if not node.named:
            continue
        around, inside, up = 0, False, node.parent
        while up is not None:
            around += up.tag in LANDMARKS
            inside = inside or up.tag in LANDMARKS or up is not root and 2 * (text[id(up)] - text[id(node)]) > text[id(root)]
            up = up.parent
        most = 2 * text[id(node)] > text[id(root)]
        node.skip = not most or marks[id(root)] > marks[id(node)] + around or around > 0
        if node.named == "weak" and inside and 2 * linked[id(node)] < max(text[id(node)], 1):
            node.skip = False


def parse(page: str) -> Node:
    """The tree under the document. Tags that were left open are closed as browsers do, in the main."""
    root = Node("html")
    here, at, size = root, 0, len(page)
    depth: dict[str, int] = {}

    def close(name: str, stop: frozenset[str] | tuple[str, ...] = ()) -> None:
        nonlocal here
        if not depth.get(name):
            return
        node = here
        while node is not root and node.tag != name:
            if node.tag in stop:
                return
            node = node.parent
        while here is not node:
            depth[here.tag] -= 1
            here = here.parent
        if here is not root:
            depth[here.tag] -= 1
            here = here.parent

    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else size]
        if text:
            here.children.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if not (tag := m.group(2)):
            continue
        tag = tag.lower()
        if m.group(1):
            close(tag, () if tag in BLOCKS else ("td", "th", "table", "article", "body"))
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            close("p", ("table", "button", "object"))
        if tag in SIBLINGS:
            names, stop = SIBLINGS[tag]
            for name in names:
                close(name, stop)
        if tag == "hr" or tag in BLOCKS and depth.get("head"):
            close("head")
        node = Node(tag, *_is_boilerplate(tag, m.group(3), bool(depth.get("article") or depth.get("main"))), here)
        here.children.append(node)
        if tag in RAW and not m.group(4):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size if tag in ("script", "style") else at
        elif tag not in VOID:
            depth[tag] = depth.get(tag, 0) + 1
            here = node
    skip_named(root)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """Kept nodes, parents first."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.skip)


def measure(root: Node) -> list[Node]:
    """Sets counts, densities and sums of all kept nodes; gives them back, parents first."""
    nodes = list(_walk(root))
    for node in reversed(nodes):
        node.chars += sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars, up.tags = up.chars + node.chars, up.tags + node.tags + (node.tag not in ("b", "i", "em", "strong", "span", "br"))
            up.link_chars, up.link_tags = up.link_chars + node.link_chars, up.link_tags + node.link_tags
    share = root.link_chars / max(root.chars, 1)
    for node in nodes:
        if node.chars:
            plain = max(node.chars - node.link_chars, 1)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            inside = (node.chars / max(node.link_chars, 1)) * (max(node.tags, 1) / max(node.link_tags, 1))
            node.density = node.chars / max(node.tags, 1) * max(math.log(max(inside, 1.0) + 1), 0.1) / max(math.log(base + 1), 0.1)
        if node.parent is not None:
            node.parent.sum += node.density
    return nodes


def main_node(root: Node) -> Node:
    """The subtree with the largest sum of densities at or above the threshold of the path to it."""
    nodes = [n for n in measure(root) if n.chars]
    if not nodes:
        return root
    densest, node = max(nodes, key=lambda n: n.sum), None
    threshold, node = densest.density, densest
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    return max((n for n in nodes if n.density >= threshold and n.children), key=lambda n: (n.sum, n.chars))


def blocks(root: Node) -> list[str]:
    """Texts of the blocks in page order, with single spaces."""
    out: list[list[str]] = [[]]
    stack: list[Node | str | None] = [root]
    while stack:
        item = stack.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.tag == "br":
            out[-1].append(" ")
        elif not item.skip:
            edge: list[None] = [None] if item.tag in BLOCKS else []
            stack.extend([*edge, *reversed(item.children), *edge])
    return [t for parts in out if (t := " ".join("".join(parts).split()))]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(blocks(main_node(parse(page))))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for each row of pages (page_id, url, html).

    Null, empty and text-free pages: an empty text. Very long and deep pages are read whole, without
    recursion. Rows are independent, so repeated ones are returned repeatedly. Other columns are ignored.
    """
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            columns = {n: part.column(n).combine_chunks() for n in ("page_id", "url")}
            yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, schema)
