"""Main text of web pages by composite text density.

Each element's density is its characters per tag, lowered where characters and tags belong to links.
An element's density sum adds the densities of the blocks in it; the element with the largest sum is the
content, together with elements beside it that are as dense as the least dense element on the path
from it to the body and have dense children of their own. Elements that are never article text
(navigation, footers, asides, scripts, styles) are cut before anything is counted. So are hidden elements
and those that a whole class, id or role names as a menu, sidebar, notice, advert or comments, unless
they hold the article or all the text there is; a name in which such a word stands beside words of its
own (``related-work``, ``search-trees``) says nothing, and headings are never marked. Forms and page
headers are judged by the text they hold.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, with raw content, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Start of one of these ends an open one of those (up to the nearest ancestor that holds such lists).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that are no article text.
NOISE = frozenset(
    "head script style noscript template iframe noframes noembed object svg canvas nav aside footer button select textarea "
    "input menu dialog xmp".split())
#: Marks of such elements among the words of class, id and role.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead "
    "comment comments disqus share sharing social related recommended newsletter subscribe signup login pagination pager "
    "complementary contentinfo search widget".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|$)", re.S)
#: Words that may stand beside such a mark without naming anything of their own.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons col column container content div element entry field form global group head "
    "holder icon icons id inner item items layer left level link links list main mobile module outer page panel post primary "
    "region right row secondary section site small sticky sub text title top wrap wrapper x".split())
#: Parts of a class that names a layout instead, such as ``no-sidebar`` or ``content-with-nav``.
STATES = frozenset("no not non without with has hide show is".split())
#: Marks of elements that are judged by the text they hold, of hidden ones, and of those that say what they are.
MARKED, UNSEEN, NAMED = 1, 2, 3
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NONE_SHOWN = re.compile(r"display\s*:\s*none", re.I)
SPACES = re.compile(r"\s+")
PARTS = re.compile(r"[^a-z0-9]+")


class Element:
    __slots__ = ("tag", "noise", "mark", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, noise: bool, parent: Element | None, mark: int = 0):
        self.tag, self.noise, self.parent, self.mark = tag, noise, parent, mark
        self.children: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _in_article(node: Element | None) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def _mark(tag: str, attributes: str, inside: Element) -> int:
    """How the tag and its attributes mark an element; 0 if they do not."""
    mark = MARKED if tag == "form" or (tag == "header" and not _in_article(inside)) else 0
    if not attributes or tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return mark
    for match in ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "hidden" or (name == "style" and NONE_SHOWN.search(value)):
            return UNSEEN
        if name not in ("class", "id", "role"):
            continue
        for word in value.lower().split():
            parts = {part for part in PARTS.split(word) if part and not part.isdigit()}
            found = NOISE_WORDS & parts
            # an article's own header holds its title
            if not found or (found <= {"header", "masthead"} and _in_article(inside)):
                continue
            if parts <= NOISE_WORDS | PLAIN_WORDS:
                mark = NAMED
    return mark


def parse(page: str) -> Element:
    """The page's elements; text nodes are strings with their character references decoded."""
    root = Element("", False, None)
    node, at, size = root, 0, len(page)
    while at < size:
        match = TOKEN.search(page, at)
        start = match.start() if match else size
        if start > at and not node.noise:
            text = page[at:start]
            node.children.append(html.unescape(text) if "&" in text else text)
        if not match:
            break
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            open_node = node
            while open_node is not None and open_node.tag != tag:
                open_node = open_node.parent
            if open_node is not None and open_node.parent is not None:
                node = open_node.parent
            elif tag == "p":
                node.children.append(Element("p", False, node))
            continue
        if tag in BLOCK:
            # a block ends an open paragraph, with the inline elements in it
            found = node
            while found is not None and found.tag != "p" and (found.tag not in BLOCK):
                found = found.parent
            if found is not None and found.tag == "p":
                node = found.parent
        if tag in CLOSES:
            closed, within = CLOSES[tag]
            found, last = node, None
            while found is not None and found.tag not in within:
                if found.tag in closed:
                    last = found
                found = found.parent
            if last is not None:
                node = last.parent
        noise = node.noise or tag in NOISE
        element = Element(tag, noise, node, 0 if noise else _mark(tag, match[3], node))
        node.children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID:
            node = element
    return root


def cut_marked(root: Element) -> None:
    """Turn marked elements into noise by what they hold."""
    order = list(_elements(root))
    if not any(e.mark for e in order):
        return
    sizes, links, outside = {}, {}, 0
    for node in reversed(order):
        texts = sum(len(SPACES.sub("", c)) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, Element) and not c.noise]
        sizes[id(node)] = texts + sum(sizes[id(c)] for c in inner)
        links[id(node)] = sizes[id(node)] if node.tag == "a" else sum(links[id(c)] for c in inner)
    within, body = {}, sizes[id(root)]
    for node in order:  # parents first
        within[id(node)] = bool(node.mark) or (node.parent is not None and within[id(node.parent)])
        if not within[id(node)]:
            outside += sum(len(SPACES.sub("", c)) for c in node.children if isinstance(c, str))
    articles = [e for e in order if e.tag in ("article", "main")]
    article = max((e for e in articles if not within[id(e)]), key=lambda e: sizes[id(e)], default=None)
    if article is None:
        # it may stand in a marked wrapper
        held = max(articles, key=lambda e: sizes[id(e)], default=None)
        article = held if held is not None and sizes[id(held)] > outside else None
    around, node = set(), article
    while node is not None:
        around.add(id(node))
        node = node.parent
    inside = set() if article is None else {id(e) for e in _elements(article)}
    for node in order:
        if node.noise or not node.mark or id(node) in around:
            continue
        size = sizes[id(node)]
        if node.mark == NAMED:
            # what it is called is what it is, unless there is no other text
            node.noise = size < (sizes[id(article)] if id(node) in inside else body) or (article is not None and id(node) not in inside)
            continue
        # what most of the text stands in is no menu or notice, unless it consists of links
        whole = body if article is None else sizes[id(article)] if id(node) in inside else None
        if node.mark == UNSEEN or whole is None or 2 * size <= whole or 2 * links[id(node)] > size:
            node.noise = True


def _measure(root: Element) -> None:
    """Characters, tags, link characters and link tags of every element, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Element) and not c.noise)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, Element):
                if not child.noise:
                    node.chars += child.chars
                    node.tags += child.tags + 1
                    node.link_chars += child.link_chars
                    node.link_tags += child.link_tags + (child.tag == "a")
            else:
                node.chars += len(SPACES.sub("", child))
        if node.tag == "a":
            node.link_chars = node.chars
    body = max(root.chars, 1)
    for node in reversed(order):
        if not node.chars:
            continue
        # composite text density: characters per tag, by the share of them outside links
        plain = max(node.chars - node.link_chars, 1)
        links = max(node.link_chars, 1)
        base = math.log(node.chars / plain * links + root.link_chars / body * node.chars + math.e)
        ratio = node.chars / links * max(node.tags, 1) / max(node.link_tags, 1)
        node.density = node.chars / max(node.tags, 1) * max(math.log(max(ratio, 1e-9), max(base, 1.0001)), 0.0)
        # inline elements belong to their block and are no candidates of their own
        if node.parent is not None and node.tag in BLOCK:
            node.parent.sum += node.density


def _elements(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Element) and not c.noise)


def content(root: Element) -> list[Element]:
    """The chosen elements, in page order."""
    _measure(root)
    body = next((e for e in _elements(root) if e.tag == "body"), root)
    best = body
    for node in _elements(body):
        if node.tag in BLOCK and node.sum > best.sum:
            best = node
    # a part of an article, or else of the main element, stands for the whole of it
    for tag in ("article", "main"):
        node = best
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None:
            best = node
            break
    path, node = set(), best
    least = best.density
    while node is not None and node is not body:
        least = min(least, node.density)
        node = node.parent
        path.add(id(node))
    if body is not best:
        least = min(least, body.density)
    chosen, stack = [], [body]
    while stack:
        node = stack.pop()
        if node is best or (id(node) not in path and node.density >= least and node.sum >= least and node.sum > 0):
            chosen.append(node)
        elif id(node) in path:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Element) and not c.noise)
    return chosen


def blocks(element: Element) -> list[str]:
    """Texts of an element's blocks, white space inside turned into one space, empty ones left out."""
    out, current = [], []

    def end() -> None:
        text = SPACES.sub(" ", "".join(current)).strip()
        if text:
            out.append(text)
        current.clear()

    stack: list = [element]
    while stack:
        node = stack.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            current.append(node)
        elif node.tag == "br":
            current.append(" ")
        elif not node.noise:
            block = node.tag in BLOCK
            if block:
                end()
                stack.append(None)
            stack.extend(reversed(node.children))
    end()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page, empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    cut_marked(root)
    return " ".join(text for element in content(root) for text in blocks(element))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row. Null and empty pages have an empty text; repeated
    rows are read each; an empty table gives no rows; other columns are ignored."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    picked = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    return picked.mapInArrow(read, "page_id long, url string, text string, n_chars long")
