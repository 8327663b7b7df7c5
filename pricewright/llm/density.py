"""Main text of web pages by composite text density."""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import fresh, ship_package

#: Every "<" with a letter behind it makes a token, at worst up to the end of the page, so that no part of a page is scanned twice.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))|[^>])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg canvas audio video select".split())
#: Of these, the ones that reach to the end of the page if nothing closes them.
RAW_TO_END = frozenset("script style title textarea iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no article text; those that are none unless their text says otherwise, and names of classes, ids and roles that make one such a candidate.
DROPPED = frozenset("button head label input".split())
CANDIDATES = frozenset("nav footer aside form menu fieldset dialog search".split())
WORDS_OF_FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies "
    "disqus footer masthead menu menubar nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related replies respond search share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget alert consent modal".split()
)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Start tags that end an open element of the same kind, up to the element that holds them all.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HEADLINES = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SCOPES = frozenset("table td th caption button".split())
#: For each tag of CLOSED_BY the number of its kind, and which kinds a tag belongs to.
KINDS = {tag: i for i, tag in enumerate(CLOSED_BY)}
KINDS_OF = {tag: [i for of, i in KINDS.items() if tag in CLOSED_BY[of][0] | CLOSED_BY[of][1]] for ends in CLOSED_BY.values() for tag in ends[0] | ends[1]}


class Node:
    """An element. ``block``, ``article`` and ``kinds`` are the nearest elements, itself or above, that are a block, an article or main, and of each kind of CLOSED_BY."""

    __slots__ = ("tag", "parent", "parts", "dropped", "named", "chars", "tags", "link_chars", "link_tags", "density", "total", "block", "article", "kinds")

    def __init__(self, tag: str, parent: "Node | None", dropped: bool, named: bool = False):
        self.tag, self.parent, self.parts, self.dropped, self.named = tag, parent, [], dropped, named
        self.block = self if tag in BLOCKS or parent is None else parent.block
        self.article = self if tag in ("article", "main") else parent.article if parent is not None else None
        self.kinds = (None,) * len(KINDS) if parent is None else parent.kinds
        if tag in KINDS_OF:
            self.kinds = tuple(self if i in KINDS_OF[tag] else k for i, k in enumerate(self.kinds))
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_named(tag: str, attributes: str, parent: Node) -> bool:
    """Whether its tag, or a word of a class, id or role, says that an element may be furniture."""
    # A header inside the article holds its title; the page's own holds the menu.
    if tag in CANDIDATES or tag == "header" and parent.article is None:
        return True
    if "=" not in attributes or tag in ("body", "html", "article", "main"):
        return False
    values = (value for name, value in ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id", "role"))
    return any(p.lower() in WORDS_OF_FURNITURE for value in values for p in NAME_PART.findall(value))


def _is_hidden(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


class _Open:
    """The open elements of a page: the innermost, and how many of each tag are open, in all and since the last scope began.

    An end tag without an open element costs nothing, and each element is closed once.
    """

    def __init__(self, root: Node):
        self.root = self.node = root
        self.all, self.scopes = Counter(), [Counter()]

    def push(self, node: Node) -> None:
        self.node = node
        self.all[node.tag] += 1
        if node.tag in SCOPES:
            self.scopes.append(Counter())
        self.scopes[-1][node.tag] += 1

    def close(self, until: Node) -> None:
        """Close all open elements up to ``until``, which stays open."""
        while self.node is not until:
            self.all[self.node.tag] -= 1
            self.scopes[-1][self.node.tag] -= 1
            if self.node.tag in SCOPES:
                self.scopes.pop()
            self.node = self.node.parent

    def end(self, tag: str) -> None:
        """Close the innermost element of a tag: of a block anywhere, of others within the innermost scope."""
        if (self.all if tag in BLOCKS else self.scopes[-1])[tag]:
            up = self.node
            while up.tag != tag:
                up = up.parent
            self.close(up.parent)


def parse(html: str) -> Node:
    """The tree of a page, as far as its text needs it; unclosed and misnested elements are mended. Linear in the page."""
    root = Node("html", None, False)
    opened = _Open(root)
    at, size, unclosed = 0, len(html), set()
    while at < size:
        match = TOKEN.search(html, at)
        if match is None:
            opened.node.parts.append(html[at:])
            break
        if match.start() > at:
            opened.node.parts.append(html[at:match.start()])
        at = match.end()
        closing, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            opened.end(tag)
            continue
        if tag == "html":
            continue
        if tag in BLOCKS and opened.node.block.tag == "p":
            # A block ends an open paragraph and what is open inside it.
            opened.close(opened.node.block.parent)
        if tag in CLOSED_BY:
            (ended, _), kind, last = CLOSED_BY[tag], KINDS[tag], None
            up = opened.node.kinds[kind]
            while up is not None and up.tag in ended:
                last, up = up, up.parent.kinds[kind]
            if last is not None:
                opened.close(last.parent)
        if tag in RAW:
            if not attributes.rstrip().endswith("/") and tag not in unclosed:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                if end:
                    at = end.end()
                elif tag in RAW_TO_END:
                    at = size
                else:
                    unclosed.add(tag)
            continue
        node = opened.node
        child = Node(tag, node, _is_hidden(tag, attributes), _is_named(tag, attributes, node))
        node.parts.append(child)
        if tag not in VOID:
            opened.push(child)
    return root


def _measure(root: Node) -> list[Node]:
    """Counts, densities and sums of densities, children before parents; the nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        order.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(part.strip())
            elif not part.dropped:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    whole = max(root.chars, 1)
    for node in reversed(order):
        if node.chars:
            tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
            plain = max(node.chars - node.link_chars, 1)
            base = log(node.chars / plain * node.link_chars + root.link_chars / whole * node.chars + e)
            value = max(node.chars / links * tags / link_tags, 1.0)
            node.density = node.chars / tags * (log(value) / log(base) if base > 1.0 + 1e-9 else log(value + e))
        node.total = sum(p.density for p in node.parts if isinstance(p, Node) and not p.dropped)
    return order


def _drop_named(root: Node) -> None:
    """Drop the elements whose names say furniture and whose place and text do not say otherwise.

    One that holds an article or main stays. Where the page has none outside of it, one with most of the page's text that is no link stays too.
    Inside an article or main a paragraph stays that is as dense as the body.
    """
    order = _measure(root)
    if not any(n.named for n in order):
        return
    articles = {}
    for node in reversed(order):
        articles[id(node)] = (node.tag in ("article", "main")) + sum(articles.get(id(p), 0) for p in node.parts if isinstance(p, Node))
    body = next((n for n in order if n.tag == "body"), root)
    inside = {}
    for node in order:
        above = node.parent
        node.dropped = above is not None and above.dropped
        inside[id(node)] = above is not None and (inside[id(above)] or above.tag in ("article", "main"))
        if node.named and not node.dropped and not articles[id(node)]:
            most = not articles[id(root)] and 2 * (node.chars - node.link_chars) > root.chars - root.link_chars
            dense = node.tag == "p" and inside[id(node)] and node.density >= body.density
            node.dropped = not (most or dense)


def _drop_links(tops: list[Node], threshold: float) -> None:
    """Inside an article drop the blocks that are mostly several links and, adjusted for them, less dense than the path from the body to the text."""
    stack = list(tops)
    while stack:
        for part in stack.pop().parts:
            if isinstance(part, Node) and not part.dropped:
                if part.tag in BLOCKS and part.link_tags > 1 and 2 * part.link_chars > part.chars and part.density < threshold:
                    part.dropped = True
                else:
                    stack.append(part)


def _select(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    _drop_named(root)
    order = _measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    inside, best = [], None
    for node in order:
        if node.chars:
            inside.append(node)
            if best is None or node.total > best.total:
                best = node
    if best is None:
        return []
    threshold, up, article = best.density, best, None
    while up is not None:
        threshold = min(threshold, up.density)
        if up.tag in ("article", "main"):
            article = up
        if up is body:
            break
        up = up.parent
    if article is None:
        # The best subtree may hold the article with what stands beside it.
        held = [n for n in inside if n.article is n and n.chars]
        largest = max(held, key=lambda n: n.chars - n.link_chars, default=None)
        if largest is not None and 2 * (largest.chars - largest.link_chars) > best.chars - best.link_chars:
            article = largest
    if article is not None:
        chosen = [article]
        if article.tag == "article" and article.parent is not None:
            # Of articles beside it those that are no mere links.
            chosen = [n for n in article.parent.parts if isinstance(n, Node) and n.tag == "article" and not n.dropped and n.chars
                      and (n is article or 2 * n.link_chars < n.chars)]
        _drop_links(chosen, threshold)
        return chosen
    # Blocks beside the best one are taken too where they are as dense as the path from the body to it, or headlines;
    # between the first and the last taken, all that are not mostly links.
    path = set()
    up = best.parent
    while up is not None:
        path.add(id(up))
        up = up.parent
    beside = [n for n in inside if n is best or n.parent is not None and id(n.parent) in path and id(n) not in path]
    texts = [n is best or 2 * n.link_chars < n.chars for n in beside]
    sure = [n is best or n.density >= threshold or n.tag in HEADLINES and text for n, text in zip(beside, texts)]
    first, last = sure.index(True), len(sure) - sure[::-1].index(True)
    return [n for i, n in enumerate(beside) if sure[i] or first < i < last and texts[i]]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, each with single spaces, joined by newlines."""
    if not html:
        return ""
    blocks, line = [], []

    def close():
        text = " ".join(unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in _select(parse(html)):
        stack: list[Node | str | None] = [top]
        while stack:
            part = stack.pop()
            if part is None:
                close()
            elif isinstance(part, str):
                line.append(part)
            elif not part.dropped:
                if part.tag == "br":
                    line.append(" ")
                if part.tag in BLOCKS:
                    close()
                    stack.append(None)
                stack.extend(reversed(part.parts))
        close()
    return "\n".join(blocks)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(h.as_py()) for h in batch.column(batch.num_columns - 1)], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=batch.schema.names)


def extract_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the column ``out``, each page's main text, in place of its html.

    Null and empty pages and pages without text have an empty text. Of other columns one named like ``out`` is replaced.
    """
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c not in (html_col, out)]
    (name,) = fresh(pages, out) if out != html_col else (out,)
    rows = pages.select(*keep, F.col(html_col).cast("string").alias(name))
    done = rows.mapInArrow(_texts, rows.schema)
    return done.withColumnRenamed(name, out)


def page_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars, its code points."""
    texts = extract_text(pages.select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
