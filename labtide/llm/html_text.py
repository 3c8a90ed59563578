"""The main text of HTML pages, by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|svg|template|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}}
P_STOPS = frozenset("table td th caption button object body html".split())

BOILERPLATE_TAGS = frozenset("nav footer aside button select dialog head menu object audio video canvas".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification alert popup modal overlay sidebar aside rail menu nav navbar navigation breadcrumb breadcrumbs footer "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget "
    "comment comments disqus respond reply replies pagination pager toolbar skip".split()
)
HEADER_NAMES = frozenset("header masthead topbar".split())
# Words that say where a named element stands or how it is built, and words that say it is not there.
LAYOUT = frozenset(
    "area article bar block blocks bottom box button buttons column container content footer form group header inner item items "
    "left link links list main outer page panel post posts primary right secondary section site slot thread top unit wrap wrapper".split()
)
NEGATIONS = frozenset("has have no non not with without hide hides".split())
SHELL = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


class Node:
    """An element: what it holds in characters, tags and links, and the density of its text."""

    __slots__ = (
        "tag", "parent", "children", "dropped", "named", "in_article", "chars", "tags", "link_chars", "link_tags", "density", "total",
    )

    def __init__(self, tag: str, parent: Node | None, dropped: bool, named: bool = False):
        self.tag, self.parent, self.children, self.dropped, self.named = tag, parent, [], dropped, named
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        if parent is not None:
            parent.children.append(self)


def names_boilerplate(token: str, in_article: bool, strict: bool) -> bool:
    """Whether a class or id is the name of boilerplate: by its last part, or by all its parts besides words of layout.

    ``strict`` asks for the latter, since ids in an article are often made from headings (job-search).
    """
    parts = [p.lower() for p in NAME_PART.findall(token)]
    names = BOILERPLATE_NAMES if in_article else BOILERPLATE_NAMES | HEADER_NAMES
    if not parts or NEGATIONS.intersection(parts):
        return False
    if not strict and parts[-1] in names:
        return True
    return not names.isdisjoint(parts) and all(p in names or p in LAYOUT or p.isdigit() for p in parts)


def is_boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate by tag, role or being hidden, and whether by its names or as a form.

    The former are menus, headers, footers, sidebars, dialogs and hidden elements; the latter depends on what they hold.
    """
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_article):
        return True, False
    if not attributes or tag in SHELL:
        return False, tag == "form"
    named = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    role = named.get("role", "").lower()
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or role in BOILERPLATE_ROLES:
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", ""), re.I):
        return True, False
    if tag == "form" or role == "form" or any(names_boilerplate(t, in_article, False) for t in named.get("class", "").split()):
        return False, True
    ids = [] if tag in HEADINGS else named.get("id", "").split()
    return False, any(names_boilerplate(t, in_article, in_article) for t in ids)


def drop_named(order: list[Node], texts: list[tuple[Node, int, str]]) -> None:
    """Drop named elements and forms with all below them, but not those that hold the page or its article.

    Such a shell holds an article or main with at least half as much text as the page's greatest, as smaller ones are often
    comments or teasers; or more than half of the page's unlinked text, unless it stands beside an article or main that no
    name covers, as a long advert beside a short article does.
    """
    if not any(node.named and not node.dropped for node in order):
        return
    plain, greatest = dict.fromkeys(map(id, order), 0), dict.fromkeys(map(id, order), 0)
    # What stands above or at each element: a link, an article or main, a name.
    above: dict[int, tuple[bool, bool, bool]] = {}
    for node in order:
        link, article, named = above[id(node.parent)] if node.parent is not None else (False, False, False)
        above[id(node)] = (link or node.tag == "a", article or node.tag in ("article", "main"), named or node.named)
    for node, _, text in texts:
        if not node.dropped and not above[id(node)][0]:
            plain[id(node)] += len("".join(text.split()))
    for node in reversed(order):
        if node.dropped:
            continue
        if node.tag in ("article", "main"):
            greatest[id(node)] = max(greatest[id(node)], plain[id(node)])
        if node.parent is not None:
            up = id(node.parent)
            plain[up] += plain[id(node)]
            greatest[up] = max(greatest[up], greatest[id(node)])
    whole, most = plain[id(order[0])], greatest[id(order[0])]
    free = any(n.tag in ("article", "main") and not n.dropped and plain[id(n)] and not above[id(n)][2] for n in order)
    for node in order:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        elif node.named and not node.dropped:
            own = greatest[id(node)]
            beside = free and not own and not above[id(node)][1]
            node.dropped = not (2 * plain[id(node)] > whole and not beside or own and 2 * own >= most)


def parse(page: str) -> tuple[Node, list[tuple[Node, int, str]]]:
    """The page's elements, and its texts in order with their element and block number.

    Open elements are kept in one list; end tags that fit nothing are ignored, and missing ones are implied. The places of
    each name in that list are kept as well, so that no tag makes the parser search it, however deep the nesting.
    """
    root = Node("html", None, False)
    stack, texts, block = [root], [], 0
    places: dict[str, list[int]] = {}

    def last(names: set[str] | frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def pop_to(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> bool:
        """Close the last open element of these names and all in it, unless one of ``stops`` stands in between."""
        at = last(names)
        if not at or at < last(stops):
            return False
        for node in stack[at:]:
            places[node.tag].pop()
        del stack[at:]
        return True

    for found in TOKEN.finditer(page):
        text = found["text"]
        if text is not None:
            texts.append((stack[-1], block, text))
            continue
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            block += 1
        if found["end"] or found["end2"]:
            if tag not in ("html", "body"):
                pop_to({tag}, frozenset() if tag not in INLINE else frozenset(CLOSES_P - {"p"}))
            continue
        if tag == "br" or tag == "wbr":
            texts.append((stack[-1], block, " " if tag == "br" else ""))
        if tag in CLOSES_P:
            pop_to({"p"}, P_STOPS)
        if tag in CLOSES:
            while pop_to(CLOSES[tag], STOPS.get(tag, set())):
                pass
        if tag in ("html", "body"):
            stack[-1].tag = tag if stack[-1] is root else stack[-1].tag
            continue
        top = stack[-1]
        dropped, named = is_boilerplate(tag, found["attrs"] or "", top.in_article)
        node = Node(tag, top, top.dropped or dropped, named)
        if tag not in VOID and not (found["attrs"] or "").endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return root, texts


def measure(root: Node, texts: list[tuple[Node, int, str]]) -> list[Node]:
    """Drop what is boilerplate by name, count characters, tags and links below every element, then set densities.

    Returns the elements in page order.

    Formatting inside a line neither counts as a tag nor as a subtree of its own.
    """
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(reversed(node.children))
    drop_named(order, texts)
    for node, _, text in texts:
        if not node.dropped:
            node.chars += len("".join(text.split()))
    for node in reversed(order):
        if node.tag == "a":
            node.link_chars = node.chars
        up = node.parent
        if up is not None and not node.dropped:
            up.chars += node.chars
            up.tags += node.tags + (node.tag not in INLINE or node.tag == "a")
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    whole = root.link_chars / max(root.chars, 1)
    for node in order:
        plain = max(node.chars - node.link_chars, 1)
        spread = (node.chars / max(node.link_chars, 1)) * (max(node.tags, 1) / max(node.link_tags, 1))
        linked = math.log(node.chars * node.link_chars / plain + whole * node.chars + math.e)
        node.density = node.chars / max(node.tags, 1) * math.log(1 + spread) / linked
    for node in order:
        if node.tag not in INLINE:
            parts = [child.density for child in node.children if not child.dropped and child.tag not in INLINE]
            node.total = sum(parts) or node.density
    return order


def linked(node: Node) -> bool:
    """Most of the text stands in links; a heading, or a paragraph of one link, is no list of links."""
    return 2 * node.link_chars > node.chars and node.tag not in HEADINGS and not (node.tag == "p" and node.link_tags == 1)


def around(centre: Node, own: dict[int, int]) -> tuple[set[int], set[int]]:
    """The blocks beside the path from the centre up to its outermost article or main, or else the body, and the elements
    of the path whose own text counts.

    Blocks that are mostly links stay out; ``own`` has the characters that stand in an element itself. Next to an article
    further articles count.
    """
    scope = node = centre
    while node is not None:
        if node.tag in ("article", "main") or (node.parent is None and scope.tag not in ("article", "main")):
            scope = node
        node = node.parent
    beside, path, node = set(), set(), centre
    while node is not scope:
        node = node.parent
        path_text = own.get(id(node), 0)
        inline = [c for c in node.children if c.tag in INLINE and not c.dropped]
        if 2 * sum(c.link_chars for c in inline) <= path_text + sum(c.chars for c in inline):
            path.add(id(node))
            beside.update(id(c) for c in inline)
        beside.update(id(c) for c in node.children if c.tag not in INLINE and not c.dropped and not linked(c))
    if scope.tag == "article" and scope.parent is not None:
        beside.update(id(c) for c in scope.parent.children if c.tag == "article" and not c.dropped and not linked(c))
    return beside, path


def content(root: Node, order: list[Node], texts: list[tuple[Node, int, str]]) -> set[int]:
    """Elements whose text is the main text.

    The subtree with the greatest sum of its children's densities is the centre; the least density on the path from it up
    to the body is the threshold. Below the body, the greatest subtree of every element that reaches the threshold counts,
    and so do the blocks around the centre, however weak, since a sum favours one section over what holds all sections.
    """
    best = max((n for n in order if not n.dropped), key=lambda n: n.total)
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    greatest: dict[int, Node] = {}
    for node in reversed(order):
        top = node
        for child in node.children:
            if not child.dropped and greatest[id(child)].total > top.total:
                top = greatest[id(child)]
        greatest[id(node)] = top
    own: dict[int, int] = {}
    for node, _, text in texts:
        own[id(node)] = own.get(id(node), 0) + len("".join(text.split()))
    chosen, path = around(best, own)
    marked = set()
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if node.dropped or not node.chars or node.density < threshold:
            continue
        chosen.add(id(greatest[id(node)]))
        waiting.extend(node.children)
    for node in order:
        inside = id(node) in chosen or (node.parent is not None and id(node.parent) in marked)
        if inside and not node.dropped:
            marked.add(id(node))
    return marked | path


def main_text(page: str | None) -> str:
    """Blocks of the main text, white space made single, joined by an empty line; empty without text."""
    if not page:
        return ""
    root, texts = parse(page)
    marked = content(root, measure(root, texts), texts)
    blocks: dict[int, list[str]] = {}
    for node, block, text in texts:
        if id(node) in marked:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n\n".join(text for text in joined if text)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages`` (page_id, url, html); no shuffle.

    The whole page is parsed. Null, empty and text-free pages have an empty text.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(page.as_py()) for page in part.column(2)]
            arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(batches, "page_id bigint, url string, text string, n_chars bigint")
