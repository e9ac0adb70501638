"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Elements without content, elements whose content is not markup, and elements that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article, by name, by role and by word of their class or id.
DROPPED = frozenset("nav header footer aside form script style noscript template iframe button select textarea input head title dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
JUNK = re.compile(
    r"(?i)(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|adsense|banner|sponsor|sponsored|promo|promotion|cookie|cookies|consent|gdpr|notice|popup|modal|overlay"
    r"|newsletter|subscribe|subscription|signup|breadcrumb|breadcrumbs|menu|nav|navbar|navigation|sidebar|side|widget"
    r"|footer|comment|comments|commentlist|disqus|respond|reply|replies|discussion|paywall)(?:$|[\s_-]|\d)"
)
#: Words that mark such parts beside an article only; within one they may be its own.
BESIDE = re.compile(r"(?i)(?:^|[\s_-])(?:alert|share|sharing|social|related|recommended|recommendations|skip|pagination|pager|toolbar|tags)(?:$|[\s_-]|\d)")
#: Of these an article's own are kept: they hold its title.
HEADER = re.compile(r"(?i)(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-]|\d)")
#: These are never junk by their class.
CONTENT = frozenset("html body article main".split())

#: End tags that the next start tag implies, up to the innermost of SCOPES that isn't among them.
CLOSES = {
    "li": frozenset(["li"]), "p": frozenset(["p"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["tr", "td", "th"]),
    "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
}
CLOSE_P = BLOCK - frozenset(["html", "body", "li", "td", "th", "tr", "dd", "dt", "option", "caption", "tbody", "thead", "tfoot", "summary"])
SCOPES = frozenset("ul ol table td th article section div main body aside nav header footer form blockquote dl".split())

#: A tag with its attributes, a quoted value being one after "="; possessive, so that a failure is found in one pass.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=(?!\s*+[\"']))*+)>")
#: The same where a quote has turned out to stay open to the page's end.
BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
STARTS = re.compile(r"</?[a-zA-Z]")
ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")


class Node:
    __slots__ = ("name", "junk", "kids", "up", "inside", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, up: Node | None, junk: bool):
        self.name, self.up, self.junk = name, up, junk
        self.kids: list[Node | str] = []
        self.inside: bool = name in ("article", "main") or up is not None and up.inside  # an article


def _is_junk(name: str, attrs: str, up: Node) -> bool:
    if name in DROPPED:
        return not (name == "header" and up.inside)
    if not attrs or name in CONTENT:
        return False
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and (JUNK.search(value) or not up.inside and (HEADER.search(value) or BESIDE.search(value))):
            return True
        if key == "style" and re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


class _Open:
    """The open elements, innermost last, and where those of a name lie."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.at[node.name].append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.nodes) > place:
            self.at[self.nodes.pop().name].pop()

    def last(self, names: frozenset[str]) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=0)


def parse(page: str) -> Node:
    """A tree of elements and decoded strings; unclosed and stray tags are mended as browsers roughly do.

    Work grows with the page: no text is looked at again, and no open element is passed over twice.
    """
    root = Node("html", None, False)
    open_ = _Open(root)
    at, n, last, tag = 0, len(page), page.rfind(">"), TAG
    while at < n:
        i = page.find("<", at)
        if not 0 <= i < last:  # what no ">" follows is text
            open_.nodes[-1].kids.append(html.unescape(page[at:]))
            break
        kids = open_.nodes[-1].kids
        if i > at:
            kids.append(html.unescape(page[at:i]))
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            at = n if end < 0 else end + 3
            continue
        m = tag.match(page, i)
        if not m and STARTS.match(page, i):
            tag = BARE_TAG
            m = tag.match(page, i)
        if not m:
            if page[i + 1 : i + 2] in ("!", "?", "/"):
                at = page.find(">", i) + 1
            else:
                kids.append("<")
                at = i + 1
            continue
        at, name = m.end(), m[2].lower()
        if name == "html":
            continue
        if m[1]:
            if open_.at.get(name):
                open_.close(open_.at[name][-1])
            continue
        ends = CLOSES.get(name, frozenset())
        if name in CLOSE_P:
            ends = ends | {"p"}
        while ends and (own := open_.last(ends)) and own > open_.last(SCOPES - ends):
            open_.close(own)
        here = open_.nodes[-1]
        if name in VOID:
            here.kids.append(" " if name == "br" else Node(name, here, False))
            continue
        if name in RAW:
            end = _end_of(name).search(page, at)
            at = end.end() if end else n
            continue
        node = Node(name, here, _is_junk(name, m[3], here))
        here.kids.append(node)
        if not m[3].endswith("/") or name not in ("svg", "math"):
            open_.push(node)
    return root


@lru_cache
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I)


def _measure(root: Node) -> list[Node]:
    """Characters and tags of every subtree, those of links too; the nodes without junk, parents first.

    Junk counts only towards the page's share of link characters, which is left in root.density.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [k for k in node.kids if type(k) is Node]
    whole = [0, 0]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for k in node.kids:
            if type(k) is str:
                node.chars += len(" ".join(k.split()))
            elif k.junk:
                whole[0] += k.chars
                whole[1] += k.link_chars
            else:
                node.chars += k.chars
                node.tags += k.tags + 1
                node.link_chars += k.link_chars
                node.link_tags += k.link_tags + (k.name == "a")
        if node.name == "a":
            node.link_chars = node.chars
    root.density = (whole[1] + root.link_chars) / max(1, whole[0] + root.chars)
    kept, todo = [], [root]
    while todo:
        node = todo.pop()
        kept.append(node)
        todo += [k for k in node.kids if type(k) is Node and not k.junk]
    return kept


def densities(root: Node) -> list[Node]:
    """Composite text density of every node, and the sum over its children; the nodes, parents first.

    density = C / T * log_b(C / LC * T / LT), b = ln(C / (C - LC) * LC + L * C + e), of C characters, T tags,
    LC characters and LT tags of links below the node, and L the page's share of characters in links.  A
    count of zero is taken as one, and b as 1.1 at least (without links it would be 1).
    """
    order = _measure(root)
    whole = root.density
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        ratio = c / max(1, lc) * t / lt
        base = math.log(c / max(1, c - lc) * lc + whole * c + math.e)
        node.density = c / t * math.log(ratio) / math.log(max(base, 1.1)) if ratio > 1 else 0.0
    for node in order:
        node.total = sum(k.density for k in node.kids if type(k) is Node and not k.junk)
    return order


def main_node(root: Node) -> Node:
    """The subtree of the article.

    Of the nodes that hold blocks, the one with the greatest sum of child densities is the article's core (a
    page without blocks is its own core).  The least density on the path from it towards the body is the
    threshold; the article is the smallest subtree with the core and every block below the body that
    reaches the threshold and shares a wrapper with the core.
    """
    order = densities(root)
    top = next((x for x in order if x.name == "body"), root)
    holders = [x for x in order if any(type(k) is Node and not k.junk and k.name in BLOCK for k in x.kids)]
    core = max(holders, key=lambda x: x.total, default=top)
    path = [core]
    while path[-1] is not top and path[-1].up is not None:
        path.append(path[-1].up)
    least = min((x.density for x in path if x is not top), default=0.0)
    best = core
    for below, node in zip(path, path[1:], strict=False):
        if node is top:
            break
        if any(type(k) is Node and k is not below and not k.junk and k.chars and k.density >= least for k in node.kids):
            best = node
    return best


def blocks(node: Node) -> list[str]:
    """The texts of the blocks below node in page order, white space made one space, empty ones left out."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := " ".join("".join(run).split()):
            out.append(text)
        run.clear()

    todo: list = [(node, False)]
    while todo:
        x, over = todo.pop()
        if type(x) is str:
            run.append(x)
        elif over:
            close()
        elif not x.junk or x is node:
            if x.name in BLOCK:
                close()
                todo.append((x, True))
            todo += [(k, False) for k in reversed(x.kids)]
    close()
    return out


def main_text(page: str | None) -> str:
    """The article's text: blocks joined by newlines; null or empty page: empty."""
    return "\n".join(blocks(main_node(parse(page)))) if page else ""


def html_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The main text of every page, with the columns in keep and n_chars (code points).

    A page is parsed whole, row by row, with no shuffle.  Menus, headers, footers, adverts, notices, forms and
    comments are cut from its tree by element, role and class.  For every node that is left the composite text
    density is worked out (characters per tag, adjusted for links), the densities of children are summed, and
    the subtree of the greatest sum is the article, widened by the threshold on its path to the body.

    Null or empty html: empty text.  Broken markup is mended, never an error; repeated rows, null ids and an
    empty table need nothing special.  A kept column named text or n_chars gives way to the result's.
    """
    keep = tuple(c for c in keep if c not in ("text", "n_chars"))
    kept = pages.select(*keep, F.col(html_col).alias("vx_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]) + ", text string, n_chars long"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    return kept.mapInArrow(batches, schema)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages"))
