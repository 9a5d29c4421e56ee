"""Main text of web pages by wrapper induction.

Pages of a host are made from a template. One page of each host, the one with the least digest, is its model; every
page is aligned with its host's model by simple tree matching (the largest set of matching nodes that keeps
parents and order). Text that stays the same on the pages that otherwise differ from the model is template; what
varies is content. Votes of all pages on each text of the model are added up, so a host may hold any share
of the pages: a page meets one model, never the other pages.

What a tag, role or class name says is boilerplate (menus, headers, footers, sidebars, notices, adverts, forms,
comments) goes too, as a menu may differ from page to page. An article or main element, where there is one, holds the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import in_batches
from gridledger.operators.session import durable

#: A text of the model is template if it stays the same on this share of the pages that vote, of at least so many pages.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.8, 4
#: A page votes if no more than this share of the matched text (characters) equals the model's: copies of the model prove nothing.
COPY_SHARE = 0.5
#: Parts a host's pages are dealt into when they meet the model.
PARTS = 64

# Fixed values of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "math"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
KEEPS_P_OPEN = {"br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "head", "body", "legend"}
FENCES = {"table", "td", "th", "body", "html", "article", "section", "div", "main", "nav", "aside", "header", "footer", "form", "ul", "ol", "dl"}
# What names boilerplate.
SKIP_TAGS = {
    "script", "style", "noscript", "template", "head", "title", "nav", "header", "footer", "aside", "form", "button", "input", "select", "textarea",
    "iframe", "svg", "math", "canvas", "object", "embed", "dialog", "menu", "xmp", "noembed", "noframes", "label", "option",
}
SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
SKIP_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "widget", "widgets", "footer", "masthead", "topbar", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
    "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "pagination", "pager", "toolbar", "skip",
    "hidden", "alert", "disclaimer",
}
HEADER_WORDS = {"header"}
CONTENT_TAGS = {"article", "main"}
ROOT = "#root"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Node:
    """An element with its children in order; a child that is a string is text."""

    tag: str
    label: str
    skip: bool = False
    children: list = field(default_factory=list)
    place: int = 0


def _labelled(tag: str, source: str, in_content: bool) -> tuple[str, bool]:
    """Label for the alignment (tag, id or class) and whether tag, role or names mark boilerplate."""
    skip = tag in SKIP_TAGS and not (tag == "header" and in_content)
    if "=" not in source and "hidden" not in source:
        return tag, skip
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(source)}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in _NAME.findall(names)}
    if tag not in ("body", "html") and tag not in CONTENT_TAGS or words & {"comment", "comments", "reply"}:
        skip = skip or bool(words & SKIP_WORDS) or (bool(words & HEADER_WORDS) and not in_content)
    skip = skip or found.get("role", "").lower() in SKIP_ROLES
    skip = skip or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    return f"{tag}.{found.get('class') or found.get('id') or ''}", skip


def parse(html: str) -> Node:
    """The tree of a page, however broken: what is not closed ends with its parent, what was not opened is ignored."""
    html = html.replace("\x00", "")  # NUL will stand between blocks
    root = Node(ROOT, ROOT)
    open_ = [root]
    at, end = 0, len(html)
    content = 0
    while at < end:
        m = _TOKEN.match(html, at)
        at = m.end()
        if m[4] is not None:
            open_[-1].children.append(m[4])
            continue
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == tag:
                    del open_[depth:]
                    break
                if open_[depth].tag in FENCES and tag not in FENCES:
                    break
            continue
        closed = CLOSES.get(tag, set())
        if tag in BLOCK and tag not in KEEPS_P_OPEN:
            closed = closed | {"p"}
        for depth in range(len(open_) - 1, 0, -1):
            if open_[depth].tag in closed:
                del open_[depth:]
            elif open_[depth].tag in FENCES and open_[depth].tag not in closed:
                break
        content = any(n.tag in CONTENT_TAGS for n in open_)
        label, skip = _labelled(tag, m[3], content)
        node = Node(tag, label, skip)
        open_[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if not m[3].rstrip().endswith("/") or tag in BLOCK:
            open_.append(node)
    return root


def _number(node: Node) -> int:
    """Number the elements in page order; equal pages get equal numbers."""
    stack, n = [node], 0
    while stack:
        here = stack.pop()
        here.place = n
        n += 1
        stack.extend(c for c in reversed(here.children) if isinstance(c, Node))
    return n


def own_text(node: Node) -> str:
    return " ".join(unescape("".join(c if isinstance(c, str) else " " for c in node.children)).split())


def align(model: Node, page: Node) -> list[tuple[Node, Node]]:
    """Matched elements of two trees by simple tree matching; boilerplate subtrees stay unexplored.

    Equal labels match; the children of a match are aligned in order for the largest number of matched nodes.
    """
    known: dict[tuple[int, int], tuple[int, list]] = {}

    def kids(n: Node) -> list[Node]:
        return [c for c in n.children if isinstance(c, Node) and not c.skip and c.tag not in VOID]

    def size(a: Node, b: Node) -> int:
        if a.label != b.label:
            return 0
        key = id(a), id(b)
        if key in known:
            return known[key][0]
        left, right = kids(a), kids(b)
        width = len(right) + 1
        best = [[0] * width]
        pairs = [[size(x, y) for y in right] for x in left]
        for i in range(len(left)):
            row, above = [0], best[-1]
            for j in range(len(right)):
                row.append(max(above[j + 1], row[j], above[j] + pairs[i][j]))
            best.append(row)
        chosen, i, j = [], len(left), len(right)
        while i and j:
            if pairs[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + pairs[i - 1][j - 1]:
                chosen.append((left[i - 1], right[j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        known[key] = best[-1][-1] + 1, chosen
        return known[key][0]

    size(model, page)
    out, stack = [], [(model, page)]
    while stack:
        a, b = stack.pop()
        out.append((a, b))
        stack.extend(known[id(a), id(b)][1])
    return out


def matched_texts(model: Node, page: Node) -> list[tuple[int, int, bool, int]]:
    """(place in the model, place in the page, same text, its length) of the matched elements with a text of their own in the model."""
    _number(model)
    _number(page)
    found = []
    for a, b in align(model, page):
        text = own_text(a)
        if text:
            found.append((a.place, b.place, text == own_text(b), len(text)))
    return found


def main_text(page: Node, template: set[int]) -> str:
    """The page's text without boilerplate and without the elements numbered in `template`."""
    _number(page)
    roots, stack = [], [page]
    while stack:
        node = stack.pop()
        if node.skip:
            continue
        if node.tag in CONTENT_TAGS:
            roots.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    for chosen in (roots, [page]):
        parts: list[str] = []
        for root in chosen:
            _collect(root, template, parts)
            parts.append("\x00")
        blocks = (" ".join(unescape(b).split()) for b in "".join(parts).split("\x00"))
        text = " ".join(b for b in blocks if b)
        if text:
            return text
    return ""


def _collect(root: Node, template: set[int], parts: list[str]) -> None:
    """Texts in page order; NUL stands between blocks."""
    stack: list = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        if node.skip:
            if node.tag in BLOCK:
                parts.append("\x00")
            continue
        if node.tag in BLOCK:
            parts.append("\x00")
            stack.append("\x00")
        drop = node.place in template
        stack.extend(c for c in reversed(node.children) if not (drop and isinstance(c, str)))


def host_of(url) -> Column:
    """The host of a URL, lower-cased; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (host, html, model) to (host, place, same): one row per page and text of the model it matched."""
    models: dict[str, Node] = {}
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, html, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if html == source:
                continue
            if host not in models:
                models.clear()
                models[host] = parse(source)
            found = matched_texts(models[host], parse(html))
            if sum(n for _, _, same, n in found if same) > COPY_SHARE * sum(n for *_, n in found):
                continue
            for place, _, same, _ in found:
                held = sums.setdefault((host, place), [0, 0])
                held[0] += 1
                held[1] += same
        yield pa.RecordBatch.from_arrays([
            pa.array([h for h, _ in sums], pa.string()), pa.array([p for _, p in sums], pa.int32()),
            pa.array([v[0] for v in sums.values()], pa.int64()), pa.array([v[1] for v in sums.values()], pa.int64()),
        ], names=["host", "place", "pages", "same"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (row, html, model, places) to (row, text)."""
    model_of: list = ["", None]
    for batch in batches:
        out = []
        for html, source, places in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            page = parse(html or "")
            template: set[int] = set()
            if places:
                if model_of[0] != source:
                    model_of[:] = source, parse(source)
                fixed = set(places)
                template = {b for a, b, same, _ in matched_texts(model_of[1], page) if same and a in fixed}
            out.append(main_text(page, template))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row, repeated rows among them.

    A NULL or empty html has the empty text. Pages without a host share one template group. Other columns are not read. White space inside
    a block is one blank, blocks follow one another in page order, parted by one blank. An empty table gives no rows.
    """
    rows = pages.select(
        F.struct(F.col(page_id).alias("page_id"), F.col(url).alias("url")).alias("row"), host_of(F.col(url).cast("string")).alias("host"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    full = rows.filter("html <> ''")
    models = durable(full.groupBy("host").agg(
        F.min_by("html", F.struct(F.md5(F.col("html").cast("binary")))).alias("model"), F.count(F.lit(1)).alias("n")))
    # Pages of a host are dealt into parts, and its model goes to each part.
    part = F.pmod(F.xxhash64("html", "row"), F.lit(PARTS))
    dealt = rows.withColumn("part", part)
    spread = lambda m: m.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    several = spread(models.filter(F.col("n") > TEMPLATE_PAGES).select("host", "model"))
    votes = in_batches(dealt.filter("html <> ''").join(several, ["host", "part"]).select("host", "html", "model")).mapInArrow(
        _votes, "host string, place int, pages long, same long")
    constant = (
        votes.groupBy("host", "place").agg(F.sum("pages").alias("pages"), F.sum("same").alias("same"))
        .filter((F.col("pages") >= TEMPLATE_PAGES) & (F.col("same") >= TEMPLATE_SHARE * F.col("pages")))
        .groupBy("host").agg(F.sort_array(F.collect_list("place")).alias("places"))
    )
    wrappers = spread(models.select("host", "model").join(durable(constant), "host"))
    read = dealt.join(wrappers, ["host", "part"], "left").select("row", "html", "model", "places")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row", read.schema["row"].dataType), T.StructField("text", T.StringType())])
    found = in_batches(read).mapInArrow(_extract, schema)
    return found.select(
        F.col("row.page_id").alias(page_id), F.col("row.url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
