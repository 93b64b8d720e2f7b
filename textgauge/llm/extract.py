"""Main text of web pages: page structure, then page differencing.

A page is cut into text lines, one per block element.  Lines in elements that
say by tag, role or class that they are no article (menus, footers, forms,
adverts, comments ...) are dropped.  What pages do not say is found by
differencing: pages of a host are ordered by URL path, each page is aligned
with its nearest ones by the longest common subsequence of its lines, and the
shared lines are deleted.  Lines inside an ``article`` or ``main`` element are
the page's own claim and stay: two copies of an article share all of them.  The
claim is tested by differencing: a page that has more text of its own outside
these elements (teaser cards around a story) keeps that text too.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise

# Fixed values of HTML and of common class names.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "select", "audio", "video")
BOILERPLATE_TAGS = frozenset(("head", "nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"))
BOILERPLATE_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "alert", "alertdialog", "dialog", "toolbar"))
BOILERPLATE_WORDS = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "discussion", "disqus", "footer", "gdpr", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "pager", "popup", "privacy", "promo",
    "promotion", "related", "replies", "reply", "respond", "responses", "share", "sharing", "sidebar", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "toolbar", "widget"))
CONTENT_TAGS = frozenset(("article", "main"))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A raw element ends with its end tag; only drawings and formulas may close themselves.
    r"|<(?:svg|math)(?:\s[^>]*)?/>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rest>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+|[0-9]+")


def _is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in BOILERPLATE_TAGS:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in BOILERPLATE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            if any(w in BOILERPLATE_WORDS for w in _NAME.findall(value)):
                return True
    return False


def page_lines(html: str | None) -> list[tuple[str, bool]]:
    """Text lines of a page, each with whether it lies in an article or main
    element.  Unclosed elements end with the element around them."""
    lines: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, dropped, content
    parts: list[str] = []
    dropped = content = False

    def end_line() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                lines.append((text, content))

    at = 0
    html = html or ""
    for m in _MARKUP.finditer(html):
        if not dropped and m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if not dropped:
                parts.append(" ")
            continue
        if tag in BLOCKS:
            end_line()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    dropped, content = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                    break
            continue
        if tag in VOID or m["attributes"].endswith("/"):
            continue
        if tag == "p" and stack and any(x[0] == "p" for x in stack):
            # A paragraph ends where the next one begins.
            i = max(i for i, x in enumerate(stack) if x[0] == "p")
            if all(x[0] not in BLOCKS for x in stack[i + 1 :]):
                del stack[i:]
                dropped, content = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        dropped = dropped or _is_boilerplate(tag, m["attributes"])
        content = content or tag in CONTENT_TAGS
        stack.append((tag, dropped, content))
    if not dropped:
        parts.append(html[at:])
    end_line()
    return lines


def shared_lines(mine: list[int], other: list[int]) -> list[int]:
    """Places in ``mine`` of a longest common subsequence with ``other``."""
    a = 0
    while a < len(mine) and a < len(other) and mine[a] == other[a]:
        a += 1
    b = 0
    while b < min(len(mine), len(other)) - a and mine[-1 - b] == other[-1 - b]:
        b += 1
    common = set(mine[a : len(mine) - b]) & set(other[a : len(other) - b])
    left = [i for i in range(a, len(mine) - b) if mine[i] in common]
    right = [other[i] for i in range(a, len(other) - b) if other[i] in common]
    found: list[int] = []
    if left and right:
        length = np.zeros((len(left) + 1, len(right) + 1), np.int32)
        values = np.array(right)
        for i in range(len(left) - 1, -1, -1):
            diagonal = np.where(values == mine[left[i]], length[i + 1, 1:] + 1, length[i + 1, :-1])
            length[i, :-1] = np.maximum.accumulate(diagonal[::-1])[::-1]
        i = j = 0
        while i < len(left) and j < len(right):
            if mine[left[i]] == right[j]:
                found.append(left[i])
                i, j = i + 1, j + 1
            elif length[i + 1, j] >= length[i, j + 1]:
                i += 1
            else:
                j += 1
    return [*range(a), *found, *range(len(mine) - b, len(mine))]


def _lines(pages: DataFrame) -> DataFrame:
    """``(page_id, url, lines, open)``; ``open`` marks the lines outside an
    article, which differencing may delete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                texts, marks = [], []
                for raw in part.column(2).to_pylist():
                    lines = page_lines(raw)
                    texts.append([t for t, _ in lines])
                    marks.append([not c for _, c in lines])
                yield pa.RecordBatch.from_arrays([
                    part.column(0).cast(pa.int64()), part.column(1), pa.array(texts, pa.list_(pa.string())),
                    pa.array(marks, pa.list_(pa.bool_()))], ["page_id", "url", "lines", "open"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, lines array<string>, open array<boolean>")


def neighbours(keys: DataFrame) -> DataFrame:
    """``keys(page, host, path, hashes)`` plus ``near``, the hashes of the page
    before and the page after it in the order of host and path.

    Rows are sorted by range over the whole table, so a host with a third of
    all pages is spread like any other; a row's number is its place in its
    partition plus the rows of the partitions before, and neighbours are an
    equi-join on it.
    """
    spark = keys.sparkSession
    order = ["host", "path", "page"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The high bits of the id are the partition, the low 33 bits the place.
    ranged = materialise(ranged.withColumn("at", F.monotonically_increasing_id()), "page-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # One number per partition.
    counts = {r[0]: r[1] for r in ranged.groupBy(part.alias("p")).agg(F.count("*")).collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    base = F.get(F.array(*[F.lit(before.get(p, 0)) for p in range(max(before, default=0) + 1)]), part.cast("int"))
    numbered = ranged.withColumn("number", (base + place).cast("long")).drop("at")
    # Each row is offered to the rows beside it.
    offer = numbered.select("host", F.explode(F.array(F.struct((F.col("number") - 1).alias("number"), F.lit(1).alias("side")), F.struct(
        (F.col("number") + 1).alias("number"), F.lit(0).alias("side")))).alias("o"), "hashes")
    offer = offer.select("host", "o.number", F.struct("o.side", "hashes").alias("offer"))
    near = numbered.join(offer, ["number", "host"]).groupBy("number").agg(F.array_sort(F.collect_list("offer")).alias("near"))
    return numbered.join(near, "number").select("page", "hashes", F.col("near.hashes").alias("near"))


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url,
    html, ...)``.

    A null or empty html has an empty text.  Pages without a host (null or odd
    url) are differenced among themselves.  Rows are identified by page_id,
    url and lines, so repeated rows and null ids are harmless; a neighbour
    with the very same lines is a copy, not a template, and deletes nothing.
    Other columns are ignored.
    """
    lines = _lines(pages)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    open_lines = F.filter("lines", lambda x, i: F.get("open", i))
    page = F.xxhash64("page_id", "url", F.array_join("lines", "\n"))
    keys = lines.select(page.alias("page"), host.alias("host"), path.alias("path"), F.transform(open_lines, lambda x: F.xxhash64(x)).alias("hashes"))
    keys = keys.where(F.size("hashes") > 0)
    near = neighbours(keys)

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_, gone = [], []
            for page, mine, near in zip(*(c.to_pylist() for c in batch.columns)):
                out: set[int] = set()
                for other in near:
                    if other != mine:
                        out |= set(shared_lines(mine, other))
                if out:
                    pages_.append(page)
                    gone.append(sorted(out))
            yield pa.RecordBatch.from_arrays([pa.array(pages_, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], ["page", "gone"])

    deleted = near.mapInArrow(difference, "page long, gone array<int>").dropDuplicates(["page"])
    rows = lines.select("page_id", "url", "lines", "open", page.alias("page")).join(deleted, "page", "left")
    # Deleted lines are numbered among the open ones.  Each step walks the lines once.
    every = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    places = F.filter(every, lambda i: F.get("open", i))
    gone = F.get(F.transform(F.array(places), lambda p: F.transform("gone", lambda g: F.get(p, g))), F.lit(0))
    kept = F.transform(F.array_except(every, gone), lambda i: F.get("lines", i))
    only = F.filter("lines", lambda x, i: ~F.get("open", i))
    # Without a shared line nothing tells own text outside an article from the rest of the page.
    outside = F.length(F.array_join(kept, "")) - F.length(F.array_join(only, ""))
    article = F.exists("open", lambda o: ~o) & (F.col("gone").isNull() | (outside <= F.length(F.array_join(only, ""))))
    text = F.array_join(F.when(article, only).when(F.col("gone").isNull(), F.col("lines")).otherwise(kept), "\n")
    rows = rows.withColumn("text", F.coalesce(text, F.lit("")))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
