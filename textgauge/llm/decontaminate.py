"""Benchmark decontamination by question templates, in DataFrame functions.

Numbers, names (capitalised words) and units become typed placeholders, case
and punctuation go; what is left of a text is its template.  Windows of the
benchmark templates are joined by hash with the windows of all documents.  A
document that holds most windows of an item in place is a candidate; there the
words behind the placeholders must correspond one to one, so a question asked
again with other values is found, and a chance likeness of templates is not.

With ``Rule.any_case`` there is a second view of each text, in lower case: words
are themselves there and only numbers and units are placeholders.  It finds
copies in other case, and titles and sums word for word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .sizes import small

# Units of measure that follow a number.
UNITS = [
    "%", "$", "€", "£", "bytes", "cents", "cm", "days", "degrees", "dollars", "euros", "feet", "ft", "g", "gb", "grams", "h",
    "hours", "hz", "inches", "kb", "kg", "kilograms", "kilometers", "km", "l", "lb", "liters", "m", "mb", "meters", "mg",
    "miles", "min", "minutes", "ml", "mm", "months", "ms", "ounces", "oz", "percent", "pounds", "s", "seconds", "tb", "tons",
    "v", "w", "watts", "weeks", "yards", "years",
]
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&+=/\\_~^`@-–—“”‘’«»¿¡…"
SPACE = r"[\x20\x09-\x0D]+"
NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"
# A number does not begin inside a word: names such as "x12" stay words.  The
# digit is asked first, which ends most places of a text at once.
_NUMBER = r"(?=[0-9])(?<![\p{L}\p{M}0-9])[0-9]+(?:[.,:/][0-9]+)*"
_UNITS = "|".join("\\" + u if u == "$" else u for u in sorted(UNITS, key=len, reverse=True))
# The unit is a word of its own or ends the word of the number.
_QUANTITY = rf"{NUMBER}({SPACE})?(?:{_UNITS})(?![\p{{L}}0-9])"
_NAME = r"\p{Lu}[\p{L}\p{M}]*"


@dataclass(frozen=True)
class Rule:
    """``coverage``: share of an item's windows that must be found in place;
    ``agreement``: share of distinct slot values that must correspond;
    ``any_case``: texts are also compared in lower case, without names, and
    placeholders alone by the words behind them."""

    window: int = 5
    coverage: float = 0.8
    agreement: float = 0.8
    any_case: bool = False
    broadcast_windows: int = 500_000
    broadcast_ids: int = 500_000


def _tokens(text: Column) -> Column:
    plain = F.lower(F.translate(text, PUNCTUATION, ""))
    return F.array_remove(F.split(plain, SPACE), "")


def template(text: Column | str) -> Column:
    """The template tokens of a text; as many as ``raw_tokens`` gives."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.regexp_replace(c, _NUMBER, NUMBER)
    c = F.regexp_replace(c, _QUANTITY, f"{NUMBER}$1{UNIT}")
    c = F.regexp_replace(c, _NAME, NAME)
    return _tokens(c)


def raw_tokens(text: Column | str) -> Column:
    """The words behind the template tokens, place by place.

    A replaced unit such as ``%`` is no punctuation here, so it is kept."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.regexp_replace(c, rf"({_NUMBER})({SPACE})?(?:{_UNITS})(?![\p{{L}}0-9])", f"$1$2{UNIT}")
    return _tokens(c)


NAMES, FOLDED = "names", "folded"


def _views(rule: Rule) -> list[str]:
    return [NAMES, FOLDED] if rule.any_case else [NAMES]


def _seen(text: str, kind: str) -> tuple[Column, Column]:
    """Template tokens and the words behind them in a view."""
    c = F.lower(F.col(text)) if kind == FOLDED else F.col(text)
    return template(c), raw_tokens(c)


def _windows(df: DataFrame, key: str, width: int, kind: str) -> DataFrame:
    """``(key, place, h)`` of every window of ``width`` of the ``tokens``.  In
    the folded view placeholders alone are hashed by their ``raw`` words."""
    own = ["word", *[F.get("tokens", F.col("place") + j) for j in range(1, width)]]
    h = F.xxhash64(F.lit(kind), *own)
    # Windows are put together behind the explosion, in generated code.  A filter on the size of ``tokens`` before it,
    # which an inner explosion brings along, would go below the projection and make the tokens twice.
    df = df.select("*", F.posexplode_outer("tokens").alias("place", "word")).where(F.col("place") <= F.size("tokens") - width)
    if kind == FOLDED:
        # Mostly the first word already is no placeholder.
        blank = reduce(and_, [F.col("word") < "\u0004", *[w < "\u0004" for w in own[1:]]])
        h = F.when(blank, F.xxhash64(F.lit("words"), *[F.get("raw", F.col("place") + j) for j in range(width)])).otherwise(h)
    return df.select(key, "place", h.alias("h"))


def leaks(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, item_id, place, n_windows, matched, n_slots)``: documents
    that hold a benchmark item, and where (template token).

    Both tables need ``text`` and their id; other columns are ignored.  Null
    ids, null texts and texts without words match nothing.  An item shorter
    than a window is one window of its own length.  Windows of placeholders
    alone say nothing in the view with names and do not count there; an item
    with no other is found by ``any_case`` only.  A repeated row of either
    table is the same document or item.  An item is found if it reaches the
    coverage in one of the views.  Each pair of document and item is reported
    once, at the place with most windows, the first one of ties.
    """
    texts = benchmark.where("item_id is not null").select("item_id", F.col("text").alias("item_text")).dropDuplicates()
    views = [texts.select("item_id", F.lit(k).alias("kind"), _seen("item_text", k)[0].alias("tokens"), _seen("item_text", k)[1].alias("raw"))
             for k in _views(rule)]
    items = views[0] if len(views) == 1 else views[0].union(views[1])
    items = materialise(items.where("size(tokens) > 0").withColumn("width", F.least(F.size("tokens"), F.lit(rule.window))), "items")
    widths = items.select("kind", "width").distinct().collect()  # at most ``window`` numbers a view
    known = docs.where("doc_id is not null and text is not null")
    hits = wanted = None
    for kind, width in sorted(map(tuple, widths)):
        own = items.where((F.col("kind") == kind) & (F.col("width") == width))
        windows = _windows(own, "item_id", width, kind)
        if kind == NAMES:
            plain = F.exists(F.slice("tokens", F.col("place") + 1, width), lambda w: ~w.rlike(f"^[{NUMBER}{UNIT}{NAME}]+$"))
            windows = windows.join(own.select("item_id", "tokens"), "item_id").where(plain)
        own = materialise(windows.select("item_id", "h", F.col("place").alias("at")).distinct(), "item-windows")
        some = own.groupBy("item_id").agg(F.count_distinct("at").alias("n_windows")).withColumn("kind", F.lit(kind))
        wanted = some if wanted is None else wanted.union(some)
        tokens, raw = _seen("text", kind)
        seen = known.select("doc_id", tokens.alias("tokens"), *([raw.alias("raw")] if kind == FOLDED else []))
        found = _windows(seen, "doc_id", width, kind).join(small(own, rule.broadcast_windows), "h").select(
            "doc_id", "item_id", F.lit(kind).alias("kind"), "at", (F.col("place") - F.col("at")).alias("shift"))
        hits = found if hits is None else hits.union(found)
    if hits is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, place long, n_windows long, matched long, n_slots long")
    counts = hits.groupBy("doc_id", "item_id", "kind", "shift").agg(F.count_distinct("at").alias("matched"))
    enough = F.col("matched") >= rule.coverage * F.col("n_windows")
    counts = counts.join(small(materialise(wanted, "item-counts"), rule.broadcast_windows), ["item_id", "kind"]).where(enough)
    first = F.max_by(F.struct("shift", "matched", "n_windows"), F.struct("matched", -F.col("shift")))
    best = materialise(counts.groupBy("doc_id", "item_id", "kind").agg(first.alias("b")).select("doc_id", "item_id", "kind", "b.*"), "leak-places")

    # Read the few candidate documents again for the words of their slots.
    again, out = known.select("doc_id", "text"), None
    for kind in _views(rule):
        tokens, raw = _seen("text", kind)
        pairs = again.join(small(best.where(F.col("kind") == kind), rule.broadcast_ids), "doc_id").select(
            "doc_id", "item_id", "shift", "matched", "n_windows", tokens.alias("doc_tokens"), raw.alias("doc_raw"))
        own = items.where(F.col("kind") == kind).select("item_id", "tokens", F.col("raw").alias("item_raw"))
        pairs = _agreeing(pairs.join(small(own, rule.broadcast_windows), "item_id"), rule)
        out = pairs if out is None else out.union(pairs)
    top = F.max_by(F.struct("place", "n_windows", "matched", "n_slots"), F.struct(F.col("matched") / F.col("n_windows"), "n_windows", -F.col("place"), "n_slots"))
    return out.groupBy("doc_id", "item_id").agg(top.alias("b")).select("doc_id", "item_id", "b.*")


def _agreeing(pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs in which the words of the slots correspond one to one."""
    def at(i, column):
        return F.get(column, i + F.col("shift"))
    places = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: (
        F.get("tokens", i).rlike(f"[{NUMBER}{UNIT}{NAME}]")) & (i + F.col("shift") >= 0) & (F.get("tokens", i) == at(i, "doc_tokens")))
    slots = F.transform(places, lambda i: F.struct(F.get("item_raw", i).alias("item"), at(i, "doc_raw").alias("doc")))
    pairs = pairs.withColumn("slots", slots)
    together = F.size(F.array_distinct("slots"))
    left, right = F.size(F.array_distinct("slots.item")), F.size(F.array_distinct("slots.doc"))
    pairs = pairs.where((left >= rule.agreement * together) & (right >= rule.agreement * together))
    return pairs.select(
        "doc_id", "item_id", F.greatest(F.col("shift"), F.lit(0)).cast("long").alias("place"), F.col("n_windows").cast("long").alias("n_windows"),
        F.col("matched").cast("long").alias("matched"), F.size("slots").cast("long").alias("n_slots"))
