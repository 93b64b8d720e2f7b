"""Quality rules learned as an ordered decision list, in DataFrame functions.

Every text becomes a row of statistics.  Sequential covering then learns from
labelled rows: a rule is a conjunction of thresholds; it grows by the literal
with the best gain, is pruned back on rows that it was not grown on, and the
rows it covers are taken away before the next rule is grown.  The list becomes
one ``CASE WHEN`` expression, so it can be read, stored and edited.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the counts ``n_words``, ``word_chars`` (code points
    in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an
    earlier line) and ``n_repeat_words``.

    A null or empty text has 0 of all.  Texts are taken whole, whatever their
    length; all work happens inside the row.
    """
    text = F.coalesce("text", F.lit(""))
    d = docs.select(*keep, text.alias("_t")).select(*keep, "_t", words(F.col("_t")).alias("_w"))
    n = F.size("_w")
    chars = F.length(F.translate("_t", " \t\n\x0b\x0c\r", ""))
    symbols = F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    d = d.select(*keep, "_w", n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
                 symbols.cast("long").alias("n_symbols"), lines.alias("_l"))
    d = d.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    def window(i):
        """Hash of the window that begins at place ``i`` (0-based)."""
        return F.xxhash64(*[F.get("_w", i + j) for j in range(WINDOW)])
    d = d.withColumn("_h", F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), window)))
    # Most texts repeat nothing; the others sort their windows.  Each window is
    # then one number, its hash above and its place in the low bits, so equal
    # windows are neighbours in the order of their places.
    d = d.withColumn("_scale", F.expr("shiftleft(1L, cast(ceil(log2(n_words + 2)) as int))"))
    packed = F.transform("_h", lambda h, i: h.bitwiseAND(-F.col("_scale")) + i)
    d = d.withColumn("_p", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(packed)))
    def place(x):
        return x.bitwiseAND(F.col("_scale") - 1).cast("int")
    def same(x, y):
        near = x.bitwiseAND(-F.col("_scale")) == y.bitwiseAND(-F.col("_scale"))
        for j in range(WINDOW):
            near = near & (F.get("_w", place(x) + j) == F.get("_w", place(y) + j))
        return F.coalesce(near, F.lit(False))
    hit = F.filter("_p", lambda x, i: same(x, F.get("_p", i + 1)) | same(F.get("_p", i - 1), x))
    d = d.withColumn("_s", F.sort_array(F.transform(hit, place)))
    # Covered words: each start adds what the next one does not reach over.
    covered = F.aggregate(F.transform("_s", lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("_s", i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.size("_s") > 0, covered), F.lit(0)).cast("long"))
    return d.select(*keep, *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# The learner's view of the counts: name -> expression over COUNTS.
FEATURES: dict[str, str] = {
    "n_words": "cast(n_words as double)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "cast(n_dup_lines as double)",
}


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    limit: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.limit!r}D"


@dataclass
class DecisionList:
    """Ordered ``(literals, verdict)``; ``default`` if no rule holds.  A
    verdict is the probability of a good text."""

    rules: list[tuple[list[Literal], float]] = field(default_factory=list)
    default: float = 1.0

    def expression(self) -> Column:
        cases = "".join(f" WHEN {' AND '.join(x.sql() for x in rule)} THEN {good!r}D" for rule, good in self.rules)
        return F.expr(f"CASE{cases} ELSE {self.default!r}D END") if cases else F.lit(self.default)


@dataclass(frozen=True)
class Learner:
    """``bins``: quantiles per feature tried as thresholds; ``precision``:
    share of bad rows among those a rule covers, on growing and pruning rows;
    ``least``: bad rows a rule must cover."""

    bins: int = 32
    max_rules: int = 8
    max_literals: int = 3
    precision: float = 0.75
    least: int = 12


def _histogram(rows: DataFrame, edges: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Good and bad rows per feature and bin: one aggregation, a row per
    feature and bin at most."""
    cells = []
    for name, cuts in edges.items():
        bin_of = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(name)))
        cells.append(F.struct(F.lit(name).alias("f"), bin_of.alias("b")))
    counts = {name: [[0, 0] for _ in range(len(cuts) + 1)] for name, cuts in edges.items()}
    rows = rows.select("bad", *[F.expr(e).alias(n) for n, e in FEATURES.items() if n != "n_words"], F.col("n_words").cast("double").alias("n_words"))
    long = rows.select("bad", F.explode(F.array(*cells)).alias("c")).groupBy("c.f", "c.b").agg(
        F.sum("bad").alias("bad"), F.count("*").alias("n"))
    for r in long.collect():
        counts[r["f"]][r["b"]] = [r["n"] - r["bad"], r["bad"]]
    return counts


def _best(counts, edges, taken: list[Literal], good: int, bad: int, least: int):
    """Literal of the largest information gain in the manner of rule growing:
    bad rows kept times the rise of the log share of bad rows."""
    share, best = math.log2((bad + 1) / (good + bad + 2)), None
    for name, cells in counts.items():
        below = [0, 0]
        for i, cut in enumerate(edges[name]):
            below = [below[0] + cells[i][0], below[1] + cells[i][1]]
            for above, (g, b) in ((False, below), (True, (good - below[0], bad - below[1]))):
                if b < least or (g, b) == (good, bad):
                    continue
                gain = b * (math.log2((b + 1) / (g + b + 2)) - share)
                if best is None or gain > best[0]:
                    best = (gain, Literal(name, above, cut), g, b)
    return best if best and best[0] > 1e-9 else None


def learn(rows: DataFrame, learner: Learner = Learner()) -> DecisionList:
    """Learn from ``rows`` of statistics with ``label`` (1 good, 0 bad; null
    ignored) and ``doc_id``.  All rows are used; thirds by a hash of the id
    are held back for pruning.  Without rows of both classes the list is
    empty."""
    rows = rows.where("label is not null").select(
        *COUNTS, F.when(F.col("label") == 0, 1).otherwise(0).alias("bad"), F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("third"))
    rows = materialise(rows, "labelled-statistics")
    quantiles = [F.percentile_approx(F.expr(e), [i / learner.bins for i in range(1, learner.bins)], 10_000).alias(n) for n, e in FEATURES.items()]
    first = rows.agg(F.sum("bad").alias("bad"), F.count("*").alias("n"), *quantiles).first()
    if not first["n"] or first["bad"] in (0, first["n"]):
        return DecisionList(default=1.0 if not first["n"] or not first["bad"] else 0.0)
    edges = {n: sorted(set(first[n])) for n in FEATURES}
    # The tails, where bad texts are, get finer thresholds.
    bad_q = rows.where("bad = 1").agg(*quantiles).first()
    edges = {n: sorted(set(edges[n]) | set(bad_q[n])) for n in FEATURES}
    grow, prune = rows.where("third != 0"), rows.where("third = 0")
    out = DecisionList()

    def covered(rule: list[Literal]) -> str:
        return " AND ".join(x.sql() for x in rule)

    left = "true"
    for _ in range(learner.max_rules):
        rule: list[Literal] = []
        while len(rule) < learner.max_literals:
            now = grow.where(left).where(covered(rule) if rule else "true")
            counts = _histogram(now, edges)
            g, b = (sum(c[i] for c in next(iter(counts.values()))) for i in (0, 1))
            if not b or (rule and b >= 0.98 * (g + b)):
                break
            best = _best(counts, edges, rule, g, b, learner.least)
            if best is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # Prune: the shortest prefix with the best (bad - good) / all there.
        worth = [F.struct(F.sum(F.expr(f"int({covered(rule[:i])})")).alias("n"), F.sum(F.expr(f"int({covered(rule[:i])}) * bad")).alias("bad")).alias(f"w{i}")
                 for i in range(1, len(rule) + 1)]
        seen = prune.where(left).agg(*worth).first()
        value = {i: (2 * (seen[f"w{i}"]["bad"] or 0) - (seen[f"w{i}"]["n"] or 0)) / max(1, seen[f"w{i}"]["n"] or 0) for i in range(1, len(rule) + 1)}
        rule = rule[: max(value, key=lambda i: (round(value[i], 6), -i))]
        total = rows.where(left).where(covered(rule)).agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
        if total["bad"] < learner.least or total["bad"] < learner.precision * total["n"]:
            break
        out.rules.append((rule, (total["n"] - total["bad"] + 1) / (total["n"] + 2)))
        left = f"{left} AND NOT ({covered(rule)})"
    rest = rows.where(left).agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    out.default = (rest["n"] - rest["bad"] + 1) / (rest["n"] + 2)
    return out


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """Statistics plus ``base_failed`` and ``kept``: false if the base rules
    fail, else whether the list gives a good text at least even odds."""
    failed = base_failed()
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (rules.expression() >= 0.5))
