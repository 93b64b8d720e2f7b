"""Audits, cleaning filters, class balance and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import MIN_CHARS, STAT_COLUMNS, cleaned
from ..sources.observed import Observed
from ..sources.tables import LABEL_NAMES
from .dedup import drop_duplicate_texts

# Defaults of missing cells and the limit of a balanced table.
DEFAULTS = {"title": "Unknown", "subject": "general", "date": "unknown", "source": "unknown"}
IMBALANCE_LIMIT = 1.5


def is_blank(col: str) -> Column:
    return F.col(col).isNull() | (F.trim(F.col(col).cast("string")) == "")


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null-or-blank rows of every column, all in one pass."""
    counted = df.agg(*[F.count_if(is_blank(c)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("blank_rows")) for c in columns])
    return counted.select(F.inline(rows))


def fill_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    return df.fillna({k: v for k, v in (defaults or DEFAULTS).items() if k in df.columns})


def clean_articles(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Drop missing and short texts, keep one row per text, fill defaults."""
    kept = df.dropna(subset=["text"]).where(F.length("text") >= min_chars)
    return fill_defaults(drop_duplicate_texts(kept))


def clean_text(df: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Replace the text by its cleaned form and drop what became too short.

    The length test sits inside the generator.  As an ordinary filter it
    would be pushed below the projection, and the regexes would run twice.
    """
    kept = F.filter(F.array(cleaned(text_col)), lambda t: F.length(t) >= min_chars)
    return df.select(*[c for c in df.columns if c != text_col], F.explode(kept).alias(text_col))


def label_name(label_col: str = "label", names: dict[int, str] | None = None) -> Column:
    names = names or LABEL_NAMES
    out = None
    for value, name in names.items():
        cond = F.col(label_col) == value
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("count")).withColumn("label_name", label_name())


def class_imbalance(df: DataFrame) -> DataFrame:
    """Share per class, largest-to-smallest ratio and a verdict."""
    # The window sees one row per class.
    everything = Window.partitionBy(F.lit(0))
    d = class_distribution(df)
    ratio = F.max("count").over(everything) / F.min("count").over(everything)
    return d.select(
        "label", "label_name", "count",
        (F.col("count") * 100.0 / F.sum("count").over(everything)).alias("share_pct"),
        ratio.alias("imbalance_ratio"),
        F.when(ratio < IMBALANCE_LIMIT, "balanced").otherwise("imbalanced").alias("verdict"),
    )


def row_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("distinct_values"))


def _texts_by_digest(df: DataFrame, min_chars: int, text_col: str) -> DataFrame:
    """Copies of a text are counted by digest; length and cleaned length are
    properties of the text, so they survive the grouping."""
    measured = df.select(
        F.sha2(F.col(text_col), 256).alias("digest"),
        is_blank(text_col).alias("blank"),
        (F.length(text_col) >= min_chars).alias("long_enough"),
        (F.length(cleaned(text_col)) >= min_chars).alias("clean_long_enough"),
    )
    return measured.groupBy("digest").agg(
        F.count("*").alias("copies"),
        F.max("blank").alias("blank"),
        F.max("long_enough").alias("long_enough"),
        F.max("clean_long_enough").alias("clean_long_enough"),
    )


def quality_funnel(df: DataFrame, min_chars: int = MIN_CHARS, text_col: str = "text") -> DataFrame:
    """Rows left after each cleaning stage, from a single scan."""
    t = _texts_by_digest(df, min_chars, text_col)
    present, long_enough = F.col("digest").isNotNull(), F.coalesce("long_enough", F.lit(False))
    clean = long_enough & F.coalesce("clean_long_enough", F.lit(False))
    counts = t.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(present, F.col("copies"))), F.lit(0)).alias("text_present"),
        F.coalesce(F.sum(F.when(long_enough, F.col("copies"))), F.lit(0)).alias("long_enough"),
        F.count_if(long_enough).alias("distinct_text"),
        F.count_if(clean).alias("cleaned"),
    )
    stages = ["raw", "text_present", "long_enough", "distinct_text", "cleaned"]
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("rows"))
                     for i, s in enumerate(stages)])
    return counts.select(F.inline(rows))


def cleaned_and_counted(df: DataFrame, watch: Observed, min_chars: int = MIN_CHARS) -> DataFrame:
    """The cleaning chain with its stages marked in ``watch``: writing the
    result gives the rows left after each of them.

    One scan: copies are dropped by an aggregation that carries the row of the
    smallest id, not by a join with the rows to keep.
    """
    df = watch.at(watch.at(df, "raw").dropna(subset=["text"]), "text_present")
    df = watch.at(df.where(F.length("text") >= min_chars), "long_enough")
    first = df.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min_by(F.struct(*df.columns), "doc_id").alias("row"))
    df = watch.at(first.select("row.*"), "distinct_text")
    return watch.at(clean_text(df, min_chars=min_chars), "cleaned")


def data_quality_summary(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(metric, value)`` rows: text quality and labelling in one table."""
    t = _texts_by_digest(df, min_chars, "text")
    long_enough = F.coalesce("long_enough", F.lit(False))
    texts = t.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count_if(long_enough).alias("records_after_cleaning"),
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("copies"))), F.lit(0)).alias("blank_texts"),
        F.coalesce(F.sum(F.when(F.col("digest").isNotNull(), F.col("copies") - 1)), F.lit(0)).alias("duplicate_texts"),
    )
    rows = df.agg(
        F.count("label").alias("labelled_records"),
        F.count_if(F.col("label") == 1).alias("positive_records"),
        F.count_if(F.col("subject") == "en").alias("english_records"),
        F.count_if(is_blank("source")).alias("blank_sources"),
    )

    def unpivot(one_row: DataFrame) -> DataFrame:
        return one_row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in one_row.columns
        ])))

    return unpivot(texts).unionByName(unpivot(rows))


_STATISTICS = {
    "count": lambda c: F.count(c).cast("double"),
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def stats_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column."""
    columns = columns or STAT_COLUMNS
    one_row = df.agg(*[f(c).alias(f"{c}__{s}") for c in columns for s, f in _STATISTICS.items()])
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in _STATISTICS]) for c in columns
    ])))


def stats_by_class(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean and sample deviation of the statistics per class."""
    columns = columns or STAT_COLUMNS
    aggs = [F.count("*").alias("rows")]
    for c in columns:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return df.groupBy("label").agg(*aggs).withColumn("label_name", label_name())
