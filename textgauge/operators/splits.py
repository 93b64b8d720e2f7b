"""Splits, folds and samples that are functions of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import bucket, hash32, uniform
from ..sources.tables import CLASSES
from .ranking import grouped_rank, with_exact_cuts

SPLIT_NAMES = ("train", "validation", "test")
SPLIT_WEIGHTS = (70, 15, 15)
RESOLUTION = 10_000
SEED = 42


def _by_threshold(value: Column, weights, scale: int) -> Column:
    upper, out = 0, None
    for name, w in zip(SPLIT_NAMES[:-1], weights[:-1]):
        upper += w * scale // sum(weights)
        out = F.when(value < upper, name) if out is None else out.when(value < upper, name)
    return out.otherwise(SPLIT_NAMES[-1])


def hash_split(df: DataFrame, seed=SEED, weights=SPLIT_WEIGHTS, id_col: str = "doc_id") -> DataFrame:
    """Random train/validation/test split: a projection, no shuffle, no cache."""
    return df.withColumn("split", _by_threshold(bucket(seed, RESOLUTION, id_col), weights, RESOLUTION))


def stratified_split(df: DataFrame, seed=SEED, weights=SPLIT_WEIGHTS, id_col: str = "doc_id",
                     label_col: str = "label") -> DataFrame:
    """Bernoulli split with an independent draw per class."""
    draw = bucket(seed, RESOLUTION, label_col, id_col)
    return df.withColumn("split", _by_threshold(draw, weights, RESOLUTION))


def stratified_split_exact(df: DataFrame, seed=SEED, weights=SPLIT_WEIGHTS, id_col: str = "doc_id",
                           label_col: str = "label", classes=CLASSES) -> DataFrame:
    """Every class is divided by exact (rounded) counts; a row of another or no
    class fails the job."""
    total = sum(weights)

    def first(share: int):
        return lambda n: F.floor((n * (2 * share) + total) / F.lit(2 * total))

    targets = {"train": first(weights[0]), "validation": first(weights[0] + weights[1])}
    joined, within = with_exact_cuts(df, label_col, classes, seed, targets, id_col)
    unknown = ~F.coalesce(F.col(label_col).isin(list(classes)), F.lit(False))
    split = F.when(unknown, F.raise_error(F.lit("a label outside the classes of the split")).cast("string")).when(
        within["train"], "train").when(within["validation"], "validation").otherwise("test")
    return joined.select(*df.columns, split.alias("split"))


def split_metrics(split_col: str = "split") -> dict[str, Column]:
    """Rows and positives of every split as metrics of one aggregation."""
    out = {}
    for name in SPLIT_NAMES:
        inside = F.col(split_col) == name
        out |= {f"{name}_rows": F.count_if(inside), f"{name}_positives": F.count_if(inside & (F.col("label") == 1))}
    return out


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, positives and positive ratio per split; a split without rows is
    reported with zeros."""
    whole = df.agg(*[
        F.struct(
            F.count_if(F.col("split") == s).alias("rows"),
            F.count_if((F.col("split") == s) & (F.col("label") == 1)).alias("positives"),
        ).alias(s)
        for s in SPLIT_NAMES
    ])
    rows = whole.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("split"), F.col(s)["rows"].alias("rows"), F.col(s)["positives"].alias("positives"))
        for s in SPLIT_NAMES
    ])))
    return rows.withColumn("positive_ratio", F.col("positives") / F.greatest(F.col("rows"), F.lit(1)))


def fold_assignment(df: DataFrame, k: int = 5, seed=SEED, id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """``fold_plain`` by hash; ``fold_stratified`` deals the rows of each
    class round robin, so fold sizes per class differ by one at most."""
    ranked = grouped_rank(df, [label_col], seed, id_col, rank_col="_rank")
    return ranked.select(
        *df.columns,
        bucket(seed, k, id_col).cast("int").alias("fold_plain"),
        F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int").alias("fold_stratified"),
    )


def sample_fraction(df: DataFrame, fraction: float, seed=SEED, id_col: str = "doc_id") -> DataFrame:
    """Hash sample; a smaller fraction is a subset of a larger one."""
    return df.where(bucket(seed, RESOLUTION, id_col) < int(round(fraction * RESOLUTION)))


def smallest_fraction(df: DataFrame, fractions=(0.25, 0.5, 0.75, 1.0), seed=SEED, id_col: str = "doc_id") -> DataFrame:
    """Tag each row with the smallest nested fraction that contains it."""
    draw, out = bucket(seed, RESOLUTION, id_col), None
    for f in sorted(fractions):
        hit = draw < int(round(f * RESOLUTION))
        out = F.when(hit, f) if out is None else out.when(hit, f)
    return df.withColumn("data_fraction", out)


def seeded_shuffle(df: DataFrame, seed=SEED, id_col: str = "doc_id") -> DataFrame:
    """A reproducible random order as a ``position`` column."""
    return grouped_rank(df, [], seed, id_col, rank_col="position")


def limit_sample(df: DataFrame, n: int, seed=SEED, id_col: str = "doc_id") -> DataFrame:
    """A reproducible sample of n rows: the n smallest hashes."""
    return df.orderBy(hash32(seed, id_col), id_col).limit(n)


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Inverse-frequency weights ``N / (classes * n_class)``, one per class."""
    everything = Window.partitionBy(F.lit(0))
    counts = df.groupBy(label_col).agg(F.count("*").alias("rows"))
    weight = F.sum("rows").over(everything) / (F.count("*").over(everything) * F.col("rows"))
    return counts.withColumn("weight", weight)


def with_class_weights(df: DataFrame, label_col: str = "label", classes=CLASSES) -> DataFrame:
    known = class_weights(df, label_col).where(F.col(label_col).isin(list(classes)))
    return df.join(F.broadcast(known.select(label_col, "weight")), label_col, "left")


def undersample(df: DataFrame, seed=SEED, id_col: str = "doc_id", label_col: str = "label", classes=CLASSES) -> DataFrame:
    """Thin the larger classes to about the size of the smallest one."""
    everything = Window.partitionBy(F.lit(0))
    rates = (
        df.where(F.col(label_col).isin(list(classes)))
        .groupBy(label_col).agg(F.count("*").alias("_n"))
        .select(label_col, (F.min("_n").over(everything) / F.col("_n")).alias("_rate"))
    )
    kept = df.join(F.broadcast(rates), label_col, "left").where(uniform(seed, id_col) < F.coalesce("_rate", F.lit(1.0)))
    return kept.select(*df.columns)
