"""Prediction tables.

Wide: one row per scored row, with ``label`` and a ``score``/``prediction``
pair per model.  Long: ``(row_id, model, label, score, prediction)``.  Rules
over plain columns stand in for fitted models where a result must be
checkable in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_text_stats
from ..sources.tables import labels, table, texts


def wide_predictions(df: DataFrame, rules: dict[str, tuple[Column, Column]], row_id: Column, label: Column,
                     keep: list[str] | None = None) -> DataFrame:
    cols = []
    for name, (score, predicted) in rules.items():
        cols.append(F.struct(score.cast("double").alias("score"), predicted.cast("double").alias("prediction")).alias(name))
    return df.select(row_id.alias("row_id"), *(keep or []), label.cast("int").alias("label"), *cols)


def to_long(wide: DataFrame, models: list[str]) -> DataFrame:
    """One row per (row, model); an expansion inside each row, no shuffle."""
    keep = [c for c in wide.columns if c not in models]
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m)["score"].alias("score"),
                              F.col(m)["prediction"].alias("prediction")) for m in models])
    return wide.select(*keep, F.inline(rows))


TEXT_RULES = ["len_rule", "word_rule", "caps_rule"]
PRICE_RULES = ["price_rule", "discount_rule", "net_rule"]


def document_rules(spark, sf_dir) -> DataFrame:
    """Three style rules on the labelled documents, wide.

    The statistics are computed next to the scan; only their five numbers
    take part in the join with the labels.
    """
    stats = with_text_stats(texts(spark, sf_dir)).drop("text")
    scored = stats.join(labels(spark, sf_dir), "doc_id")
    rules = {
        "len_rule": (F.col("text_length"), F.col("text_length") >= 500),
        "word_rule": (-F.col("avg_word_length"), F.col("avg_word_length") < 6.5),
        "caps_rule": (-F.col("caps_ratio"), F.col("caps_ratio") < 0.02),
    }
    return wide_predictions(scored, rules, F.col("doc_id"), F.col("label"))


def lineitem_rules(spark, sf_dir) -> DataFrame:
    """Three price rules on the order lines, wide: a large prediction table."""
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"]
    li = table(spark, sf_dir, "lineitem", cols)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rules = {
        "price_rule": (F.col("l_extendedprice"), F.col("l_extendedprice") >= 50000),
        "discount_rule": (F.col("l_discount"), F.col("l_discount") >= 0.05),
        "net_rule": (net, net >= 40000),
    }
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return wide_predictions(li, rules, row_id, F.col("l_returnflag") == "R")


def document_predictions(spark, sf_dir) -> DataFrame:
    return to_long(document_rules(spark, sf_dir), TEXT_RULES)


def lineitem_predictions(spark, sf_dir) -> DataFrame:
    return to_long(lineitem_rules(spark, sf_dir), PRICE_RULES)
