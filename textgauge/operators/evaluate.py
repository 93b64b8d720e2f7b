"""Confusion cells and every metric that follows from them, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import f1, ratio
from .roc import WEIGHT, area_under_roc

CELLS = ["TP", "FP", "FN", "TN"]


def confusion(pred: DataFrame, keys: list[str]) -> DataFrame:
    """TP/FP/FN/TN per group; four counters combined on the map side, so the
    shuffle carries one row per task and group."""
    hit, said = _known("label") == 1, _known("prediction") == 1.0
    n = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1)

    def total(cell: Column) -> Column:
        return F.sum(F.when(cell, n).otherwise(0))

    return pred.groupBy(*keys).agg(
        total(hit & said).alias("TP"),
        total(~hit & said).alias("FP"),
        total(hit & ~said).alias("FN"),
        total(~hit & ~said).alias("TN"),
    )


def _known(column: str) -> Column:
    """A row without label or prediction belongs to no cell; it fails the job
    instead of vanishing from the totals."""
    missing = F.raise_error(F.lit(f"null {column} in a prediction table")).cast("double")
    return F.coalesce(F.col(column).cast("double"), missing)


def counted(pred: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per distinct ``(keys, label, prediction, score)``: all that cells
    and ROC need, so that the predictions are computed once for both."""
    return pred.groupBy(*keys, "label", "prediction", "score").agg(F.count("*").alias(WEIGHT))


def metric_columns() -> dict[str, Column]:
    """Weighted metrics average the two classes by their size; the positive
    metrics look at class 1 only.  The two families are named apart."""
    tp, fp, fn, tn = (F.col(c) for c in CELLS)
    pos, neg, n = tp + fn, tn + fp, tp + fp + fn + tn

    def weighted(of_pos: Column, of_neg: Column) -> Column:
        return ratio(of_pos * pos + of_neg * neg, n)

    return {
        "accuracy": ratio(tp + tn, n),
        "f1_weighted": weighted(f1(tp, fp, fn), f1(tn, fn, fp)),
        "precision_weighted": weighted(ratio(tp, tp + fp), ratio(tn, tn + fn)),
        "recall_weighted": weighted(ratio(tp, pos), ratio(tn, neg)),
        "f1_positive": f1(tp, fp, fn),
        "precision_positive": ratio(tp, tp + fp),
        "recall_positive": ratio(tp, pos),
    }


def with_metrics(cells: DataFrame, digits: int | None = None) -> DataFrame:
    cols = metric_columns()
    if digits is not None:
        cols = {k: F.round(v, digits) for k, v in cols.items()}
    return cells.withColumns(cols)


def classification_metrics(pred: DataFrame, keys: list[str], digits: int | None = None) -> DataFrame:
    return with_metrics(confusion(pred, keys), digits)


def evaluate(pred: DataFrame, keys: list[str]) -> DataFrame:
    """Cells, metrics and exact ROC area per group."""
    once = counted(pred, keys)
    return classification_metrics(once, keys).join(area_under_roc(once, keys), keys)


def fold_summary(per_fold: DataFrame, key: str = "model") -> DataFrame:
    """Mean and population deviation of F1 and AUC over the folds."""
    return per_fold.groupBy(key).agg(
        F.avg("f1_weighted").alias("avg_f1"),
        F.stddev_pop("f1_weighted").alias("std_f1"),
        F.avg("auc").alias("avg_auc"),
        F.stddev_pop("auc").alias("std_auc"),
    )


# Limits and wording of the stability bands.
STABILITY_BANDS = [
    (0.01, "Very Stable (std < 0.01)"),
    (0.03, "Stable (std < 0.03)"),
    (0.05, "Moderately Stable"),
]
UNSTABLE = "Unstable (high variance — potential overfitting)"


def stability(std: Column) -> Column:
    out = None
    for limit, text in STABILITY_BANDS:
        out = F.when(std < limit, text) if out is None else out.when(std < limit, text)
    return out.otherwise(UNSTABLE)


def best_of_grid(scores: DataFrame, metric: str, index: str = "grid_index", key: str = "model") -> DataFrame:
    """Grid point with the largest metric; the first one wins a tie."""
    best = F.max(F.struct(F.col(metric).alias("m"), (-F.col(index)).alias("i")))
    return scores.groupBy(key).agg(best.alias("b")).select(
        key, (-F.col("b")["i"]).alias(index), F.col("b")["m"].alias(metric)
    )
