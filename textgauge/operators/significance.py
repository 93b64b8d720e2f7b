"""Bootstrap intervals and McNemar tests."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .evaluate import CELLS, confusion, metric_columns

REPLICATES = 1000
CHI2_95_1DF = 3.841458820694124

# P(X <= k) * 65536 for a Poisson(1) variable, rounded down.
POISSON1_CDF_16BIT = [24109, 48218, 60273, 64291, 65296, 65497, 65530, 65535]
DRAWS_PER_HASH = 8


# --- bootstrap ---------------------------------------------------------------

def interval_report(replicates: DataFrame, key: str = "model") -> DataFrame:
    """Mean and 2.5 / 97.5 percentiles (linear interpolation) of F1 and
    accuracy over the replicates."""
    aggs = []
    for name in ("f1", "acc"):
        aggs += [
            F.avg(name).alias(f"{name}_mean"),
            F.percentile(name, 0.025).alias(f"{name}_ci_lower"),
            F.percentile(name, 0.975).alias(f"{name}_ci_upper"),
        ]
    return replicates.groupBy(key).agg(*aggs)


def _poisson1(draw: Column) -> Column:
    out = None
    for k, upper in enumerate(POISSON1_CDF_16BIT):
        out = F.when(draw < upper, k) if out is None else out.when(draw < upper, k)
    return out.otherwise(len(POISSON1_CDF_16BIT))


def poisson_replicates(wide: DataFrame, models: list[str], replicates: int = REPLICATES, seed=42) -> DataFrame:
    """F1 and accuracy per (model, replicate) with Poisson(1) row weights.

    Every weight is a function of (row, replicate), shared by all models, so
    the result is reproducible in any SQL engine.  One md5 yields eight
    16-bit draws.  Rows with the same label and the same predictions are
    interchangeable, so the weights are summed per such pattern (at most
    ``2 ** (models + 1)`` of them) within the map tasks; the cells follow from
    the pattern sums.  The work is rows times replicates;
    ``multinomial_replicates`` needs one pass instead.
    """
    if replicates % DRAWS_PER_HASH:
        raise ValueError(f"replicates must be a multiple of {DRAWS_PER_HASH}")
    blocks = replicates // DRAWS_PER_HASH
    draws = range(DRAWS_PER_HASH)
    drawn = wide.select(
        "row_id", (F.col("label") == 1).alias("_hit"), *[(F.col(m)["prediction"] == 1.0).alias(m) for m in models],
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
    ).withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "row_id", "_block")))
    weights = {f"_w{i}": _poisson1(F.conv(F.substring("_h", 4 * i + 1, 4), 16, 10).cast("int")) for i in draws}
    patterns = drawn.withColumns(weights).groupBy("_hit", *models, "_block").agg(
        *[F.sum(f"_w{i}").alias(f"_w{i}") for i in draws])

    # From here on: a row per (pattern, replicate), independent of the input size.
    by_replicate = patterns.select("_hit", *models, F.inline(F.array(*[
        F.struct((F.col("_block") * DRAWS_PER_HASH + i).alias("replicate"), F.col(f"_w{i}").alias("w")) for i in draws])))
    by_model = by_replicate.select("replicate", "_hit", "w", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("_said")) for m in models])))
    hit, said = F.col("_hit"), F.col("_said")
    cells = by_model.groupBy("model", "replicate").agg(*[
        F.coalesce(F.sum(F.when(cond, F.col("w"))), F.lit(0)).alias(cell)
        for cell, cond in zip(CELLS, (hit & said, ~hit & said, hit & ~said, ~hit & ~said))])
    return _replicate_metrics(cells)


def _replicate_metrics(cells: DataFrame) -> DataFrame:
    cols = metric_columns()
    return cells.select("model", "replicate", cols["f1_positive"].alias("f1"), cols["accuracy"].alias("acc"))


def multinomial_replicates(pred: DataFrame, replicates: int = REPLICATES, seed: int = 42) -> DataFrame:
    """F1 and accuracy per (model, replicate), resampling the confusion cells.

    Drawing n rows with replacement changes the metrics only through the four
    cells, and those are multinomial(n, cells / n): the table is aggregated
    once and each replicate is one draw, whatever n is.
    """
    cells = confusion(pred, ["model"])
    draws = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))

    def draw(batches):
        for pdf in batches:
            out = np.empty((len(pdf), 4), dtype=np.int64)
            for i, row in enumerate(pdf.itertuples(index=False)):
                counts = np.array([row.TP, row.FP, row.FN, row.TN], dtype=np.float64)
                n = int(counts.sum())
                rng = np.random.default_rng([seed, int(row.replicate), *row.model.encode()])
                out[i] = rng.multinomial(n, counts / max(n, 1)) if n else 0
            yield pd.DataFrame({"model": pdf["model"], "replicate": pdf["replicate"],
                                **{c: out[:, j] for j, c in enumerate(CELLS)}})

    schema = "model string, replicate int, TP long, FP long, FN long, TN long"
    return _replicate_metrics(draws.mapInPandas(draw, schema))


# --- McNemar -----------------------------------------------------------------

def align(pred: DataFrame, models: list[str]) -> DataFrame:
    """One row per ``row_id`` with a 0/1 "was right" column per model.

    The long table is grouped by the row id, so alignment does not rely on
    row order; a model without a prediction for the row gives null.
    """
    right = (F.col("prediction") == F.col("label")).cast("int")
    return pred.groupBy("row_id").agg(*[F.max(F.when(F.col("model") == m, right)).alias(m) for m in models])


def right_flags(wide: DataFrame, models: list[str]) -> DataFrame:
    """The same columns from a wide prediction table, without a shuffle."""
    return wide.select(*[(F.col(m)["prediction"] == F.col("label")).cast("int").alias(m) for m in models])


def mcnemar_counts(flags: DataFrame, models: list[str]) -> DataFrame:
    """Disagreement counts b, c of every unordered model pair: two counters
    per pair in a single aggregation, no pair rows are produced per row."""
    aggs, rows = [], []
    for i, (a, b) in enumerate(combinations(models, 2)):
        aggs.append(F.count_if((F.col(a) == 1) & (F.col(b) == 0)).alias(f"b{i}"))
        aggs.append(F.count_if((F.col(a) == 0) & (F.col(b) == 1)).alias(f"c{i}"))
        rows.append(F.struct(
            F.lit(a).alias("model_1"), F.lit(b).alias("model_2"),
            F.col(f"b{i}").alias("b_correct1_wrong2"), F.col(f"c{i}").alias("c_wrong1_correct2"),
        ))
    return flags.agg(*aggs).select(F.inline(F.array(*rows)))


@F.pandas_udf(DoubleType())
def chi2_tail_1df(x: pd.Series) -> pd.Series:
    """P(chi-square with one degree of freedom > x)."""
    return x.map(lambda v: math.erfc(math.sqrt(v / 2.0)))


def mcnemar_test(counts: DataFrame) -> DataFrame:
    """Continuity-corrected statistic, p value and the 5% verdict.  The UDF
    sees one row per model pair."""
    b, c = F.col("b_correct1_wrong2"), F.col("c_wrong1_correct2")
    n = b + c
    chi2 = F.when(n == 0, F.lit(0.0)).otherwise(
        F.pow((F.abs(b - c) - 1).cast("double"), F.lit(2.0)) / F.nullif(n, F.lit(0)).cast("double"))
    return counts.withColumn("chi2", chi2).withColumn(
        "p_value", F.when(n == 0, F.lit(1.0)).otherwise(chi2_tail_1df("chi2"))
    ).withColumn("significant_005", F.col("chi2") > CHI2_95_1DF)
