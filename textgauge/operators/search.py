"""Model searches whose results are tables: the grid, the coefficients or
nodes of the best point for all rows and for every fold, and the time.

Linear models and naive Bayes are searched in shared passes (``grid_search``),
forests in passes of their own (``forest``).  Everything is written, so that later
readers neither fit again nor hold models in the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import forest, grid_search, model_tables, roc, train
from .evaluate import best_of_grid

GRID = "model string, grid_index int, params string, avg_auc double, std_auc double"
ALL_ROWS = grid_search.ALL_ROWS


@dataclass
class Found:
    """``grid(model, grid_index, params, avg_auc, std_auc)``, the
    ``ModelTables`` of the best point and ``times(model, train_time_s)``."""

    grid: DataFrame
    models: model_tables.ModelTables
    times: DataFrame

    def fitted(self) -> model_tables.ModelTables:
        """The models fitted on all rows."""
        m = self.models
        return model_tables.ModelTables(m.weights.where(F.col("fold") == ALL_ROWS), m.nodes.where(F.col("fold") == ALL_ROWS))

    def fold_models(self) -> model_tables.ModelTables:
        m = self.models
        return model_tables.ModelTables(m.weights.where(F.col("fold") != ALL_ROWS), m.nodes.where(F.col("fold") != ALL_ROWS))


def grid_points(name: str) -> list[dict]:
    """The grid of a model as plain settings, in grid order."""
    estimator, grid = train.estimator_and_grid(name)
    return [{p.name: v for p, v in params.items()} for params in grid]


def _described(point: dict) -> str:
    return ", ".join(sorted(f"{k}={v}" for k, v in point.items()))


def search(training: DataFrame, names: list[str], folds: int, settings: grid_search.Settings = grid_search.Settings()):
    """Search the linear models and naive Bayes of ``names`` together:
    ``(grid, fitted, passes)``, the grid table, all fits and the passes that
    were needed."""
    spark = training.sparkSession
    whole = grid_search.held(grid_search.feature_blocks(training, most=grid_search.PASS_ENTRIES))
    blocks = None
    try:
        size = whole.agg(F.max("size")).first()[0]
        if size is None:
            raise ValueError("no labelled rows to train on")
        every = [*range(folds), ALL_ROWS]
        found = grid_search.moments(whole, size, folds)
        live = found.live()
        blocks = grid_search.held(grid_search.gathered(grid_search.compacted(whole, live, size)))
        linear = {n: grid_points(n) for n in names if n != "NaiveBayes"}
        fitted, passes = grid_search.fit_linear(blocks, len(live), linear, every, found.only(live), settings)
        for f in fitted:
            weights = np.zeros(size)
            weights[live] = f.weights
            f.weights = weights
        if "NaiveBayes" in names:
            fitted += grid_search.fit_naive_bayes(size, grid_points("NaiveBayes"), every, found)
        areas = roc.area_under_roc(grid_search.held_out_scores(whole, fitted), ["model", "grid_index", "fold"])
        grid = areas.groupBy("model", "grid_index").agg(F.avg("auc").alias("avg_auc"), F.stddev_pop("auc").alias("std_auc")).collect()
    finally:
        whole.unpersist()
        if blocks is not None:
            blocks.unpersist()
    rows = [(r.model, r.grid_index, _described(grid_points(r.model)[r.grid_index]), r.avg_auc, r.std_auc) for r in grid]
    return spark.createDataFrame(rows, GRID), fitted, passes


FOREST = "RandomForest"


def fit_forests(training: DataFrame, folds: list[int], points: list[int] | None = None):
    """``(trees, cuts, blocks)``: the forests of some or all grid points, each
    once without every one of ``folds``; the caller lets go of the blocks."""
    estimator, grid = train.estimator_and_grid(FOREST)
    made = [estimator.copy(p) for p in grid]
    settings = forest.Settings(made[0].getMaxDepth(), made[0].getMaxBins(), made[0].getSeed())
    whole = grid_search.held(grid_search.feature_blocks(training))
    try:
        size = whole.agg(F.max("size")).first()[0]
        if size is None:
            raise ValueError("no labelled rows to train on")
        cuts = forest.candidate_splits(whole, size, settings)
        blocks = grid_search.held(forest.by_feature(whole, cuts))
        wanted = [(grid_search.Point(FOREST, k, fold), made[k].getNumTrees()) for k in (points or range(len(grid))) for fold in folds]
        return forest.grow(blocks, cuts, wanted, settings), cuts, blocks
    finally:
        whole.unpersist()


def search_forests(training: DataFrame, folds: int):
    """``(grid, trees, cuts)`` of all grid points and folds."""
    trees, cuts, blocks = fit_forests(training, [*range(folds), ALL_ROWS])
    try:
        areas = roc.area_under_roc(forest.held_out_scores(blocks, cuts, trees, FOREST), ["model", "grid_index", "fold"])
        grid = areas.groupBy("model", "grid_index").agg(F.avg("auc").alias("avg_auc"), F.stddev_pop("auc").alias("std_auc")).collect()
    finally:
        blocks.unpersist()
    rows = [(r.model, r.grid_index, _described(grid_points(FOREST)[r.grid_index]), r.avg_auc, r.std_auc) for r in grid]
    return training.sparkSession.createDataFrame(rows, GRID), trees, cuts


def searched(training: DataFrame, name: str, folds: int, path: str) -> Found:
    """Search ``name`` and write what was found under ``path``."""
    spark = training.sparkSession
    begin = time.perf_counter()
    if name == FOREST:
        grid, trees, cuts = search_forests(training, folds)
        best = best_of_grid(grid, "avg_auc").first()["grid_index"]
        models = model_tables.from_trees(spark, name, [t for t in trees if t.point.grid_index == best], cuts)
    else:
        grid, fitted, _ = search(training, [name], folds)
        best = best_of_grid(grid, "avg_auc").first()["grid_index"]
        models = model_tables.from_fitted(spark, [f for f in fitted if f.point.grid_index == best])
    seconds = time.perf_counter() - begin
    model_tables.save(models, f"{path}/models")
    grid.withColumn("train_time_s", F.lit(float(seconds))).coalesce(1).write.parquet(f"{path}/grid")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Found:
    grid = spark.read.schema(f"{GRID}, train_time_s double").parquet(f"{path}/grid")
    times = grid.groupBy("model").agg(F.max("train_time_s").alias("train_time_s"))
    return Found(grid.drop("train_time_s"), model_tables.load(spark, f"{path}/models"), times)


def union(found: list[Found]) -> Found:
    out = found[0]
    for f in found[1:]:
        out = Found(out.grid.unionByName(f.grid), out.models.union(f.models), out.times.unionByName(f.times))
    return out


def fold_predictions(found: Found, training: DataFrame, validation: DataFrame, folds: int, fold_col: str = "fold") -> DataFrame:
    """The best point's model of every fold, scored on the validation set and
    on the fold that it has not seen, as one long table."""
    models = found.fold_models()
    columns = model_tables.score_columns(models)
    own = []
    for name in sorted({m for m, _ in columns}):
        # Only the branch of a row's own fold is evaluated.
        branch = None
        for k in range(folds):
            branch = (F.when if branch is None else branch.when)(F.col(fold_col) == k, columns[(name, k)])
        own.append(F.struct(F.lit(name).alias("model"), branch.alias("s")))
    held = training.select(F.col("doc_id").alias("row_id"), F.col("label").cast("int").alias("label"), F.col(fold_col).cast("int").alias("fold"), F.explode(F.array(*own)).alias("p"))
    held = held.select("row_id", "p.model", "fold", "label", F.col("p.s.score").alias("score"), F.col("p.s.prediction").alias("prediction"))
    seen = model_tables.predictions(models, validation, folds=True)
    return held.withColumn("scope", F.lit("held_out")).unionByName(seen.withColumn("scope", F.lit("validation")))
