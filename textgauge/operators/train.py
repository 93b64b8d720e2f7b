"""MLlib training: four classifiers, grids, cross-validation, scoring."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_NAMES = ["LogisticRegression", "LinearSVC", "RandomForest", "NaiveBayes"]
MODEL_CLASSES = {
    "LogisticRegression": LogisticRegressionModel,
    "LinearSVC": LinearSVCModel,
    "RandomForest": RandomForestClassificationModel,
    "NaiveBayes": NaiveBayesModel,
}


# The settings and grids below.
def estimator_and_grid(name: str):
    """The classifier with its fixed settings and its parameter grid."""
    if name == "LogisticRegression":
        e = LogisticRegression(maxIter=100, family="binomial")
        g = ParamGridBuilder().addGrid(e.regParam, [0.01, 0.1]).addGrid(e.elasticNetParam, [0.0, 0.5])
    elif name == "LinearSVC":
        e = LinearSVC(maxIter=100)
        g = ParamGridBuilder().addGrid(e.regParam, [0.01, 0.1])
    elif name == "RandomForest":
        e = RandomForestClassifier(numTrees=50, maxDepth=8, maxBins=32, seed=42)
        g = ParamGridBuilder().addGrid(e.numTrees, [100])
    elif name == "NaiveBayes":
        e = NaiveBayes(modelType="multinomial")
        g = ParamGridBuilder().addGrid(e.smoothing, [0.5, 1.0])
    else:
        raise ValueError(f"unknown model {name!r}")
    return e, g.build()


PARALLELISM = 8


def fit(name: str, train: DataFrame, grid_index: int = 0):
    """Fit one grid point."""
    estimator, grid = estimator_and_grid(name)
    return estimator.copy(grid[grid_index]).fit(train)


@dataclass
class Searched:
    """A cross-validated search: ``cv.bestModel`` is the best grid point fitted
    again on all training rows; ``seconds`` is what search and fit took."""

    name: str
    cv: CrossValidatorModel
    seconds: float

    @property
    def model(self):
        return self.cv.bestModel


def search_all(names: list[str], train: DataFrame, folds: int, keep_folds: bool = False) -> list[Searched]:
    """Search every model on the same cached table, one after the other; the
    fits of a search run side by side."""
    train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = []
        for name in names:
            begin = time.perf_counter()
            cv = cross_validate(name, train, folds, keep_folds=keep_folds)
            out.append(Searched(name, cv, time.perf_counter() - begin))
        return out
    finally:
        train.unpersist()


def fit_times(spark, searched: list[Searched]) -> DataFrame:
    return spark.createDataFrame([(s.name, float(s.seconds)) for s in searched], "model string, train_time_s double")


def positive_score(scored: DataFrame) -> Column:
    """Probability of class 1, or the raw margin where a model has none."""
    col = "probability" if "probability" in scored.columns else "rawPrediction"
    return vector_to_array(col)[1]


def predictions(model, df: DataFrame, name: str, row_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Batch scoring into the long prediction layout."""
    scored = model.transform(df)
    return scored.select(
        F.col(row_id).alias("row_id"), *(keep or []), F.lit(name).alias("model"),
        F.col("label").cast("int").alias("label"), positive_score(scored).alias("score"), "prediction",
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def cross_validate(name: str, train: DataFrame, folds: int, fold_col: str = "fold", parallelism: int = PARALLELISM,
                   keep_folds: bool = False) -> CrossValidatorModel:
    """Grid search by k-fold cross-validation on the area under the ROC curve.

    The folds are the integer column ``fold_col``, so they are the same on
    every run and every partitioning.  ``numBins=0`` makes the area exact.
    ``keep_folds`` keeps every fold's models on the driver.
    """
    estimator, grid = estimator_and_grid(name)
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        foldCol=fold_col, parallelism=parallelism, collectSubModels=keep_folds)
    return cv.fit(train)


def grid_table(spark, name: str, cv: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters, mean and deviation of the AUC."""
    _, grid = estimator_and_grid(name)
    rows = []
    for i, params in enumerate(grid):
        text = ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))
        rows.append((name, i, text, float(cv.avgMetrics[i]), float(cv.stdMetrics[i])))
    return spark.createDataFrame(rows, "model string, grid_index int, params string, avg_auc double, std_auc double")


def best_index(cv: CrossValidatorModel) -> int:
    """First grid point with the largest mean."""
    return max(range(len(cv.avgMetrics)), key=lambda i: (cv.avgMetrics[i], -i))


def fold_predictions(name: str, cv: CrossValidatorModel, train: DataFrame, validation: DataFrame, fold_col: str = "fold") -> DataFrame:
    """The best grid point's model of every fold, scored on the validation set
    and on the fold it has not seen, as one long table."""
    best, frames = best_index(cv), []
    for fold, models in enumerate(cv.subModels):
        held_out = train.where(F.col(fold_col) == fold)
        for scope, data in (("validation", validation), ("held_out", held_out)):
            p = predictions(models[best], data, name)
            frames.append(p.withColumns({"scope": F.lit(scope), "fold": F.lit(fold)}))
    return union_all(frames)


def save_and_load(model, name: str, path: str):
    """Overwrite the saved model and read it back."""
    model.write().overwrite().save(path)
    return MODEL_CLASSES[name].load(path)


def prediction_mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows compared and rows that differ between two long tables."""
    other = b.select("row_id", "model", F.col("score").alias("s2"), F.col("prediction").alias("p2"))
    joined = a.join(other, ["row_id", "model"], "full")
    same = F.col("score").eqNullSafe(F.col("s2")) & F.col("prediction").eqNullSafe(F.col("p2"))
    return joined.groupBy("model").agg(F.count("*").alias("rows_compared"), F.count_if(~same).alias("mismatches"))
