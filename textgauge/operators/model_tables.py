"""Fitted classifiers as tables, and scoring by expressions made from them.

``weights(model, fold, link, threshold, size, feature, value)`` has a row per
coefficient that is not zero and one with ``feature`` -1 for the intercept; the
``link`` is ``probability`` or ``margin``.  ``nodes(model, fold, tree, node,
feature, split, left, right, score)`` has a row per tree node; leaves have
``left`` -1.  ``fold`` -1 is a model fitted on all rows.

A model is turned into one column expression over the feature vector, so that
scoring is a projection next to the scan: no shuffle, no Python.  What goes into
the plan is as large as the model, never as the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .forest import Tree
from .grid_search import ALL_ROWS, Fitted

WEIGHTS = "model string, fold int, link string, threshold double, size int, feature int, value double"
NODES = "model string, fold int, tree int, node int, feature int, split double, left int, right int, score double"
LINKS = {"LogisticRegression": "probability", "NaiveBayes": "probability", "LinearSVC": "margin"}


@dataclass
class ModelTables:
    weights: DataFrame
    nodes: DataFrame

    def union(self, other: ModelTables) -> ModelTables:
        return ModelTables(self.weights.unionByName(other.weights), self.nodes.unionByName(other.nodes))

    def of(self, model: str) -> ModelTables:
        return ModelTables(self.weights.where(F.col("model") == model), self.nodes.where(F.col("model") == model))


def no_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], NODES)


def from_fitted(spark: SparkSession, fitted: list[Fitted]) -> ModelTables:
    """Linear models and naive Bayes of a grid search."""
    rows = []
    for f in fitted:
        link = LINKS[f.point.model]
        head = (f.point.model, int(f.point.fold), link, 0.5 if link == "probability" else 0.0, len(f.weights))
        rows.append((*head, -1, float(f.intercept)))
        rows += [(*head, int(j), float(f.weights[j])) for j in np.flatnonzero(f.weights)]
    return ModelTables(spark.createDataFrame(rows, WEIGHTS), no_nodes(spark))


def from_linear(spark: SparkSession, name: str, model, fold: int = ALL_ROWS) -> ModelTables:
    """A fitted MLlib logistic regression, linear SVM or naive Bayes."""
    if name == "NaiveBayes":
        theta, pi = model.theta.toArray(), model.pi.toArray()
        weights, intercept = theta[1] - theta[0], pi[1] - pi[0]
    else:
        weights, intercept = model.coefficients.toArray(), model.intercept
    link = LINKS[name]
    threshold = model.getThreshold() if name != "NaiveBayes" else 0.5
    head = (name, fold, link, float(threshold), len(weights))
    rows = [(*head, -1, float(intercept)), *((*head, int(j), float(weights[j])) for j in np.flatnonzero(weights))]
    return ModelTables(spark.createDataFrame(rows, WEIGHTS), no_nodes(spark))


def from_forest(spark: SparkSession, name: str, model, path: str, fold: int = ALL_ROWS) -> ModelTables:
    """A fitted MLlib forest, by way of its saved node table at ``path``.  A
    leaf scores the share of class 1 among its rows."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    stats = n["impurityStats"]
    whole = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.col("treeID").alias("tree"), n["id"].alias("node"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("split"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.when(whole > 0, F.get(stats, F.lit(1)) / whole).otherwise(0.0).alias("score"))
    return ModelTables(spark.createDataFrame([], WEIGHTS), nodes)


def from_trees(spark: SparkSession, name: str, trees: list[Tree], cuts: np.ndarray) -> ModelTables:
    """The trees of a forest search; a leaf scores the share of class 1 among
    its rows."""
    columns: list[list] = [[] for _ in range(8)]
    for t in trees:
        for node, left in enumerate(t.left):
            f, inner = t.feature[node], left >= 0
            row = (t.point.fold, t.number, node, f, float(cuts[f, t.bin[node]]) if inner else None, left, left + 1 if inner else -1, t.score(node))
            for c, v in zip(columns, row):
                c.append(v)
    table = pa.table([pa.array([name] * len(columns[0])), *map(pa.array, columns)], names=[c.split()[0] for c in NODES.split(", ")])
    nodes = spark.createDataFrame(table).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in NODES.split(", ")])
    return ModelTables(spark.createDataFrame([], WEIGHTS), nodes)


# --- scoring ---------------------------------------------------------------------------------------

def _numbers(values, kind: str) -> Column:
    """A constant array; the optimiser folds it once."""
    text = ",".join(map(repr, np.asarray(values).tolist()))
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def _margin(features: str, weights: np.ndarray, intercept: float) -> Column:
    v, w = F.unwrap_udt(features), _numbers(weights, "double")
    place = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    terms = F.zip_with(place, v["values"], lambda i, x: x * F.get(w, i))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) + F.lit(float(intercept))


def _forest_score(features: str, nodes) -> Column:
    """Mean leaf score over trees; a row of ``nodes`` is (tree, node, feature,
    split, left, right, score)."""
    from pyspark.ml.functions import vector_to_array

    order = sorted(range(len(nodes)), key=lambda k: (nodes[k][0], nodes[k][1]))
    place = {(nodes[k][0], nodes[k][1]): at for at, k in enumerate(order)}
    rows = [nodes[k] for k in order]
    child = {side: [place[(r[0], r[side])] if r[4] >= 0 else -1 for r in rows] for side in (4, 5)}
    depth, roots = 0, [at for at, r in enumerate(rows) if r[1] == 0]
    level = roots
    while level := [c for at in level if child[4][at] >= 0 for c in (child[4][at], child[5][at])]:
        depth += 1
    feature, split = _numbers([r[2] for r in rows], "int"), _numbers([0.0 if r[3] is None else r[3] for r in rows], "double")
    left, right, score = _numbers(child[4], "int"), _numbers(child[5], "int"), _numbers([r[6] for r in rows], "double")
    steps = F.array_repeat(F.lit(0), depth)

    def walk(x, root):
        return F.aggregate(steps, root, lambda n, _: F.when(F.get(left, n) < 0, n).otherwise(
            F.when(F.get(x, F.get(feature, n)) <= F.get(split, n), F.get(left, n)).otherwise(F.get(right, n))))

    def mean(x):
        return F.aggregate(_numbers(roots, "int"), F.lit(0.0), lambda a, root: a + F.get(score, walk(x, root))) / F.lit(float(len(roots)))

    # Bound to a variable, so that the vector is laid out once per row.
    return F.get(F.transform(F.array(vector_to_array(features)), mean), F.lit(0))


def score_columns(models: ModelTables, features: str = "features") -> dict[tuple[str, int], Column]:
    """A struct of score and prediction for each ``(model, fold)``; what is
    read here is the size of the models."""
    out, grouped, trees = {}, {}, {}
    for r in models.weights.collect():
        grouped.setdefault((r.model, r.fold, r.link, r.threshold, r.size), []).append((r.feature, r.value))
    for (model, fold, link, threshold, size), pairs in grouped.items():
        weights, intercept = np.zeros(size), 0.0
        for j, value in pairs:
            if j < 0:
                intercept = value
            else:
                weights[j] = value
        margin = _margin(features, weights, intercept)
        score = F.lit(1.0) / (F.exp(-margin) + 1.0) if link == "probability" else margin
        out[(model, fold)] = (score, threshold)
    for r in models.nodes.collect():
        trees.setdefault((r.model, r.fold), []).append(tuple(r)[2:])
    for key, nodes in trees.items():
        out[key] = (_forest_score(features, nodes), 0.5)
    return {key: _judged(score, threshold) for key, (score, threshold) in out.items()}


def _judged(score: Column, threshold: float) -> Column:
    """Score and prediction; the score is bound to a variable, so that it is
    computed once for both."""
    both = F.transform(F.array(score), lambda x: F.struct(x.alias("score"), (x > threshold).cast("double").alias("prediction")))
    return F.get(both, F.lit(0))


def predictions(models: ModelTables, rows: DataFrame, row_id: str = "doc_id", keep: list[str] | None = None, features: str = "features",
                folds: bool = False) -> DataFrame:
    """``(row_id, [keep], model, [fold], label, score, prediction)``: every row
    scored by every model in one scan."""
    scored = [F.struct(F.lit(m).alias("model"), F.lit(f).alias("fold"), s.alias("s")) for (m, f), s in sorted(score_columns(models, features).items())]
    out = rows.select(F.col(row_id).alias("row_id"), *(keep or []), F.col("label").cast("int").alias("label"), F.explode(F.array(*scored)).alias("p"))
    return out.select("row_id", *(keep or []), "p.model", *(["p.fold"] if folds else []), "label", F.col("p.s.score").alias("score"), F.col("p.s.prediction").alias("prediction"))


# --- versions on disk --------------------------------------------------------------------------------

def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions saved under ``root``, ascending."""
    try:
        found = spark.read.schema("version int").parquet(f"{root}/versions").distinct().collect()
    except AnalysisException:
        return []
    return sorted(r.version for r in found)


def save(models: ModelTables, root: str) -> int:
    """Add a version; the earlier ones stay as they are."""
    spark = models.weights.sparkSession
    version = max(versions(spark, root), default=0) + 1
    for name, table in (("nodes", models.nodes), ("weights", models.weights)):
        table.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}/{version}")
    # A version counts once it is whole; what a broken attempt left is replaced.
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/versions")
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> ModelTables:
    """A saved version, the last one by default."""
    version = max(versions(spark, root)) if version is None else version
    weights, nodes = (
        spark.read.schema(schema).parquet(f"{root}/{name}/{version}") for name, schema in (("weights", WEIGHTS), ("nodes", NODES)))
    return ModelTables(weights, nodes)
