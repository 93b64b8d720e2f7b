"""Training: searches, folds, scoring, round trips, and the invariants of the
queries that no SQL can compute."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textgauge.operators import importance, train

FOLDS = 3


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(5)
    rows = []
    for i in range(240):
        label = i % 2
        x = [max(0.0, r.gauss(1 + 2 * (label == j % 2), 1.0)) for j in range(4)]
        rows.append((i, label, i % FOLDS, Vectors.dense(x)))
    df = spark.createDataFrame(rows, ["doc_id", "label", "fold", "features"])
    return df.select("doc_id", F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), "features").coalesce(1).cache()


@pytest.fixture(scope="module")
def searched(table):
    return {s.name: s for s in train.search_all(["LogisticRegression", "NaiveBayes"], table, FOLDS, keep_folds=True)}


def test_the_best_point_is_the_one_refitted(spark, searched):
    for name, s in searched.items():
        grid = train.grid_table(spark, name, s.cv).collect()
        best = train.best_index(s.cv)
        assert len(grid) == len(train.estimator_and_grid(name)[1])
        assert grid[best]["avg_auc"] == max(g["avg_auc"] for g in grid) and s.seconds > 0
        chosen = train.estimator_and_grid(name)[1][best]
        assert all(s.model.getOrDefault(p.name) == v for p, v in chosen.items())
    times = {t["model"]: t["train_time_s"] for t in train.fit_times(spark, list(searched.values())).collect()}
    assert times == {n: s.seconds for n, s in searched.items()}


def test_predictions_are_bounded_and_complete(table, searched):
    for name, s in searched.items():
        rows = train.predictions(s.model, table, name).collect()
        assert sorted(r["row_id"] for r in rows) == list(range(240))
        assert all(0 <= r["score"] <= 1 and r["prediction"] in (0.0, 1.0) and r["model"] == name for r in rows)
        assert sum(r["prediction"] == r["label"] for r in rows) > 190


def test_fold_models_score_what_they_have_not_seen(table, searched):
    s = searched["NaiveBayes"]
    rows = train.fold_predictions("NaiveBayes", s.cv, table, table.limit(10)).collect()
    held = [r for r in rows if r["scope"] == "held_out"]
    assert sorted(r["row_id"] for r in held) == list(range(240))
    assert all(r["row_id"] % FOLDS == r["fold"] for r in held)
    assert len(rows) - len(held) == 10 * FOLDS


def test_saved_models_score_alike(table, searched, tmp_path):
    for name, s in searched.items():
        loaded = train.save_and_load(s.model, name, str(tmp_path / name))
        a, b = train.predictions(s.model, table, name), train.predictions(loaded, table, name)
        assert train.prediction_mismatches(a, b).collect()[0].asDict() == {"model": name, "rows_compared": 240, "mismatches": 0}
        other = b.withColumn("score", F.col("score") + (F.col("row_id") == 3).cast("int"))
        assert train.prediction_mismatches(a, other).collect()[0]["mismatches"] == 1


def test_importances_sum_to_one(spark, table):
    forest = train.fit("RandomForest", table)
    got = importance.importance_table(spark, forest)
    assert got.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert [r["rank"] for r in importance.top_features(got, 3).orderBy("rank").collect()] == [1, 2, 3]
