"""Forests in shared passes against MLlib and against a plain count."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textgauge.operators import forest, grid_search, model_tables, roc, search

FOLDS = 3
SETTINGS = forest.Settings(depth=5, bins=32, seed=7)


@pytest.fixture(scope="module")
def table(spark):
    r, rows = random.Random(3), []
    for i in range(1200):
        label = i % 2
        x = [max(0.0, r.gauss(0.5 + 0.5 * label * (j < 4), 1.0)) * (r.random() < 0.5) for j in range(24)] + [r.gauss(-label, 2.0), 3.0]
        at = [j for j, v in enumerate(x) if v]
        vector = Vectors.dense(x) if i % 5 == 0 else Vectors.sparse(26, at, [x[j] for j in at])
        rows.append((i, label if r.random() < 0.9 else 1 - label, i // 2 % FOLDS, vector))
    df = spark.createDataFrame(rows, ["doc_id", "label", "fold", "features"])
    return df.select("doc_id", F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), "features").repartition(5).cache()


def grown(table, points, settings=SETTINGS):
    blocks = grid_search.feature_blocks(table)
    cuts = forest.candidate_splits(blocks, 26, settings)
    columns = forest.by_feature(blocks, cuts).cache()
    return forest.grow(columns, cuts, points, settings), cuts, columns


def plain(trees):
    return [(t.point, t.number, t.feature, t.bin, t.left, t.rows) for t in trees]


POINTS = [(grid_search.Point("RandomForest", 0, f), 20) for f in (*range(FOLDS), -1)]


@pytest.fixture(scope="module")
def found(table):
    return grown(table, POINTS)


def test_layout_does_not_change_a_forest(table, found):
    assert plain(grown(table.repartition(2), POINTS)[0]) == plain(found[0])


def test_rows_and_splits_are_those_of_a_plain_count(table, found):
    trees, cuts, _ = found
    rows = table.collect()
    x, y, fold = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows]), np.array([r.fold for r in rows])
    for t in trees[::7]:
        # Weights come from the root; the children of every split are counted again.
        assert sum(t.rows[0]) == pytest.approx((fold != t.point.fold).sum(), rel=0.2)
        for node, left in enumerate(t.left):
            if left >= 0:
                assert np.add(t.rows[left], t.rows[left + 1]) == pytest.approx(t.rows[node]) and t.gain[node] > 0
    # One tree that asks every feature and whose only split is the best one of all.
    one, cuts, _ = grown(table, [(grid_search.Point("RandomForest", 0, -1), 1)], forest.Settings(1, 32, 7))
    tree = one[0]
    h = []
    for b, ends in forest._read(grid_search.feature_blocks(table.coalesce(1)).toArrow().to_batches()):
        h.append((forest._row_hashes(b, ends), b.y))
    weight = np.searchsorted(forest.POISSON, forest._uniform(np.concatenate([k for k, _ in h]), 7, 0), side="right")
    y = np.concatenate([v for _, v in h])
    x = np.array([r.features.toArray() for r in table.coalesce(1).collect()])

    def gini(some):
        n = weight[some].sum()
        p = weight[some & (y > 0.5)].sum()
        return 2 * p * (n - p) / n if n else 0.0

    every = np.ones(len(y), bool)
    gains = {(f, k): gini(every) - gini(x[:, f] <= c) - gini(x[:, f] > c) for f in range(26) for k, c in enumerate(cuts[f]) if np.isfinite(c)}
    assert gains[tree.feature[0], tree.bin[0]] == pytest.approx(max(gains.values()))
    assert tree.gain[0] * weight.sum() == pytest.approx(max(gains.values()))
    below = x[:, tree.feature[0]] <= cuts[tree.feature[0], tree.bin[0]]
    assert tree.rows[1] == (weight[below & (y < 0.5)].sum(), weight[below & (y > 0.5)].sum())


def test_candidate_splits_are_midpoints_or_quantiles():
    assert forest.cuts_of(np.array([0.0, 1.0, 3.0]), np.array([5.0, 1, 1]), 31).tolist() == [0.5, 2.0]
    many = forest.cuts_of(np.arange(1000.0), np.ones(1000), 31)
    assert len(many) == 31 and np.allclose(np.diff(many), 31.25, atol=1)


def test_forest_is_as_good_as_that_of_mllib(table, found):
    trees, cuts, columns = found
    areas = {r.fold: r.auc for r in roc.area_under_roc(forest.held_out_scores(columns, cuts, trees, "RandomForest"), ["fold"]).collect()}
    assert sorted(areas) == [0, 1, 2]
    theirs = []
    for k in range(FOLDS):
        model = RandomForestClassifier(numTrees=20, maxDepth=5, seed=7).fit(table.where(F.col("fold") != k))
        theirs.append(BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(table.where(F.col("fold") == k))))
    assert abs(np.mean(list(areas.values())) - np.mean(theirs)) < 0.02


def test_tables_score_as_the_blocks_do(spark, table, found):
    trees, cuts, columns = found
    models = model_tables.from_trees(spark, "RandomForest", trees, cuts)
    scored = model_tables.predictions(models, table, keep=["fold"]).collect()
    assert len(scored) == 1200 * 4
    held = forest.held_out_scores(columns, cuts, trees, "RandomForest").collect()
    wide = model_tables.predictions(models, table.withColumnRenamed("fold", "own"), keep=["own"], folds=True)
    want = [(r.fold, r.label, round(r.score, 9)) for r in wide.where("fold = own").collect()]
    assert sorted(want) == sorted((r.fold, r.label, round(r.score, 9)) for r in held)


def test_importances_sum_to_one_and_name_the_features_that_tell(found):
    got = forest.importances(found[0])
    assert sum(got.values()) == pytest.approx(1.0)
    assert 25 not in got  # never changes
    tell = {0, 1, 2, 3, 24}
    assert np.mean([got.get(f, 0) for f in tell]) > 1.2 * np.mean([got.get(f, 0) for f in range(25) if f not in tell])


def test_no_rows_lie_dense_between_the_passes(table):
    """A row takes as much as it has entries, however many features there are."""
    wide = table.select("label", "fold", F.col("features"))
    blocks = grid_search.feature_blocks(wide)
    cuts = np.vstack([forest.candidate_splits(blocks, 26, SETTINGS), np.full((1 << 14, 31), np.inf)])
    rows = forest.by_feature(blocks, cuts).select(F.sum(F.length("row") / 2).alias("n"), F.sum(F.length("bin")).alias("b")).first()
    entries = blocks.select(F.sum(F.length("i") / 4)).first()[0]
    assert rows.n == rows.b == entries


def test_search_of_an_empty_table(table):
    with pytest.raises(ValueError):
        search.search_forests(table.where("false"), FOLDS)
