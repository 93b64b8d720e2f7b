"""Searches in shared passes against MLlib and the optimum conditions; models
as tables against ``transform``."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textgauge.operators import grid_search, model_tables, search, train

FOLDS = 3
EXACT = grid_search.Settings(tolerance=1e-8, steps=400)


@pytest.fixture(scope="module")
def table(spark):
    """Sparse and dense rows; a constant feature and one that is rare."""
    r, rows = random.Random(5), []
    for i in range(300):
        label = i % 2
        x = [max(0.0, r.gauss(1 + 1.2 * (label == j % 2), 1.0)) * (r.random() < 0.6) for j in range(12)] + [3.0, float(i == 7)]
        at = [j for j, v in enumerate(x) if v]
        vector = Vectors.dense(x) if i % 5 == 0 else Vectors.sparse(14, at, [x[j] for j in at])
        rows.append((i, label if r.random() < 0.9 else 1 - label, i // 2 % FOLDS, vector))
    df = spark.createDataFrame(rows, ["doc_id", "label", "fold", "features"])
    return df.select("doc_id", F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), "features").repartition(3).cache()


@pytest.fixture(scope="module")
def blocks(table):
    return grid_search.held(grid_search.feature_blocks(table))


@pytest.fixture(scope="module")
def fitted(blocks):
    found = grid_search.moments(blocks, 14, FOLDS)
    grids = {n: search.grid_points(n) for n in ("LogisticRegression", "LinearSVC")}
    fits, passes = grid_search.fit_linear(blocks, 14, grids, [*range(FOLDS), -1], found, EXACT)
    assert passes < 1000
    fits += grid_search.fit_naive_bayes(14, search.grid_points("NaiveBayes"), [*range(FOLDS), -1], found)
    return {f.point: f for f in fits}


def test_every_point_is_fitted_once(fitted):
    want = {(n, g, f) for n, g_n in (("LogisticRegression", 4), ("LinearSVC", 2), ("NaiveBayes", 2)) for g in range(g_n) for f in (-1, 0, 1, 2)}
    assert {(p.model, p.grid_index, p.fold) for p in fitted} == want


def test_logistic_regression_is_that_of_mllib(table, fitted):
    for i, point in enumerate(search.grid_points("LogisticRegression")):
        for fold in (-1, 1):
            model = LogisticRegression(maxIter=500, tol=1e-12, **point).fit(table.where(F.col("fold") != fold))
            f = fitted[grid_search.Point("LogisticRegression", i, fold)]
            assert f.violation < 1e-6
            np.testing.assert_allclose(f.weights, model.coefficients.toArray(), atol=2e-4)
            assert f.intercept == pytest.approx(model.intercept, abs=2e-3)


def arrays(table):
    rows = table.orderBy("doc_id").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])


def test_optimum_conditions_of_the_l1_path(table, fitted):
    x, y = arrays(table)
    scale = x.std(0, ddof=1)
    for i, point in enumerate(search.grid_points("LogisticRegression")):
        l1, l2 = point["regParam"] * point["elasticNetParam"], point["regParam"] * (1 - point["elasticNetParam"])
        f = fitted[grid_search.Point("LogisticRegression", i, -1)]
        p = 1 / (1 + np.exp(-(x @ f.weights + f.intercept)))
        live = scale > 0
        g, w = ((p - y) @ x / len(y))[live] / scale[live], f.weights[live] * scale[live]
        assert abs((p - y).mean()) < 1e-6 and not f.weights[~live].any()
        off = np.where(w != 0, np.abs(g + l2 * w + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0))
        assert off.max() < 1e-6


def test_screening_and_small_working_sets_change_nothing(blocks, fitted):
    found = grid_search.moments(blocks, 14, FOLDS)
    tight = grid_search.Settings(tolerance=1e-8, steps=2000, working=2)
    fits, _ = grid_search.fit_linear(blocks, 14, {"LogisticRegression": search.grid_points("LogisticRegression")}, [-1], found, tight)
    for f in fits:
        np.testing.assert_allclose(f.weights, fitted[f.point].weights, atol=1e-5)


def test_linear_svm_reaches_the_objective_of_mllib(table, fitted):
    x, y = arrays(table)
    sign, scale = 2.0 * y - 1, x.std(0, ddof=1)
    for i, point in enumerate(search.grid_points("LinearSVC")):
        model = LinearSVC(maxIter=400, tol=1e-10, **point).fit(table)
        f = fitted[grid_search.Point("LinearSVC", i, -1)]

        def objective(w, b):
            return np.maximum(0, 1 - sign * (x @ w + b)).mean() + point["regParam"] / 2 * ((w * scale) ** 2).sum()

        theirs = objective(model.coefficients.toArray(), model.intercept)
        assert objective(f.weights, f.intercept) <= theirs + 0.01
        ours = x @ f.weights + f.intercept
        assert np.corrcoef(ours, x @ model.coefficients.toArray())[0, 1] > 0.995


def test_naive_bayes_is_that_of_mllib(table, fitted):
    for i, point in enumerate(search.grid_points("NaiveBayes")):
        model = NaiveBayes(modelType="multinomial", **point).fit(table.where("fold != 2"))
        f = fitted[grid_search.Point("NaiveBayes", i, 2)]
        np.testing.assert_allclose(f.weights, model.theta.toArray()[1] - model.theta.toArray()[0], atol=1e-10)
        assert f.intercept == pytest.approx(model.pi.toArray()[1] - model.pi.toArray()[0], abs=1e-10)


@pytest.mark.parametrize("name", train.MODEL_NAMES)
def test_tables_score_as_transform_does(spark, table, tmp_path, name):
    makers = {"LogisticRegression": LogisticRegression(regParam=0.01, elasticNetParam=0.5), "LinearSVC": LinearSVC(regParam=0.1, maxIter=20),
              "RandomForest": RandomForestClassifier(numTrees=7, maxDepth=5, seed=3), "NaiveBayes": NaiveBayes()}
    model = makers[name].fit(table)
    tables = model_tables.from_forest(spark, name, model, str(tmp_path / "f")) if name == "RandomForest" else model_tables.from_linear(spark, name, model)
    assert model_tables.save(tables, str(tmp_path / "v")) == 1
    assert model_tables.save(model_tables.load(spark, str(tmp_path / "v")), str(tmp_path / "v")) == 2
    assert model_tables.versions(spark, str(tmp_path / "v")) == [1, 2]
    want = {r.row_id: r for r in train.predictions(model, table, name).collect()}
    for version in (1, 2):
        got = model_tables.predictions(model_tables.load(spark, str(tmp_path / "v"), version), table).collect()
        assert len(got) == 300
        for r in got:
            assert r.score == pytest.approx(want[r.row_id].score, abs=1e-12) and r.prediction == want[r.row_id].prediction and r.label == want[r.row_id].label


def test_a_search_is_written_and_read(spark, table, tmp_path):
    found = search.union([search.searched(table, n, FOLDS, str(tmp_path / n)) for n in ("NaiveBayes", "LogisticRegression", "RandomForest")])
    grid = found.grid.collect()
    assert len(grid) == 2 + 4 + 1
    for name in ("NaiveBayes", "LogisticRegression"):
        cv = train.cross_validate(name, table, FOLDS)
        mine = {r.grid_index: r for r in grid if r.model == name}
        for i, (mean, std) in enumerate(zip(cv.avgMetrics, cv.stdMetrics)):
            assert mine[i].avg_auc == pytest.approx(mean, abs=1e-3) and mine[i].std_auc == pytest.approx(std, abs=2e-3)
    scored = search.fold_predictions(found, table, table.limit(10), FOLDS).collect()
    held = [r for r in scored if r.scope == "held_out" and r.model == "LogisticRegression"]
    folds = {r.doc_id: r.fold for r in table.collect()}
    assert sorted(r.row_id for r in held) == list(range(300)) and all(folds[r.row_id] == r.fold for r in held)
    assert len([r for r in scored if r.scope == "validation"]) == 10 * FOLDS * 3
    assert {r.model for r in found.times.collect()} == {"NaiveBayes", "LogisticRegression", "RandomForest"}


def test_rows_without_label_and_empty_tables(spark, table):
    none = table.withColumn("label", F.lit(None).cast("int"))
    assert grid_search.feature_blocks(none).count() == 0
    with pytest.raises(ValueError):
        search.search(none, ["LogisticRegression"], FOLDS)
    mixed = table.unionByName(none.limit(20))
    assert grid_search.feature_blocks(mixed).count() == grid_search.feature_blocks(table).count()


def test_features_far_from_zero_do_not_hold_up_a_search(spark, monkeypatch):
    """Features whose mean is many deviations pull the free intercept along;
    the default number of steps still comes near the optimum.  Passes are
    answered in this process."""
    r = np.random.default_rng(8)
    y = np.arange(400) % 2
    x = r.normal(size=(400, 12)) * 4 + np.where(np.arange(12) < 6, 500, 0) + 3 * (y[:, None] == np.arange(12) % 2)
    sign, scale = 2.0 * y - 1, x.std(0, ddof=1)

    def answers(blocks, asks, size):
        for _, a in asks:
            z = x @ a.weights + a.intercept
            short, p = 1 - sign * z, 1 / (1 + np.exp(-z))
            if a.width:
                slope = np.clip(short / a.width, 0, 1)
                loss, d = np.where(short < a.width, slope * short / 2, short - a.width / 2), -sign * slope
            else:
                loss, d = np.logaddexp(0, -sign * z), p - y
            xs = None if a.working is None else np.column_stack([x[:, a.working], np.ones(len(x))])
            yield grid_search.Values(loss.sum(), d @ x, d.sum(), None if xs is None else xs.T @ (xs * (p * (1 - p))[:, None]))

    monkeypatch.setattr(grid_search, "_answers", answers)
    rows, sums = np.array([[200.0, 200.0]]), np.stack([x[y == 0].sum(0), x[y == 1].sum(0)])[None]
    found = grid_search.Moments(rows, sums, (x * x).sum(0)[None], [0])
    # The paths without an L1 part.
    grids = {n: [p for p in search.grid_points(n) if not p.get("elasticNetParam")] for n in ("LogisticRegression", "LinearSVC")}

    def objectives(settings):
        out = {}
        for f in grid_search.fit_linear(None, 12, grids, [-1], found, settings)[0]:
            point, z, w = grids[f.point.model][f.point.grid_index], x @ f.weights + f.intercept, f.weights * scale
            loss = np.maximum(0, 1 - sign * z) if f.point.model == "LinearSVC" else np.logaddexp(0, -sign * z)
            out[f.point] = loss.mean() + point["regParam"] / 2 * w @ w
        return out

    few, many = objectives(grid_search.Settings()), objectives(grid_search.Settings(tolerance=1e-9, loose=1e-9, steps=3000))
    assert len(few) == 4
    for point, value in few.items():
        assert value <= many[point] + 1e-3, (point, value, many[point])


def test_blocks_of_a_pass_are_short_and_few(spark):
    """Repeated values are put down once, rows without entries keep their
    place, and the tasks of a pass follow the cores."""
    rows = [(i % 2, i % FOLDS, Vectors.sparse(100_000, {} if i % 7 == 0 else {j: 0.1 + (i * j) % 5 for j in range(i % 3, 90, 3)})) for i in range(600)]
    df = spark.createDataFrame(rows, ["label", "fold", "features"]).repartition(200)
    whole = grid_search.held(grid_search.feature_blocks(df, most=1 << 10))
    live = grid_search.moments(whole, 100_000, FOLDS).live()
    blocks = grid_search.gathered(grid_search.compacted(whole, live, 100_000))
    assert blocks.rdd.getNumPartitions() == 25
    packed = [sum(len(b[c]) for b in df.collect() for c in ("i", "x", "places") if c in df.columns) for df in (whole, blocks)]
    assert 2 * packed[1] < packed[0]
    weights = np.random.default_rng(2).normal(size=(3, len(live)))
    wide = np.zeros((3, 100_000))
    wide[:, live] = weights

    def sums(blocks, weights):
        def run(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    b = grid_search.Block(batch, r)
                    out = np.zeros(weights.shape)
                    z = b.margins(weights, np.ones(3))
                    b.add_transposed(np.where(z > 0, z, 0), out)
                    yield pa.RecordBatch.from_pydict({"z": [float((z * [1, 2, 3]).sum())], "g": [float((out * weights).sum())], "n": [len(z)]})
        return blocks.mapInArrow(run, "z double, g double, n long").groupBy().sum().first()

    np.testing.assert_allclose(sums(blocks, weights), sums(whole, wide), rtol=1e-9)
    assert sums(blocks, weights)[2] == 600
