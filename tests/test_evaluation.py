"""Metrics, ROC, bootstrap and McNemar against published numbers, MLlib and
brute force."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from textgauge.operators import evaluate, importance, reports, roc, significance

# Published confusion cells (TP, FP, FN, TN) and the accuracy,
# F1, precision and recall that belong to them.
PUBLISHED = {
    "LogisticRegression": ((3230, 191, 205, 2974), (0.94, 0.9422, 0.9442, 0.9403)),
    "LinearSVC": ((3231, 186, 204, 2979), (0.9409, 0.9431, 0.9456, 0.9406)),
    "RandomForest": ((3234, 278, 201, 2887), (0.9274, 0.931, 0.9208, 0.9415)),
    "NaiveBayes": ((3198, 225, 237, 2940), (0.93, 0.9326, 0.9343, 0.931)),
}
# Published disagreement counts, statistic and p value.
MCNEMAR = [
    (14, 20, 0.7353, 0.391173, False), (113, 30, 47.021, 0.0, True), (82, 16, 43.1122, 0.0, True),
    (118, 29, 52.6803, 0.0, True), (91, 19, 45.8273, 0.0, True), (57, 74, 1.9542, 0.162135, False),
]


def test_metrics_from_published_cells(spark):
    cells = spark.createDataFrame([(m, *c) for m, (c, _) in PUBLISHED.items()], "model string, TP long, FP long, FN long, TN long")
    for r in evaluate.with_metrics(cells, 4).collect():
        assert (r.accuracy, r.f1_positive, r.precision_positive, r.recall_positive) == PUBLISHED[r.model][1]
        assert r.recall_weighted == r.accuracy


def test_mcnemar_from_published_counts(spark):
    counts = spark.createDataFrame([(b, c) for b, c, *_ in MCNEMAR] + [(0, 0), (5, 5)], "b_correct1_wrong2 long, c_wrong1_correct2 long")
    rows = significance.mcnemar_test(counts).collect()
    for r, (_, _, chi2, p, sig) in zip(rows, MCNEMAR):
        assert (round(r.chi2, 4), round(r.p_value, 6), r.significant_005) == (chi2, p, sig)
    assert (rows[-2].chi2, rows[-2].p_value) == (0.0, 1.0)
    assert rows[-1].chi2 == pytest.approx(0.1)


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        label = int(rng.random() < 0.3)
        for model, noise, grid in (("a", 0.5, 1000), ("b", 2.0, 7)):
            score = round((label + rng.gauss(0, noise)) * grid) / grid
            rows.append((i, model, label, float(score), float(score > 0.5)))
    return spark.createDataFrame(rows, "row_id long, model string, label int, score double, prediction double").persist()


def test_metrics_equal_mllib(scored):
    mine = {r.model: r for r in evaluate.evaluate(scored, ["model"]).collect()}
    for m, row in mine.items():
        one = scored.where(F.col("model") == m)
        for name, value in (("accuracy", row.accuracy), ("f1", row.f1_weighted), ("weightedPrecision", row.precision_weighted), ("weightedRecall", row.recall_weighted)):
            assert MulticlassClassificationEvaluator(metricName=name).evaluate(one) == pytest.approx(value, abs=1e-12)
        auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(one)
        assert auc == pytest.approx(row.auc, abs=1e-12)


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_roc_does_not_depend_on_buckets(scored, bits):
    pdf = scored.where(F.col("model") == "a").toPandas()
    pos, neg = (pdf.label == 1).sum(), (pdf.label == 0).sum()
    got = {r.threshold: (r.fpr, r.tpr) for r in roc.roc_curve(scored, ["model"], bits).where("model = 'a'").collect()}
    assert got.pop(None) == (0.0, 0.0) and len(got) == pdf.score.nunique()
    for t in list(got)[::25]:
        above = pdf[pdf.score >= t]
        assert got[t] == pytest.approx(((above.label == 0).sum() / neg, (above.label == 1).sum() / pos))


def test_tasks_of_a_curve_follow_the_rows(spark, scored, monkeypatch):
    """Frequent scores, both zeros and a score that is missing; more tasks than the session's eight."""
    def points(frame):
        return sorted((r.model, r.score is not None, (r.score or 0) + 0.0, *r[2:]) for r in frame.collect())

    odd = [("c", i % 2, [0.0, -0.0, 1.0, None][i % 4]) for i in range(400)]
    pred = scored.select("model", "label", "score").unionByName(spark.createDataFrame(odd, "model string, label int, score double")).repartition(5)
    want = points(roc.cumulative_counts(pred, ["model"]))
    areas = sorted(roc.area_under_roc(pred, ["model"]).collect())
    monkeypatch.setattr(roc, "ROWS_PER_TASK", 300)
    rows = pred.count()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = roc.cumulative_counts(pred, ["model"], rows=rows)
        assert got.rdd.getNumPartitions() == -(-rows // 300) > 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert points(got) == want
    assert sorted(roc.area_under_roc(pred, ["model"], rows=rows).collect()) == [pytest.approx(a) for a in areas]


def test_one_class_and_all_tied(spark):
    rows = [(1, "one", 1, 0.1, 1.0), (2, "one", 1, 0.2, 0.0), (1, "tie", 1, 0.5, 1.0), (2, "tie", 0, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, model string, label int, score double, prediction double")
    got = {r.model: r.auc for r in roc.area_under_roc(df, ["model"]).collect()}
    assert got == {"one": None, "tie": 0.5}
    assert {r.model: r.precision_weighted for r in evaluate.classification_metrics(df, ["model"]).collect()}["one"] == 1.0


def test_mcnemar_alignment_ignores_row_order(spark, scored):
    flags = significance.align(scored.orderBy(F.rand(1)), ["a", "b"])
    r = significance.mcnemar_counts(flags, ["a", "b"]).first()
    wide = scored.groupBy("row_id", "label").pivot("model", ["a", "b"]).agg(F.first("prediction")).toPandas()
    ok_a, ok_b = wide.a == wide.label, wide.b == wide.label
    assert (r.b_correct1_wrong2, r.c_wrong1_correct2) == ((ok_a & ~ok_b).sum(), (~ok_a & ok_b).sum())


def test_bootstrap_intervals_agree(spark):
    """Both resampling schemes give the published interval of the first model
    within resampling error."""
    tp, fp, fn, tn = PUBLISHED["LogisticRegression"][0]
    kinds = [(1, 1.0, tp), (0, 1.0, fp), (1, 0.0, fn), (0, 0.0, tn)]
    rows = [(i, label, pred) for label, pred, n in kinds for i in range(n)]
    df = spark.createDataFrame([(str(i), *r[1:]) for i, r in enumerate(rows)], "row_id string, label int, p double")
    wide = df.select("row_id", "label", F.struct(F.col("p").alias("score"), F.col("p").alias("prediction")).alias("m"))
    long = df.select("row_id", F.lit("m").alias("model"), "label", F.col("p").alias("score"), F.col("p").alias("prediction"))
    a = significance.interval_report(significance.multinomial_replicates(long, 1000)).first()
    b = significance.interval_report(significance.poisson_replicates(wide, ["m"], 400)).first()
    for r in (a, b):
        assert r.f1_mean == pytest.approx(0.9421, abs=0.001)
        assert r.f1_ci_lower == pytest.approx(0.9362, abs=0.002)
        assert r.f1_ci_upper == pytest.approx(0.9476, abs=0.002)
    again = significance.interval_report(significance.multinomial_replicates(long.repartition(5), 1000)).first()
    assert again == a


def test_grid_tie_and_stability(spark):
    g = spark.createDataFrame([("m", 0, 0.5), ("m", 1, 0.7), ("m", 2, 0.7)], "model string, grid_index int, f double")
    assert evaluate.best_of_grid(g, "f").first().grid_index == 1
    s = spark.createDataFrame([(0.001,), (0.01,), (0.04,), (0.05,)], ["s"])
    assert [r[0].split(" (")[0] for r in s.select(evaluate.stability(F.col("s"))).collect()] == ["Very Stable", "Stable", "Moderately Stable", "Unstable"]


def test_scaling_and_stack(spark):
    log = spark.createDataFrame([("strong_scaling", "p", 1, 0.25, 8.0), ("strong_scaling", "p", 2, 0.5, 5.0), ("weak_scaling", "w", 2, 0.5, 3.0)],
                                "experiment string, profile string, executors int, data_fraction double, train_time_s double")
    rows = {(r.profile, r.executors): r for r in reports.scaling_report(log).collect()}
    assert rows["p", 2].speedup == 1.6 and rows["p", 2].efficiency == 0.8 and rows["w", 2].speedup is None
    assert rows["p", 2].cost_usd == pytest.approx(5 / 60 * 2 * 0.10)
    assert {r.variable for r in reports.scaling_combined(log).collect()} == {"1 cores", "2 cores", "50% data"}
    both = reports.stack({"validation": log.select("profile", "executors"), "test": log.select("profile")}, "split")
    assert both.where("split = 'test' and executors is null").count() == 3


def test_words_of_top_features(spark):
    imp = spark.createDataFrame([(1024 + 1, 0.5), (3, 0.2), (2000, 0.2)], "feature_index int, importance double")
    top = importance.top_features(imp, 3)
    vocab = spark.createDataFrame([("share",), ("truth",)], ["word"])
    rows = {r["rank"]: r for r in importance.with_words(top, vocab, 1024).collect()}
    assert rows[1].words == "word_count" and rows[2].feature_index == 3
    assert rows[3].words == "--" and rows[3].feature_label == "hash_2000"
