"""Curves of bounded size against exact ones."""

import random

from pyspark.sql import functions as F

from textgauge.operators import roc

SCHEMA = "model string, label int, score double"


def rows(seed=3):
    r, out = random.Random(seed), []
    for _ in range(6000):
        label = int(r.random() < 0.3)
        out.append(("fine", label, r.gauss(0.8 * label, 1)))
        out.append(("tied", label, float(r.randrange(4) + label)))
        out.append(("negative", label, -1e-7 * r.randrange(1, 1000) - label))
    return out


def test_rates_and_areas_stay_within_the_bound(spark):
    pred = spark.createDataFrame(rows(), SCHEMA).repartition(7)
    curve = roc.bounded_roc_curve(pred, ["model"]).cache()
    found = {r.model: r for r in roc.curve_deviation(pred, curve, ["model"]).collect()}
    assert set(found) == {"fine", "tied", "negative"}
    for r in found.values():
        assert r.points <= roc.POINTS and r.off <= 2 * roc.sketch_error() and abs(r.area - r.exact_area) <= 2 * roc.sketch_error()
    # Few distinct scores are all there: the curve is the exact one but for the sketch's ranks.
    exact = {r.threshold for r in roc.roc_curve(pred.where("model = 'tied'"), ["model"]).collect()}
    assert {r.threshold for r in curve.where("model = 'tied'").collect()} == exact
    ends = curve.groupBy("model").agg(F.min("fpr").alias("a"), F.max("fpr").alias("b"), F.min("tpr").alias("c"), F.max("tpr").alias("d")).collect()
    assert all((e.a, e.b, e.c, e.d) == (0, 1, 0, 1) for e in ends)


def test_small_tables(spark):
    few = [("m", 1, 0.9), ("m", 0, 0.9), ("m", 1, 0.5), ("m", 0, 0.1), ("m", None, 0.3), ("m", 1, None), ("one class", 1, 0.2), ("one class", 1, 0.4)]
    pred = spark.createDataFrame(few, SCHEMA)
    known = pred.where("score is not null and label is not null")
    got = roc.bounded_roc_curve(pred, ["model"])
    want = roc.roc_curve(known.where("model = 'm'"), ["model"])

    def key(frame):
        return sorted((r.threshold is not None, r.threshold or 0, round(r.fpr, 2), round(r.tpr, 2)) for r in frame.collect())

    assert key(got) == key(want)  # to a rank
    assert roc.bounded_roc_curve(spark.createDataFrame([], SCHEMA), ["model"]).collect() == []
