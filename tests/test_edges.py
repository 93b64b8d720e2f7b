"""Rows that must not vanish: odd characters, unknown classes, missing values."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textgauge.operators import evaluate, perturb, ranking, splits


def test_noise_keeps_control_characters(spark):
    df = spark.createDataFrame([(i, "A\u0001b. C. D.") for i in range(50)], "doc_id long, text string")
    out = perturb.insert_noise(df, rate=1.0).collect()
    assert all("A\u0001b." in r["text"] and len(r["text"]) > 20 for r in out)


def test_missing_predictions_and_labels_fail(spark):
    schema = "model string, label int, score double, prediction double"
    for row in (("m", None, 0.5, 1.0), ("m", 1, 0.5, None)):
        bad = spark.createDataFrame([("m", 1, 0.5, 1.0), row], schema)
        with pytest.raises(PySparkException):
            evaluate.confusion(bad, ["model"]).collect()


def test_unknown_classes_fail_an_exact_split(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(20, 7)], "doc_id long, label int")
    with pytest.raises(PySparkException):
        splits.stratified_split_exact(df).collect()


def test_counted_predictions_give_the_same_metrics(spark):
    df = spark.range(300).select(F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 7 / 7).alias("score"),
                                 (F.col("id") % 3 == 0).cast("double").alias("prediction"))
    once = evaluate.counted(df, ["model"])
    assert once.count() < 50
    assert evaluate.classification_metrics(once, ["model"]).collect() == evaluate.classification_metrics(df, ["model"]).collect()


def test_bucket_bits_follow_the_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20000")
        assert 1 << ranking.bucket_bits(spark) >= 80000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
