"""Metrics taken while writing."""

import pytest
from pyspark.sql import functions as F

from textgauge.operators import quality
from textgauge.sources.observed import Observed

LONG = "A sentence that is long enough to be kept by the rule for short texts, with some more words behind it to be sure. "


def test_the_funnel_is_counted_by_the_write(spark, tmp_path):
    rows = [(0, LONG), (1, LONG), (2, None), (3, "short"), (4, LONG + "b"), (5, "1234567890 " * 20), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "in"))
    watch = Observed()
    cleaned = quality.cleaned_and_counted(spark.read.parquet(str(tmp_path / "in")), watch)
    with pytest.raises(RuntimeError):
        watch.metrics()
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1, plan
    watch.write(cleaned, str(tmp_path / "out"))
    assert [(n, m["rows"]) for n, m in watch.metrics()] == [("raw", 7), ("text_present", 6), ("long_enough", 4), ("distinct_text", 3), ("cleaned", 2)]
    assert [tuple(r) for r in watch.funnel(spark).where("step = 5").collect()] == [(5, "cleaned", 2)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_metrics_of_an_empty_table(spark, tmp_path):
    watch = Observed()
    none = spark.createDataFrame([], "label int, split string")
    watch.write(watch.at(none, "empty", ones=F.count_if(F.col("label") == 1)), str(tmp_path / "out"), by="split")
    assert watch.metrics() == [("empty", {"rows": 0, "ones": 0})]
