"""Feature importances and what the hashed features mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import STAT_COLUMNS
from .features import NUM_FEATURES, word_buckets
from .terms import words_per_bucket

TOP_K = 20
LABEL_WIDTH = 30


def importance_table(spark, model) -> DataFrame:
    """``(feature_index, importance)`` of a tree ensemble.  The vector lives
    on the driver with the model; its length is the feature count."""
    v = model.featureImportances
    rows = [(int(i), float(x)) for i, x in zip(v.indices, v.values)]
    return spark.createDataFrame(rows, "feature_index int, importance double")


def importances_of(spark, values: dict[int, float]) -> DataFrame:
    """``(feature_index, importance)`` of ``forest.importances``; as long as the
    features that some tree splits by."""
    return spark.createDataFrame(sorted(values.items()), "feature_index int, importance double")


def top_features(importances: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k largest with rank; ties by index."""
    best = importances.orderBy(F.desc("importance"), "feature_index").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "feature_index"))
    return best.withColumn("rank", rank)


def with_words(top: DataFrame, vocabulary: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Explain the top features: a statistic's name, else up to three words of
    the bucket, else ``--`` (labelled ``hash_<index>``).

    The vocabulary is filtered to the top buckets by a semi-join with the k
    top rows before any grouping.
    """
    spark = top.sparkSession
    names = spark.createDataFrame(
        [(num_features + i, c) for i, c in enumerate(STAT_COLUMNS)], "feature_index int, statistic string")
    wanted = top.select(F.col("feature_index").alias("bucket"))  # k rows
    hashed = word_buckets(vocabulary.select("word"), num_features).join(F.broadcast(wanted), "bucket", "left_semi")
    words = words_per_bucket(hashed).withColumnRenamed("bucket", "feature_index")
    named = top.join(F.broadcast(names), "feature_index", "left").join(words, "feature_index", "left")
    text = F.coalesce("statistic", "words", F.lit("--"))
    label = F.when(text == "--", F.concat(F.lit("hash_"), F.col("feature_index").cast("string"))).otherwise(F.substring(text, 1, LABEL_WIDTH))
    return named.select("feature_index", "importance", "rank", text.alias("words"), label.alias("feature_label"))
