"""Readers for the input tables and the views every query starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = (0, 1)
LABEL_NAMES = {0: "Reliable", 1: "Unreliable"}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan, restricted to ``columns`` so that only those are read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark, sf_dir, columns=("doc_id", "text", "lang", "source")) -> DataFrame:
    return table(spark, sf_dir, "documents", list(columns))


def texts(spark, sf_dir, columns=("doc_id", "text")) -> DataFrame:
    """Documents for text work, split as the session's file settings say."""
    return documents(spark, sf_dir, columns)


def labels(spark, sf_dir, label_col: str = "quality") -> DataFrame:
    """``(doc_id, label)`` of the external label table."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col(label_col).alias("label"))


def labelled_documents(spark, sf_dir, columns=("doc_id", "text", "lang", "source"), label_col="quality") -> DataFrame:
    """Inner equi-join of documents and labels on the unique ``doc_id``.

    No broadcast hint: both sides grow together, so the choice between a
    broadcast and a shuffle join is left to the sizes Spark sees.
    """
    return documents(spark, sf_dir, columns).join(labels(spark, sf_dir, label_col), "doc_id")


def articles(spark, sf_dir, label_col="quality") -> DataFrame:
    """Labelled documents in the article layout."""
    return as_articles(labelled_documents(spark, sf_dir, label_col=label_col))


def as_articles(labelled: DataFrame) -> DataFrame:
    return labelled.select(
        "doc_id",
        F.lit(None).cast("string").alias("title"),
        "text",
        F.col("lang").alias("subject"),
        F.lit(None).cast("string").alias("date"),
        "source",
        F.col("label").cast("int").alias("label"),
    )


def raw_articles(spark, sf_dir, label_col="quality") -> DataFrame:
    """All documents in the article layout with the gaps raw data has:
    missing subjects (``es``), blank sources (``src3``), missing labels."""
    d = documents(spark, sf_dir).join(labels(spark, sf_dir, label_col), "doc_id", "left")
    return d.select(
        "doc_id",
        F.lit(None).cast("string").alias("title"),
        "text",
        F.nullif(F.col("lang"), F.lit("es")).alias("subject"),
        F.lit(None).cast("string").alias("date"),
        F.when(F.col("source") == "src3", F.lit("  ")).otherwise(F.col("source")).alias("source"),
        F.col("label").cast("int").alias("label"),
    )
