"""Parquet and CSV sinks with the matching readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def write_partitioned(df: DataFrame, path: str, key: str) -> None:
    """Overwrite a table laid out by ``key``.

    The rebalance hint co-locates rows of one key like a repartition would,
    but lets adaptive execution split a key too large for one writer task.
    """
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", balance: bool = False) -> None:
    """All splits in one job, one directory per split.

    Each task writes its rows to the split directories directly.  With
    ``balance`` the rows are shuffled first, so that adaptive execution sizes
    the files by bytes: a table that is read again many times, by every step
    of an optimiser, should have few files when it is small.
    """
    out = df.hint("rebalance") if balance else df
    out.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split_col) == name).drop(split_col)


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """CSV with a header; ``by`` gives one directory per value.  Quotes are
    doubled and line breaks kept, so any text survives the round trip."""
    w = df.write.mode("overwrite").options(header="true", quote='"', escape='"', quoteAll="true")
    (w.partitionBy(by) if by else w).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file.  For aggregated report tables (a row per model, class or
    stage): the aggregation itself stays parallel, only its rows meet in one
    task.  Tables that grow with the data go through ``write_csv``."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def partition_sizes(df: DataFrame, n: int) -> DataFrame:
    """Rows per partition after spreading ``df`` over ``n`` partitions."""
    return (
        df.repartition(n)
        .groupBy(F.spark_partition_id().alias("partition_id"))
        .agg(F.count("*").alias("rows"))
    )
