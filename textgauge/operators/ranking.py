"""Exact ranks and exact-count selections without a one-task sort.

A ``row_number()`` over a class label would sort a whole class in one task.
Rows are ordered by a uniform hash, so the leading hash bits split every
group into equally full buckets; ranks are found inside the buckets and moved
by the number of rows in the buckets before them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, hash32

# Buckets per shuffle partition, so that a task gets several small ones.
BUCKETS_PER_PARTITION = 4


def bucket_bits(spark: SparkSession) -> int:
    """Bits of the bucket number: results do not depend on it, the size of a
    bucket does, so it follows the session's shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4, (BUCKETS_PER_PARTITION * partitions - 1).bit_length())


def _bucket(hash_col: str, bits: int) -> Column:
    return F.shiftright(F.col(hash_col), HASH_BITS - bits)


def grouped_rank(df: DataFrame, group: list[str], seed, id_col: str = "doc_id", bits: int | None = None,
                 rank_col: str = "rank", count_col: str | None = None) -> DataFrame:
    """Append the 1-based rank of each row by ``(hash, id)`` within ``group``
    (and optionally the group's row count)."""
    bits = bucket_bits(df.sparkSession) if bits is None else bits
    keyed = df.withColumn("_h", hash32(seed, id_col)).withColumn("_b", _bucket("_h", bits))
    by_bucket = [*group, "_b"]
    totals = keyed.groupBy(*by_bucket).agg(F.count("*").alias("_n"))
    # At most 2**bits rows per group reach these windows.
    over_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = over_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by_bucket,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(over_group).alias("_total"),
    )
    inside = Window.partitionBy(*by_bucket).orderBy("_h", id_col)
    ranked = keyed.withColumn("_r", F.row_number().over(inside)).join(offsets, by_bucket)
    out = ranked.withColumn(rank_col, F.col("_before") + F.col("_r"))
    if count_col:
        out = out.withColumnRenamed("_total", count_col)
    return out.drop("_h", "_b", "_r", "_before", "_total")


def exact_cuts(df: DataFrame, group: str, classes, seed, targets: dict[str, Callable[[Column], Column]],
               id_col: str = "doc_id", bits: int | None = None) -> DataFrame:
    """One row per class with, for each target, the ``(hash, id)`` of the
    class's k-th row, where ``k = target(class size)``.

    Only the buckets holding a cut are ranked, about one row in ``2**bits``.
    The result has ``len(classes)`` rows, small enough to broadcast.
    """
    bits = bucket_bits(df.sparkSession) if bits is None else bits
    keyed = (
        df.where(F.col(group).isin(list(classes)))
        .select(group, id_col, hash32(seed, id_col).alias("_h"))
        .withColumn("_b", _bucket("_h", bits))
    )
    over_group = Window.partitionBy(group)
    running = over_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = keyed.groupBy(group, "_b").agg(F.count("*").alias("_n")).select(
        group, "_b", "_n",
        F.sum("_n").over(running).alias("_cum"),
        F.sum("_n").over(over_group).alias("_total"),
    )
    wanted = F.array(*[F.struct(F.lit(name).alias("_target"), k(F.col("_total")).cast("bigint").alias("_k"))
                       for name, k in targets.items()])
    cut_buckets = (
        cum.select(group, "_b", (F.col("_cum") - F.col("_n")).alias("_before"), "_cum", F.inline(wanted))
        .where((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_cum")))
        .select(group, "_b", "_target", (F.col("_k") - F.col("_before")).alias("_need"))
    )
    # len(classes) * len(targets) rows at most, whatever the data.
    inside = Window.partitionBy(group, "_b", "_target").orderBy("_h", id_col)
    hits = (
        keyed.join(F.broadcast(cut_buckets), [group, "_b"])
        .withColumn("_r", F.row_number().over(inside))
        .where(F.col("_r") == F.col("_need"))
    )
    return hits.groupBy(group).agg(*[
        F.max(F.when(F.col("_target") == name, F.struct("_h", id_col))).alias(f"_cut_{name}") for name in targets
    ])


def with_exact_cuts(df: DataFrame, group: str, classes, seed, targets, id_col: str = "doc_id",
                    bits: int | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """Attach the cuts and return, per target, the condition "this row is
    among the first k of its class".  The table itself is not shuffled."""
    cuts = exact_cuts(df, group, classes, seed, targets, id_col, bits)
    joined = df.join(F.broadcast(cuts), group, "left")
    position = F.struct(hash32(seed, id_col).alias("_h"), F.col(id_col).alias(id_col))
    conditions = {name: F.coalesce(position <= F.col(f"_cut_{name}"), F.lit(False)) for name in targets}
    return joined, conditions
