"""Exact ROC curves and areas, without sorting a model's scores in one task.

1. Count positives and negatives per distinct score (map-side combine).
2. Pick splitters: the scores with the smallest hashes, a uniform sample of
   the distinct scores.  It is a function of the data, so recomputing it
   after a lost executor gives the same buckets.
3. Sum each bucket, prefix-sum the few bucket totals, and run the cumulative
   window inside the buckets only.

The number of buckets follows the session's shuffle partitions and, where the
caller knows it, the number of rows; results do not depend on it.  A table of
more rows than its session's tasks should hold is shuffled before it is grouped:
what a task groups is bounded by ``ROWS_PER_TASK``, on either side of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ranking import BUCKETS_PER_PARTITION, bucket_bits

WEIGHT = "rows"
# Rows that a task groups and puts in order; each takes it some 300 bytes.
ROWS_PER_TASK = 1 << 20


def tasks_for(spark: SparkSession, rows: int | None) -> int | None:
    """Tasks for a table of ``rows`` rows if the session's shuffle partitions
    are too few for it, else None."""
    wanted = -(-(rows or 0) // ROWS_PER_TASK)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def score_groups(pred: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """Positives and negatives per score; a row counts ``rows`` times if the
    table has that column (``evaluate.counted``).

    With ``tasks`` a score has a row per partition of ``pred`` that holds it,
    so that a frequent score is spread as well.
    """
    by = [*keys, "score"]
    if tasks:
        weight = [WEIGHT] if WEIGHT in pred.columns else []
        pred = pred.select(*by, "label", *weight, F.spark_partition_id().alias("_part")).repartition(tasks, *by, "_part")
        by.append("_part")
    n = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1)
    return pred.groupBy(*by).agg(
        F.sum(F.when(F.col("label") == 1, n).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") != 1, n).otherwise(0)).alias("neg"),
    ).drop("_part")


def _splitters(groups: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Fewer than ``2 ** bits`` scores per group: the smallest hashes of each of
    several slices of the scores, so that no task sees those of all others."""
    slices = 1 << max(0, bits - 3)
    each = ((1 << bits) - 1) // slices
    # A rank filter this small is applied in each task before the shuffle.
    by_hash = Window.partitionBy(*keys, "_slice").orderBy(F.xxhash64("score"), "score")
    return (
        # Every group has rows; asking for its counts keeps this branch equal
        # to the other uses of ``groups``, so the table is scanned once.
        groups.where(F.col("pos") + F.col("neg") > 0)
        .select(*keys, "score", F.pmod(F.hash("score"), F.lit(slices)).alias("_slice"))
        .withColumn("_r", F.dense_rank().over(by_hash))
        .where(F.col("_r") <= each)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("score"), asc=False).alias("_cuts"))
    )


def _with_bucket(df: DataFrame, bits: int) -> DataFrame:
    """``_b`` = number of splitters above the score, by binary search in the
    descending ``_cuts`` (reading past the end gives null, which is no hit)."""
    df = df.withColumn("_b", F.lit(0))
    for step in (1 << i for i in reversed(range(bits))):
        hit = F.get("_cuts", F.col("_b") + (step - 1)) > F.col("score")
        df = df.withColumn("_b", F.when(hit, F.col("_b") + step).otherwise(F.col("_b")))
    return df.drop("_cuts")


def _bucketed(pred: DataFrame, keys: list[str], bits: int | None, rows: int | None) -> DataFrame:
    """Score groups with their bucket ``_b``, laid out by it."""
    spark = pred.sparkSession
    tasks = tasks_for(spark, rows)
    if bits is None:
        bits = max(bucket_bits(spark), (BUCKETS_PER_PARTITION * (tasks or 1) - 1).bit_length())
    groups = score_groups(pred, keys, tasks)
    # One row per group of the report, whatever the number of scores.
    cuts = F.broadcast(_splitters(groups, keys, bits))
    placed = _with_bucket(groups.join(cuts, keys), bits)
    if not tasks:
        return placed.repartition(*keys, "_b")
    # The rows of a score meet where its bucket is, without another shuffle.
    by_score = placed.repartition(tasks, *keys, "_b").groupBy(*keys, "_b", "score")
    return by_score.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def cumulative_counts(pred: DataFrame, keys: list[str], bits: int | None = None, rows: int | None = None) -> DataFrame:
    """Per distinct score: ``pos``/``neg`` at it, ``cum_pos``/``cum_neg`` at or
    above it, ``all_pos``/``all_neg`` of the group.  Scores are divided into
    ``2 ** bits`` buckets; ``rows`` is the size of ``pred`` if it is known."""
    by_bucket = [*keys, "_b"]
    # Both uses below start from this one shuffle.
    bucketed = _bucketed(pred, keys, bits, rows)

    totals = bucketed.groupBy(*by_bucket).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    # At most ``2 ** bits`` rows per group reach these windows.
    over_group = Window.partitionBy(*keys)
    before = over_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by_bucket,
        F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_pos_before"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_neg_before"),
        F.sum("_p").over(over_group).alias("all_pos"),
        F.sum("_n").over(over_group).alias("all_neg"),
    )
    inside = Window.partitionBy(*by_bucket).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = bucketed.withColumns({"_cp": F.sum("pos").over(inside), "_cn": F.sum("neg").over(inside)})
    # The big side is already partitioned by bucket and stays where it is.
    return running.join(offsets.hint("shuffle_hash"), by_bucket).select(
        *keys, "score", "pos", "neg",
        (F.col("_pos_before") + F.col("_cp")).alias("cum_pos"),
        (F.col("_neg_before") + F.col("_cn")).alias("cum_neg"),
        "all_pos", "all_neg",
    )


def roc_curve(pred: DataFrame, keys: list[str], bits: int | None = None, rows: int | None = None) -> DataFrame:
    """A point per distinct threshold plus the origin (threshold null).
    Rates are null where a class is missing."""
    c = cumulative_counts(pred, keys, bits, rows)
    fpr = F.try_divide(F.col("cum_neg"), F.col("all_neg"))
    tpr = F.try_divide(F.col("cum_pos"), F.col("all_pos"))
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    point = F.struct(F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    points = F.when(first, F.array(origin, point)).otherwise(F.array(point))
    return c.select(*keys, F.inline(points))


def area_under_roc(pred: DataFrame, keys: list[str], bits: int | None = None, rows: int | None = None) -> DataFrame:
    """Trapezoid area: each score adds its negatives times the positives above
    it, half of the positives tied with it included.

    A bucket gives its inner area and its totals; only these few rows are put
    in order, so no offset is joined to the scores.
    """
    by_bucket = [*keys, "_b"]
    inside = Window.partitionBy(*by_bucket).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = _bucketed(pred, keys, bits, rows).withColumn("_cp", F.sum("pos").over(inside))
    inner = F.sum(F.col("neg").cast("double") * (2 * F.col("_cp") - F.col("pos")).cast("double"))
    buckets = running.groupBy(*by_bucket).agg(inner.alias("_inner"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_above", F.coalesce(F.sum("_p").over(before), F.lit(0)))
    doubled = F.sum(F.col("_inner") + 2.0 * F.col("_n").cast("double") * F.col("_above").cast("double"))
    pairs = F.sum("_p").cast("double") * F.sum("_n").cast("double")
    return buckets.groupBy(*keys).agg(F.try_divide(doubled, 2.0 * pairs).alias("auc"))


# --- curves of bounded size ------------------------------------------------------------------------

SKETCH_K = 4096
POINTS = 1000
RANKS = 2000  # quantiles read from a sketch


def sketch_error(k: int = SKETCH_K) -> float:
    """Rank error of a quantile sketch of size ``k`` that 99 of 100 ranks keep."""
    return 2.446 / k**0.9433


def bounded_roc_curve(pred: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """At most ``POINTS`` points ``(threshold, fpr, tpr)`` per group from one
    mergeable quantile sketch per class.

    The state of a group is two sketches, whatever the number of rows or of
    distinct scores, and partial sketches are merged before the shuffle.
    Thresholds are quantiles of both classes; a rate is the share of a class's
    ``RANKS`` quantiles at or above the threshold, off by ``sketch_error(k)`` and
    a rank at most.  The origin has no threshold.  Groups without one of the classes have no curve.
    """
    positive = F.col("label") == 1
    kept = pred.where(F.col("score").isNotNull() & F.col("label").isNotNull())
    sketches = kept.groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.when(positive, F.col("score").cast("double")), k).alias("p"), F.count_if(positive).alias("n_p"),
        F.kll_sketch_agg_double(F.when(~positive, F.col("score").cast("double")), k).alias("n"), F.count_if(~positive).alias("n_n"))
    ranks = F.array(*[F.lit(i / RANKS) for i in range(RANKS + 1)])
    found = sketches.where("n_p > 0 and n_n > 0").select(
        *keys, F.kll_sketch_get_quantile_double("p", ranks).alias("p"), F.kll_sketch_get_quantile_double("n", ranks).alias("n"))
    step = -(-2 * RANKS // (POINTS - 4))
    some = [F.filter(c, lambda x, i: i % step == 0) for c in ("p", "n")]
    found = found.withColumn("cuts", F.reverse(F.array_sort(F.array_distinct(F.concat(*some)))))

    def share(quantiles, t):
        return F.size(F.filter(quantiles, lambda x: x >= t)) / float(RANKS + 1)

    point = F.transform("cuts", lambda t: F.struct(t.alias("threshold"), share("n", t).alias("fpr"), share("p", t).alias("tpr")))
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return found.select(*keys, F.inline(F.concat(F.array(origin), point)))


def curve_deviation(pred: DataFrame, curve: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """``(keys, points, off, area, exact_area)``: the largest distance of a
    curve's rates from the exact ones at its thresholds, and both areas.

    Rows are counted between thresholds in one aggregation; what is put in
    order is a row per threshold.
    """
    cuts = curve.where("threshold is not null").groupBy(*keys).agg(F.sort_array(F.collect_list("threshold"), asc=False).alias("_cuts"))
    known = pred.where("score is not null and label is not null")
    # A threshold has the scores from itself up to the next higher one.  Rows are
    # counted where they are read; scores are not grouped for it.
    placed = _with_bucket(known.join(F.broadcast(cuts), keys), POINTS.bit_length() + 1)
    n = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1)
    counts = placed.groupBy(*keys, "_b").agg(
        F.sum(F.when(F.col("label") == 1, n).otherwise(0)).alias("pos"), F.sum(F.when(F.col("label") != 1, n).otherwise(0)).alias("neg"))
    every = cuts.select(*keys, F.posexplode("_cuts").alias("_b", "threshold"))
    over = Window.partitionBy(*keys)
    running = over.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = counts.join(every, [*keys, "_b"], "full").select(
        *keys, "threshold", *[(F.sum(F.coalesce(c, F.lit(0))).over(running) / F.sum(c).over(over)).alias(r) for c, r in (("pos", "tpr"), ("neg", "fpr"))])
    both = curve.join(exact.select(*keys, "threshold", F.col("tpr").alias("t"), F.col("fpr").alias("f")), [*keys, "threshold"], "left")
    order = over.orderBy(F.desc_nulls_first("threshold"))
    both = both.withColumns({"f0": F.lag("fpr").over(order), "t0": F.lag("tpr").over(order)})
    off = F.greatest(F.max(F.abs(F.col("tpr") - F.col("t"))), F.max(F.abs(F.col("fpr") - F.col("f"))))
    area = F.sum((F.col("fpr") - F.col("f0")) * (F.col("tpr") + F.col("t0")) / 2)
    found = both.groupBy(*keys).agg(F.count("*").alias("points"), off.alias("off"), area.alias("area"))
    return found.join(area_under_roc(pred, keys, rows=rows).withColumnRenamed("auc", "exact_area"), keys)
