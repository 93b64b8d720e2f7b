"""Report tables: metric stacks, run comparison, scaling and cost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COST_PER_EXECUTOR_MINUTE = 0.10


def stack(reports: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of report tables with a constant tag column; columns missing in
    one of them are null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in reports.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def compare_runs(run_a: DataFrame, run_b: DataFrame, times_a: DataFrame, mapping: DataFrame) -> DataFrame:
    """Metrics of two runs side by side, matched through a name mapping
    ``(Algorithm, baseline, timing)``."""
    return (
        mapping
        .join(run_a.select(F.col("model").alias("Algorithm"), F.col("accuracy").alias("a_accuracy"), F.col("f1_positive").alias("a_f1")), "Algorithm")
        .join(run_b.select(F.col("model").alias("baseline"), F.col("accuracy").alias("b_accuracy"), F.col("f1_positive").alias("b_f1")), "baseline")
        .join(times_a.select(F.col("profile").alias("timing"), F.col("train_time_s").alias("a_time_s")), "timing")
        .select("Algorithm", "a_accuracy", "a_f1", "a_time_s", "baseline", "b_accuracy", "b_f1")
    )


def scaling_runs(log: DataFrame) -> DataFrame:
    """Average time and number of runs per (experiment, profile, executors)."""
    return log.groupBy("experiment", "profile", "executors").agg(
        F.count("*").alias("runs"), F.avg("train_time_s").alias("train_time_s"))


def scaling_report(log: DataFrame) -> DataFrame:
    """Speedup, efficiency and cost of the strong-scaling rows against the row
    with the fewest executors; weak-scaling rows keep nulls there."""
    runs = scaling_runs(log)
    # One row per (experiment, profile, executors) reaches the window.
    w = Window.partitionBy("experiment", "profile")
    base = F.min_by("train_time_s", "executors").over(w)
    strong = F.col("experiment") == "strong_scaling"
    speedup = F.try_divide(base, F.col("train_time_s"))
    cost = F.col("train_time_s") / 60 * F.col("executors") * COST_PER_EXECUTOR_MINUTE
    return runs.withColumns({
        "speedup": F.when(strong, speedup),
        "efficiency": F.when(strong, speedup / F.col("executors")),
        "cost_usd": F.when(strong, cost),
    })


def scaling_combined(log: DataFrame) -> DataFrame:
    """Weak and strong results in one plot table ``(experiment, variable,
    value, train_time_s)``."""
    weak = F.col("experiment") == "weak_scaling"
    variable: Column = F.when(weak, F.format_string("%d%% data", (F.col("data_fraction") * 100).cast("int"))).otherwise(
        F.format_string("%d cores", F.col("executors")))
    per = log.withColumn("variable", variable).groupBy("experiment", "variable").agg(
        F.count("*").alias("_rows"), F.max("executors").cast("bigint").alias("_cores"), F.avg("train_time_s").alias("train_time_s"))
    return per.select("experiment", "variable", F.when(weak, F.col("_rows")).otherwise(F.col("_cores")).alias("value"), "train_time_s")


def rounded(df: DataFrame, digits: int = 6, columns: list[str] | None = None) -> DataFrame:
    """Round the double columns of a report."""
    doubles = columns or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})
