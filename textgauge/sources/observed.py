"""Metrics of a table taken while it is written, without a second scan."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Observed:
    """Named points of a plan whose metrics are known once its result has been
    written.

    ``at`` marks a point; ``write`` runs the plan, which scans its input once;
    ``metrics`` then has a dictionary per point, in the order of marking.  The
    counts come from the tasks that ran: where a lost executor makes a stage run
    again, its points count again, so ``write`` holds the last point against the
    rows in the files and raises if they differ.
    """

    def __init__(self):
        self._points: list[tuple[str, Observation]] = []
        self._written = False

    def at(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        point = Observation(f"{name}-{uuid.uuid4().hex}")
        self._points.append((name, point))
        return df.observe(point, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()])

    def write(self, df: DataFrame, path: str, by: str | None = None) -> None:
        w = df.write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(path)
        self._written = True
        # Row counts of Parquet come from the file footers.
        if self._points and df.sparkSession.read.schema(df.schema).parquet(path).count() != self.metrics()[-1][1]["rows"]:
            raise RuntimeError("a stage ran twice while it was counted; write again")

    def metrics(self) -> list[tuple[str, dict]]:
        if not self._written:
            raise RuntimeError("nothing has been written yet")
        return [(name, dict(point.get)) for name, point in self._points]

    def funnel(self, spark: SparkSession) -> DataFrame:
        """``(step, stage, rows)`` of all points."""
        rows = [(i + 1, name, m["rows"]) for i, (name, m) in enumerate(self.metrics())]
        return spark.createDataFrame(rows, "step int, stage string, rows long")
