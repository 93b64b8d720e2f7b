"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few numbers each: some 20 MB in memory.
BROADCAST_ROWS = 500_000


def small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, which has been written, with a broadcast hint if it has at
    most ``limit`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table
