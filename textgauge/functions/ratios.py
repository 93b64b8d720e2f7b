"""Metric ratios from the four confusion cells, safe under ANSI division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num, den) -> Column:
    """``num / den`` as double, 0 where the denominator is 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"))


def f1(tp, fp, fn) -> Column:
    """F1 of one class from its hits, false alarms and misses."""
    tp, fp, fn = (F.col(c) if isinstance(c, str) else c for c in (tp, fp, fn))
    return ratio(2 * tp, 2 * tp + fp + fn)
