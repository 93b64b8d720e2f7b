"""Exact duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicate_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Keep the row with the smallest id of every distinct text.

    Copies are counted on a 256-bit digest: the aggregation is a hash
    aggregate over fixed-size values with map-side combine, so a text that
    makes up a third of the table shrinks to one row per map task before the
    shuffle.  The full rows move at most once, by their unique id.
    """
    keep = (
        df.select(F.sha2(F.col(text_col), 256).alias("_digest"), id_col)
        .groupBy("_digest")
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )
    return df.join(keep, id_col, "left_semi")


def subtract_rows(df: DataFrame, other: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``other``.

    A set difference on whole rows would hash every column, feature vectors
    included, and also drop repeated rows; the unique id says the same.
    """
    return df.join(other.select(id_col), id_col, "left_anti")
