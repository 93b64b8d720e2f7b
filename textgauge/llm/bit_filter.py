"""Filters of a fixed size that are sent to all tasks: what cannot be in a table
is dropped where it is read, before any shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB
BUCKET = 8 * 4096  # bits in a row of the bitmap functions


def bit_filter(places: DataFrame):
    """A broadcast bitmap of ``BITS`` bits, set at the places of a table with
    one column.  What it is asked for may be there by chance; nothing is lost."""
    place = F.col(places.columns[0]) + 1
    rows = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for bucket, part in rows.collect():
        at = (bucket - 1) * BUCKET // 8
        bits[at : at + len(part)] = np.frombuffer(part, np.uint8)
    return places.sparkSession.sparkContext.broadcast(bits)


def bits_at(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places.astype(np.int64)
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def place_of(column: str):
    """The place of a value in a filter."""
    return F.pmod(F.xxhash64(column), F.lit(BITS))


def low_bits(column: str):
    """The place of a number that is a hash already; in numpy ``x & (BITS - 1)``."""
    return F.col(column).bitwiseAND(F.lit(BITS - 1))


def texts_among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the documents whose id may be in ``ids(doc_id)``,
    so that a join with them moves few other texts."""
    among = bit_filter(ids.select(place_of("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = bits_at(among.value, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["doc_id", "text"]).filter(pa.array(some))

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.withColumn("place", place_of("doc_id")).mapInArrow(run, "doc_id long, text string")
