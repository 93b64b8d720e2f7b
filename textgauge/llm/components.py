"""Connected components of an edge table, on the cluster."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise

# Edges that one task settles by itself: some 50 MB of working memory.
TASK_EDGES = 1 << 19


def least_members(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the edges ``(u, v)`` and the smallest id of their component."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(ids))
    while len(a):
        low = np.minimum(up[a], up[b])
        np.minimum.at(up, up[a], low)
        np.minimum.at(up, up[b], low)
        while True:
            above = up[up]
            if np.array_equal(above, up):
                break
            up = above
        apart = up[a] != up[b]
        a, b = a[apart], b[apart]
    return ids, ids[up]


def _settle(batches):
    """Edges of a task to edges ``(id, smallest id)`` of the same components."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u = np.concatenate([u, batch.column(0).to_numpy()])
        v = np.concatenate([v, batch.column(1).to_numpy()])
        if len(u) > 2 * TASK_EDGES:
            u, v = least_members(u, v)
            u, v = u[u != v], v[u != v]
            if len(u) > TASK_EDGES:
                yield _edges(u, v)
                u, v = u[:0], v[:0]
    u, v = least_members(u, v)
    yield _edges(u[u != v], v[u != v])


def _edges(u, v):
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _joined_up(e: DataFrame) -> DataFrame:
    return e.mapInArrow(_settle, "u long, v long")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; ``component`` is
    the smallest id that can be reached.

    Every task first settles the edges it has, so a hub is left with a row per
    task.  At most ``TASK_EDGES`` edges are then settled by one task; as long as
    there are more, the large-star and small-star steps alternate, every one of
    which replaces edges by edges to the smallest neighbour, so the table never
    grows and the rounds are logarithmic in the path lengths.  Each round is a
    written table; a lost executor costs one round.  Null ends and loops are
    ignored; an empty table has no components.
    """
    e = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = e.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    e = materialise(_joined_up(e), name)
    before = None
    while (rows := e.count()) > TASK_EDGES:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = materialise(large.where("u != v").distinct(), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        e = materialise(_joined_up(small.repartition(math.ceil(rows / TASK_EDGES), "v")).distinct(), name)
        # Sums of hashes tell whether a round changed the table.
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        e = materialise(_joined_up(e.coalesce(1)), name)
    labels = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return labels.union(roots)
