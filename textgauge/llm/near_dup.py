"""Near duplicates by HyperMinHash sketches.

A document is the set of its word shingles.  Its sketch has one 16-bit
register per bucket: the leading-zero count (6 bits) and the next mantissa
bits (10) of the smallest hash in the bucket.  Empty buckets borrow the
register of another one, chosen by a fixed pseudorandom sequence.

1. Documents of equal sets are one class; only its smallest id goes on.
2. Bands of registers are hashed; the classes that meet in any band make
   candidate clusters (edges to the smallest id of a band bucket, components).
3. In a cluster, pairs are tested inside blocks of bounded size: first the
   Jaccard estimate, corrected for accidental register collisions, then the
   full sets.  A block gives the edges of a spanning forest, never its pairs,
   and no pair is tested that is already connected.
4. A cluster of several blocks (thousands of near copies) is first contracted:
   every block inside itself, then the best-connected members of all blocks.
   After that only blocks that do not lie in one component meet each other,
   so all links are found without meeting the bulk of a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .components import connected_components
from .words import distinct_sets, mix, pieces

MANTISSA_BITS = 10


@dataclass(frozen=True)
class Rule:
    """``percent``: link if 100 * intersection >= percent * union.  ``bands``
    x ``rows`` registers: at a Jaccard of 0.85 a pair is missed by all bands
    with a probability below 3e-7, at 0.8 below 6e-5.  ``block``: classes per
    block, ``block_shingles`` bounds their total size."""

    shingle: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 6
    lower: bool = True
    short: bool = True
    block: int = 192
    block_shingles: int = 1_000_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=8)
def _borrow(n: int, tries: int = 64) -> np.ndarray:
    """The buckets that an empty bucket asks, in order."""
    at = np.arange(n, dtype=np.uint64)[:, None] * np.uint64(tries) + np.arange(tries, dtype=np.uint64)[None, :]
    return (mix(at + np.uint64(0x5EED)) % np.uint64(n)).astype(np.int64)


def _register(h: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 64-bit hashes, as one number."""
    # float64 keeps 53 bits: rounding up at a power of two changes the count
    # of zeros, so the lowest bits are cleared first.
    top = h & np.uint64(0xFFFFFFFFFFFFFC00)
    zeros = np.where(top == 0, 63, 63 - np.floor(np.log2(np.maximum(top, 1).astype(np.float64))).astype(np.int64))
    zeros = np.clip(zeros, 0, 53)
    mantissa = (h << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)


def registers_of(s: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Registers (texts x n) of the sets ``s[first[i]:first[i + 1]]``."""
    rows = len(first) - 1
    owner = np.repeat(np.arange(rows), np.diff(first))
    spread = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    bucket = (spread % np.uint64(n)).astype(np.int64)
    low = np.full(rows * n, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, owner * n + bucket, mix(spread))
    low = low.reshape(rows, n)
    empty = low == np.iinfo(np.uint64).max
    out = _register(low)
    if empty.any():
        ask = _borrow(n)
        r, b = np.nonzero(empty & (np.diff(first) > 0)[:, None])
        for t in range(ask.shape[1]):
            if not len(r):
                break
            target = ask[b, t]
            found = ~empty[r, target]
            out[r[found], b[found]] = _register(low[r[found], target[found]])
            r, b = r[~found], b[~found]
        if len(r):  # a handful of shingles in many buckets: the next bucket in order
            for i in np.unique(r):
                full = np.flatnonzero(~empty[i])
                mine = b[r == i]
                source = full[np.searchsorted(full, mine) % len(full)]
                out[i, mine] = _register(low[i, source])
    return out


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, n_shingles, digest, registers)`` of ``docs(doc_id, text)``;
    ``digest`` is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in pieces(batch.column(1)):
                s, owner = p.shingles(p.word_hashes(rule.lower), rule.shingle, rule.short)
                s, first = distinct_sets(s, owner, p.rows)
                n = np.diff(first)
                regs = registers_of(s, first, rule.registers)
                with np.errstate(over="ignore"):
                    sums = np.zeros((2, len(s) + 1), np.uint64)
                    np.cumsum(mix(s), out=sums[0, 1:])
                    np.cumsum(mix(s ^ np.uint64(0xD1)), out=sums[1, 1:])
                    a, b = mix(sums[0, first[1:]] - sums[0, first[:-1]]), mix(sums[1, first[1:]] - sums[1, first[:-1]])
                some = n > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(p.first_row, p.rows).cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x if k else None for x, k in zip(_bytes(np.stack([a, b], 1)), some)], pa.binary()),
                    pa.array([x if k else None for x, k in zip(_bytes(regs), some)], pa.binary()),
                ], ["doc_id", "n_shingles", "digest", "registers"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, registers binary")


def _bytes(rows: np.ndarray) -> list[bytes]:
    width, raw = rows.shape[1] * rows.itemsize, np.ascontiguousarray(rows).tobytes()
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def _bands(classes: DataFrame, rule: Rule) -> DataFrame:
    """``(band, id)``: a hash of every band of every class."""
    width = 2 * rule.rows
    keys = [F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(rule.bands)]
    return classes.select(F.explode(F.array(*keys)).alias("band"), "id")


def _sets(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """Full sets of the wanted classes: ``ids(id, ...)`` plus ``shingles``."""
    extra = [c for c in ids.columns if c != "id"]
    rows = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id").select("id", "text", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in pieces(batch.column(1)):
                s, owner = p.shingles(p.word_hashes(rule.lower), rule.shingle, rule.short)
                s, first = distinct_sets(s, owner, p.rows)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(s.view(np.int64)))
                own = batch.slice(p.first_row, p.rows)
                yield pa.RecordBatch.from_arrays([*(own.column(i) for i in range(own.num_columns) if i != 1), lists], out)

    out = ["id", *extra, "shingles"]
    kinds = dict(ids.dtypes)
    return rows.mapInArrow(run, ", ".join(["id long", *(f"{c} {kinds[c]}" for c in extra), "shingles array<long>"]))


class _Forest:
    def __init__(self, labels: np.ndarray):
        self.up = np.unique(labels, return_inverse=True)[1].copy()  # equal labels are connected

    def roots(self) -> np.ndarray:
        return self.up

    def join(self, a: int, b: int) -> bool:
        x, y = self.up[a], self.up[b]
        if x == y:
            return False
        self.up[self.up == y] = x
        return True


def linked_forest(ids, labels, sides, registers, sets, rule: Rule):
    """Links of a spanning forest among the members of a block, and how many
    estimated links each member has.

    ``labels`` joins what is known to be connected.  ``sides``: members of the
    same side (1 or 2) were compared before; 0 meets everything.
    """
    m, forest = len(ids), _Forest(labels)
    size = np.array([len(x) for x in sets], np.int64)
    degree, edges, work = np.zeros(m, np.int64), [], []
    chance = 2.0 ** -MANTISSA_BITS  # two different minima share a register
    for i in range(m - 1):
        rest = slice(i + 1, m)
        equal = (registers[rest] == registers[i]).mean(axis=1)
        estimate = (equal - chance) / (1 - chance)
        small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        margin = 5 * np.sqrt(0.25 / np.minimum(rule.registers, np.maximum(large, 1)))
        near = (estimate >= rule.percent / 100 - margin) & (100 * small >= rule.percent * large)
        j = np.flatnonzero(near) + i + 1
        likely = j[estimate[j - i - 1] >= rule.percent / 100]
        degree[i] += len(likely)
        degree[likely] += 1
        j = j[(sides[j] == 0) | (sides[j] != sides[i])]
        work += zip((-estimate[j - i - 1]).tolist(), [i] * len(j), j.tolist())
    for _, i, j in sorted(work):
        if forest.up[i] == forest.up[j]:
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= rule.percent * (size[i] + size[j] - both):
            forest.join(i, j)
            edges.append((ids[i], ids[j]))
    return edges, degree


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values in the first ``keys`` columns of sorted rows; a
    run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _compare(members: DataFrame, rule: Rule, name: str) -> DataFrame:
    """Run ``linked_forest`` on every ``(cluster, part)`` of ``members(cluster,
    part, id, label, side, registers, shingles)``: rows ``(a, b, cluster,
    degree)``, links with ``b`` and, with ``b`` null, the degree of ``a``."""

    def run(batches):
        for g in sorted_groups(batches, 2):
            if g.num_rows < 2:
                continue
            ids = g["id"].to_numpy()
            sets = [np.asarray(x.values).view(np.uint64) for x in g["shingles"].combine_chunks()] if g.num_rows else []
            regs = np.frombuffer(b"".join(g["registers"].to_pylist()), np.uint16).reshape(g.num_rows, -1)
            edges, degree = linked_forest(ids, g["label"].to_numpy(), g["side"].to_numpy(), regs, sets, rule)
            cluster = g["cluster"][0].as_py()
            a = [int(x) for x, _ in edges] + ids.tolist()
            b = [int(x) for _, x in edges] + [None] * len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([cluster] * len(a), pa.int64()),
                pa.array([0] * len(edges) + degree.tolist(), pa.int64()), pa.array([g["part"][0].as_py()] * len(a), pa.int64()),
            ], ["a", "b", "cluster", "degree", "part"])

    rows = members.select("cluster", "part", "id", "label", "side", "registers", "shingles")
    rows = rows.repartition("cluster", "part").sortWithinPartitions("cluster", "part")
    return materialise(rows.mapInArrow(run, "a long, b long, cluster long, degree long, part long"), name)


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` (doc_id, text, ...) to ``(doc_id, n_shingles, component_id,
    kept)``, a row per input row.

    Two documents are linked if their shingle sets meet ``rule``; a component
    is named by its smallest doc_id, which is the row kept.  A null or empty
    text has no shingles and is linked with nothing.  A null doc_id has no
    name to be linked by: its component is null and it is kept.  Repeated rows
    each get the same result.  Other columns are ignored.
    """
    sk = materialise(sketches(docs, rule), "sketches")
    classes = sk.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles"))
    classes = materialise(classes, "classes")
    edges = class_links(docs, classes.select("id", "registers", "n_shingles"), rule)
    parts = connected_components(edges, "near-components")
    named = classes.join(parts, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    out = sk.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def class_links(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``(a, b)`` that connect all linked classes."""
    bands = _bands(classes, rule)
    heads = bands.groupBy("band").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = bands.join(heads, "band").where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    clusters = connected_components(materialise(met, "band-edges"), "clusters").select("id", F.col("component").alias("cluster"))
    members = clusters.join(classes, "id")
    sizes = members.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / rule.block), F.ceil(F.sum("n_shingles") / rule.block_shingles)).alias("blocks"))
    members = members.join(sizes, "cluster").withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")))
    members = materialise(_sets(docs, members.drop("n_shingles"), rule).dropDuplicates(["id", "cluster"]), "members")
    plain = members.withColumns({"label": F.col("id"), "side": F.lit(0)})
    local = _compare(plain, rule, "local-links")

    # Contraction: the best-connected members of the blocks of large clusters.
    big = members.where("blocks > 1")
    ranked = local.where("b is null").join(big.select(F.col("id").alias("a"), "blocks"), "a")
    best = ranked.groupBy("cluster", "part").agg(F.max_by("a", F.struct("degree", "a")).alias("id"))
    tops = big.join(best.select("id"), "id", "left_semi").withColumns({
        "part": F.floor(F.col("part") / rule.block), "label": F.col("id"), "side": F.lit(0)})
    top = _compare(tops, rule, "top-links")
    known = local.where("b is not null").select("a", "b").union(top.where("b is not null").select("a", "b"))

    # What is not in one component yet meets in pairs of blocks.
    big_edges = known.join(big.select(F.col("id").alias("a")), "a", "left_semi")
    labels = connected_components(big_edges, "big-components").withColumnRenamed("component", "label")
    big = big.drop("blocks", "part").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    size = big.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("s"))
    # Components of a block or more have blocks of their own; the others share.
    size = size.withColumn("owner", F.when(F.col("n") >= rule.block, F.col("label")))
    shared = size.groupBy("cluster", "owner").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    shared = shared.withColumn("blocks", F.greatest(F.ceil(F.col("n") / rule.block), F.ceil(F.col("s") / rule.block_shingles)))
    placed = big.join(size.select("cluster", "label", "owner"), ["cluster", "label"])
    same = (placed["cluster"] == shared["cluster"]) & placed["owner"].eqNullSafe(shared["owner"])
    placed = placed.join(shared, same).select(
        placed["cluster"], placed["owner"], "id", "label", "registers", "shingles",
        F.pmod(F.xxhash64("id", F.lit("r")), F.col("blocks")).alias("slot"))
    placed = materialise(placed.withColumn("block", F.xxhash64("owner", "slot")), "placed")
    blocks = placed.select("cluster", "owner", "block").distinct()
    other = blocks.select(F.col("cluster").alias("c2"), F.col("owner").alias("o2"), F.col("block").alias("b2"))
    apart = (F.col("cluster") == F.col("c2")) & (F.col("block") <= F.col("b2"))
    pairs = blocks.join(other, apart).where(~F.coalesce(F.col("owner") == F.col("o2"), F.lit(False)))
    pairs = pairs.select("cluster", "block", "b2", F.xxhash64("block", "b2").alias("part"))
    own = F.col("block") == F.col("b2")
    first = pairs.select("cluster", "block", "part", F.when(own, 0).otherwise(1).alias("side"))
    second = pairs.where(~own).select("cluster", F.col("b2").alias("block"), "part", F.lit(2).alias("side"))
    meeting = placed.join(first.union(second), ["cluster", "block"])
    rest = _compare(meeting, rule, "rest-links")
    return known.union(rest.where("b is not null").select("a", "b"))
