"""Prefix trie of conversations, rolled up in depth bands.

A node is a sequence of leading turns that some conversation starts with.  Its
key is 128 bits wide: the exclusive or of a hash of every turn and its place,
so a key of ``d`` turns gives that of ``d - 1`` without another row, and keys of
long conversations are put together from blocks.

Subtree sums: nodes of a band of ``band`` depths are added to their ancestors
inside the band only.  The band roots form a trie of their own, ``band`` times
less deep, which is rolled up the same way; its completed totals are added to
the ancestors in the band above.  A node is exploded to at most ``band`` rows,
and there are as many levels as the depth has digits to the base ``band``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise

KEY = ["depth", "k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Rule:
    """``band``: depths in a band.  ``block``: turns of a conversation whose
    hashes are put together in one place."""

    band: int = 16
    block: int = 4096


def _word(hexadecimal: Column, first: int) -> Column:
    """16 hexadecimal digits as a signed 64-bit number."""
    return F.conv(F.substring(hexadecimal, first, 16), 16, -10).cast("long")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, c1, c2, bytes)``: turns in order, 1-based, with a
    128-bit hash of role and text.

    Rows are cut into ranges of the whole order, so a conversation with many
    rows lies in many ranges; places found inside a range are moved by the rows
    of the same conversation in the ranges before it.
    """
    t = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # The start of a text sorts as the text does; whole texts would go to the
    # driver with the sample that Spark takes for the ranges.
    t = t.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    t = t.select(
        "conv_id", F.spark_partition_id().alias("part"), "turn", "role", "text",
        said.alias("said"), F.octet_length("text").cast("long").alias("bytes"))
    t = materialise(t.withColumns({"c1": _word(F.col("said"), 1), "c2": _word(F.col("said"), 17)}).drop("said"), "trie-turns")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = t.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where("before > 0").drop("n")
    t = t.withColumn("place", F.row_number().over(inside).cast("long")).select("conv_id", "part", "place", "c1", "c2", "bytes")
    t = t.join(counts, ["conv_id", "part"], "left")
    return t.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "c1", "c2", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, c1, c2, bytes, n_turns)`` of the rebuilt
    conversations and ``(conv_id, n_turns, ...)`` of each: the first ``h`` turns of
    conversation ``c - c % 5``, then the own turns after the first ``h``, with
    ``h`` the CRC-32 of the decimal ``c`` modulo 9."""
    t = materialise(ordered_turns(turns), "trie-places")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("long")
    n = t.groupBy("conv_id").agg(F.max("place").alias("own"))
    convs = n.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    convs = convs.join(n.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    convs = materialise(convs, "trie-conversations")
    # At most eight turns of a base, for nine conversations at most.
    heads = t.where("place <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    first = convs.where("head > 0").join(heads, "base").where("place <= head").select(
        "conv_id", F.col("place").alias("depth"), "c1", "c2", "bytes", "n_turns")
    rest = t.join(convs.where("n_turns > head"), "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "c1", "c2", "bytes", "n_turns")
    return first.union(rest), convs


def paths(turns: DataFrame, rule: Rule) -> DataFrame:
    """``(conv_id, depth, k1, k2, up1, up2, bytes, n_turns)``: every node on
    the way of every rebuilt conversation, its key and that of its parent."""
    t, convs = rebuilt_turns(turns)
    t = t.withColumns({
        "e1": F.xxhash64("depth", "c1", "c2"), "e2": F.xxhash64("c2", "depth", "c1"),
        "part": F.floor((F.col("depth") - 1) / rule.block)})
    t = materialise(t.drop("c1", "c2"), "trie-rebuilt")
    inside = Window.partitionBy("conv_id", "part").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = t.groupBy("conv_id", "part").agg(F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"))
    blocks = blocks.withColumns({"b1": F.bit_xor("b1").over(before), "b2": F.bit_xor("b2").over(before)}).where("part > 0")
    t = t.withColumns({"k1": F.bit_xor("e1").over(inside), "k2": F.bit_xor("e2").over(inside)}).join(blocks, ["conv_id", "part"], "left")
    for i in "12":
        t = t.withColumn(f"k{i}", F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))))
        t = t.withColumn(f"up{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"e{i}")))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("up1"), none.alias("up2"), zero.alias("bytes"), "n_turns")
    return t.select(roots.columns).union(roots)


def _above(size: int) -> Column:
    return F.floor((F.col("depth") - 1) / size)


def rolled_up(ways: DataFrame, values: DataFrame, depth: int, rule: Rule) -> DataFrame:
    """``(depth, k1, k2, leaves, saved)``: sums over subtrees.

    ``values(depth, k1, k2, conv_id, leaves, saved)`` has a row per node, with
    the smallest conversation through it; ``ways(conv_id, depth, k1, k2, up1,
    up2)`` a row per conversation and depth, ``up1, up2`` the key one depth
    above; ``depth`` is the largest one.
    """
    size = rule.band
    band = Window.partitionBy("conv_id", "above").orderBy("depth")
    # A conversation is the smallest one of a node and of all nodes below it on
    # its way, so only the bands from there on are wanted.
    tops = values.groupBy("conv_id").agg(F.min("depth").alias("top"))
    wanted = ways.where("depth > 0").withColumn("above", _above(size)).join(tops, "conv_id")
    wanted = wanted.where(F.col("above") >= F.floor((F.col("top") - 1) / size))
    # Keys of the ancestors, from the band root down to the parent.
    wanted = wanted.withColumn("ancestors", F.collect_list(F.struct(F.col("up1").alias("k1"), F.col("up2").alias("k2"))).over(band))
    wanted = wanted.where("depth >= top").select("conv_id", "depth", "ancestors")
    items = values.join(wanted, ["conv_id", "depth"], "left")
    deep = depth >= size
    items = materialise(items, "trie-items") if deep else items

    is_root = F.col("depth") % size == 0
    itself = F.array(F.struct("k1", "k2"))
    first = F.when(is_root, F.col("depth")).otherwise(F.col("depth") - F.size("ancestors"))
    spread = items.select(
        first.alias("first"), "leaves", "saved", F.posexplode(F.when(is_root, itself).otherwise(F.concat("ancestors", itself))).alias("i", "key"))
    total = spread.groupBy((F.col("first") + F.col("i")).alias("depth"), F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if not deep:
        return total
    total = materialise(total, "trie-bands")

    # The trie of the band roots: its parents are the roots of the bands above.
    upper = ways.where("depth > 0").withColumn("above", _above(size))
    upper = upper.withColumns({"r1": F.first("up1").over(band), "r2": F.first("up2").over(band)}).where(is_root)
    upper = upper.select("conv_id", (F.col("depth") / size).cast("long").alias("depth"), "k1", "k2", F.col("r1").alias("up1"), F.col("r2").alias("up2"))
    roots = items.where(is_root).select("conv_id", *KEY).join(total, KEY)
    done = rolled_up(materialise(upper, "trie-roots"), roots.withColumn("depth", (F.col("depth") / size).cast("long")), depth // size, rule)
    done = materialise(done.withColumn("depth", F.col("depth") * size), "trie-totals")

    # Completed band roots count for their ancestors in the band above.
    down = items.where(is_root).where("depth > 0").select("ancestors", *KEY).join(done, KEY).select(
        F.col("depth").alias("at"), "leaves", "saved", F.posexplode(F.slice("ancestors", 2, size)).alias("i", "key"))
    down = down.select((F.col("at") - size + 1 + F.col("i")).alias("depth"), F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"), "leaves", "saved")
    inner = total.where(~is_root).union(down).groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return inner.union(done)


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of equal values in the first ``keys`` columns of a sorted batch."""
    if not batch.num_rows:
        return
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
    change = sum((c[1:] != c[:-1]).astype(int) for c in columns).nonzero()[0] + 1
    cuts = [0, *change.tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield tuple(int(c[a]) for c in columns), batch.slice(a, b - a)


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)``: digests of the conversations that end
    in a node, ascending.  Ranges of all ends are joined to texts in many
    tasks; a digest then reads the texts of its node one after the other and
    never holds them together."""
    schema = "depth long, k1 long, k2 long"

    def join(batches):
        for batch in batches:
            rows = [(*key, run.column(3)[0].as_py(), ",".join(map(str, run.column(3).to_pylist()))) for key, run in _runs(batch, 3)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]), pa.array([r[4] for r in rows])], [*KEY, "first", "ids"])

    def digest(batches):
        last, state = None, None

        def out(found):
            return pa.RecordBatch.from_arrays(
                [*(pa.array([f[0][i] for f in found], pa.int64()) for i in range(3)), pa.array([f[1] for f in found], pa.string())], [*KEY, "ends_sha256"])

        for batch in batches:
            found = []
            for key, run in _runs(batch, 3):
                texts = run.column(4).to_pylist()
                if key != last:
                    if state is not None:
                        found.append((last, state.hexdigest()))
                    last, state = key, hashlib.sha256(texts.pop(0).encode())
                for t in texts:
                    state.update(b"," + t.encode())
            if found:
                yield out(found)
        if state is not None:
            yield out([(last, state.hexdigest())])

    order = [*KEY, "conv_id"]
    texts = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, f"{schema}, first long, ids string")
    texts = texts.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return texts.mapInArrow(digest, f"{schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The trie of ``turns(conv_id, turn, role, text, ...)`` after rebuilding
    every conversation (``rebuilt_turns``), a row per node: ``conv_id`` (its
    smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by turn (null first), then role and text; a null role or
    text is empty; rows that repeat are turns of their own.  Rows without
    ``conv_id`` belong to no conversation and are left out.  An empty table has
    no nodes, not even a root.  Other columns are ignored.
    """
    ways = materialise(paths(turns, rule), "trie-paths")
    nodes = ways.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("up1").alias("up1"), F.max("up2").alias("up2"))
    nodes = materialise(nodes, "trie-nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    kids = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialise(nodes, "trie-children")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    values = nodes.select(
        *KEY, "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = rolled_up(ways, values, depth, rule)
    digests = end_digests(ways.where("depth = n_turns"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, KEY, "left").join(digests, KEY, "left").join(parents, ["depth", "up1", "up2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
