"""Mix sources to target weights.

The words of a source are packed into blocks of fixed length, in the order of
a hash of the documents.  A source fills as many slots of the mixture as its
target asks for; how many of them lie in each output shard is a multinomial
draw.  The slots of a source are numbered, and a pseudorandom permutation of
its block indexes for every round through the source says which block a slot
holds; slots and blocks meet in a join on ``(source, block)``.  All draws are
functions of the seed and of the sizes, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .sizes import small
from .words import mix

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """``weights`` repeat over the sources in code-point order, null last;
    ``repeat`` bounds how often a source is read; ``block`` words per block;
    ``shard`` slots per output shard on average."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    repeat: int = 3
    block: int = 64
    shard: int = 4096
    seed: int = 17
    group: int = 2048
    bucket_rows: int = 2_000


def sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``, size in words (null text: 0)."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, rule: Mixture = Mixture()) -> DataFrame:
    """``(source, source_size, target)``, one row per source.

    All sizes together are shared by weight; a target stops at ``repeat``
    times its source's size and the excess goes to the others by weight, until
    none is above.  In closed form: with the sources in the order of
    ``limit / weight``, the capped ones are a prefix.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in rule.weights]), (F.pmod(rank, F.lit(len(rule.weights))) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("limit", F.col("source_size") * rule.repeat)
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "total": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole),
        "spent": F.coalesce(F.sum("limit").over(order), F.lit(0)), "gone": F.coalesce(F.sum("weight").over(order), F.lit(0.0))})
    # The level at which a source and all behind it would be filled together.
    level = (F.col("total") - F.col("spent")) / (F.col("weights") - F.col("gone"))
    s = s.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
    common = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(whole)
    s = s.withColumn("common", common["level"])
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("common"), F.lit(float("inf"))) * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def _with_source(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on ``source`` (null equals null) and ``keys``, all taken from the
    left side."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in ("source", *keys)})
    on = F.col("source").eqNullSafe(F.col("_source"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return left.join(renamed, on, how).drop("_source", *(f"_{k}" for k in keys))


def placed(sized: DataFrame) -> DataFrame:
    """``sized`` plus ``start``, the first word of each document in its source.

    Documents are ordered by a hash bucket and by id; the number of buckets
    follows the number of rows, so no source is summed up in one task.
    """
    n = max(1, -(-sized.count() // Mixture.bucket_rows))
    # Empty documents take no place and may be left out by the caller.
    d = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(n)))
    totals = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = _with_source(d, base, "bucket")
    return d.select("doc_id", "source", "size", (F.col("base") + F.col("inner")).alias("start"))


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """The places of ``i`` in a pseudorandom permutation of ``range(n)``: a
    four-round Feistel network on the next even number of bits, repeated until
    the value lies below ``n``."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for r in range(4):
            left, right = right, left ^ (mix(right ^ np.uint64((key * 4 + r) % (1 << 64))) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def slots(goal: DataFrame, rule: Mixture = Mixture()) -> DataFrame:
    """``(source, shard, slot, block)``: the mixture, one row per slot.

    ``goal`` is a table of ``targets``.  A source of ``B`` blocks gets the
    number of slots that its mean block length asks for, ``repeat * B`` at
    most.  The multinomial draw has two levels, groups of shards and shards,
    so that every task draws the counts of its own shards alone.
    """
    g = goal.where("source_size > 0").withColumns({
        "blocks": F.ceil(F.col("source_size") / rule.block), "key": F.xxhash64(F.coalesce("source", F.lit("\u0000null")))})
    g = g.withColumn("wanted", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    n_shards = max(1, -(-(g.agg(F.sum("wanted")).first()[0] or 0) // rule.shard))
    n_groups = -(-n_shards // rule.group)
    g = g.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))))
    g = g.select("source", "key", "blocks", "wanted", "group").repartition("key", "group")

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                key = int(r.key) % (1 << 64)
                width = np.minimum(rule.group, n_shards - np.arange(n_groups) * rule.group)
                split = np.random.default_rng([rule.seed, key]).multinomial(r.wanted, width / width.sum())
                own = int(width[r.group])
                counts = np.random.default_rng([rule.seed, key, int(r.group)]).multinomial(split[r.group], np.full(own, 1 / own))
                number = int(split[: r.group].sum()) + np.arange(counts.sum())
                turn, index = np.divmod(number, r.blocks)
                block = np.zeros(len(number), np.int64)
                for t in np.unique(turn):
                    now = turn == t
                    block[now] = permuted(index[now], int(r.blocks), key ^ (rule.seed * 1000003 + int(t)))
                first = np.cumsum(counts) - counts
                yield pd.DataFrame({
                    "source": pd.Series([r.source] * len(number), dtype=object), "shard": np.repeat(r.group * rule.group + np.arange(own), counts),
                    "slot": np.arange(len(number)) - np.repeat(first, counts), "block": block})

    return g.mapInPandas(draw, "source string, shard long, slot long, block long")


def segments(where: DataFrame, rule: Mixture = Mixture()) -> DataFrame:
    """``(doc_id, source, size, start, block, words)``: the blocks that each
    document (of at least one word) lies in."""
    last = F.floor((F.col("start") + F.col("size") - 1) / rule.block)
    lies = F.sequence(F.floor(F.col("start") / rule.block), last)
    d = where.select("doc_id", "source", "size", "start", F.explode(lies).alias("block"))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * rule.block) - F.greatest("start", F.col("block") * rule.block)
    return d.withColumn("words", words)


def mix_sources(docs: DataFrame, rule: Mixture = Mixture()) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, a row per input row of
    ``docs(doc_id, source, text, ...)``.

    ``taken`` counts the document's words in the mixture, repeats included: at
    most ``repeat`` times its size.  The words taken of a source miss its
    target by half a mean block plus one short last block per round at most.
    Null and empty texts have size 0 and are never taken; a null source is a
    source of its own, the last; rows that repeat count as documents each.
    """
    sized = materialise(sizes(docs), "mix-sizes")
    goal = materialise(targets(sized, rule), "mix-targets")
    # Made from a few rows of targets, this table looks small to the planner but
    # grows with the corpus: it is merged, never broadcast.
    uses = slots(goal, rule).groupBy("source", "block").agg(F.count("*").alias("times")).hint("merge")
    parts = segments(placed(sized.where("size > 0")), rule)
    met = _with_source(parts, uses, "block", how="left")
    met = met.select("doc_id", "source", "size", "start", (F.col("words") * F.col("times")).alias("part"))
    taken = met.groupBy("source", "doc_id", "size", "start").agg(
        F.coalesce(F.sum("part"), F.lit(0)).alias("taken")).drop("start")
    # Rows without words need no place.
    taken = taken.unionByName(sized.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    goals = small(goal)
    out = _with_source(taken, goals)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, rule: Mixture = Mixture()) -> DataFrame:
    """``(shard, slot, source, text)``: the mixture itself, words of a block
    joined by blanks.  A block gathers at most ``rule.block`` words."""
    sized = materialise(sizes(docs), "mix-sizes")
    goal = materialise(targets(sized, rule), "mix-targets")
    where = placed(sized)
    texts = docs.select(F.col("doc_id").alias("_doc"), "source", "text").dropDuplicates()
    texts = texts.withColumn("all", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))).drop("text")
    parts = segments(where.where("size > 0"), rule)
    cut = _with_source(parts, texts).where(F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.size("all") == F.col("size")))
    piece = F.slice("all", (F.greatest("start", F.col("block") * rule.block) - F.col("start") + 1).cast("int"), F.col("words").cast("int"))
    blocks = cut.groupBy("source", "block").agg(F.array_join(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("start", piece.alias("w")))), lambda x: x["w"])), " ").alias("text"))
    return _with_source(slots(goal, rule).hint("merge"), blocks, "block").select("shard", "slot", "source", "text")
