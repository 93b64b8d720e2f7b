"""The trie of rebuilt conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from textgauge.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(said):
        h = zlib.crc32(str(c).encode()) % 9
        rest = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = said.get(rest, [])[:h] + said[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
    return sorted(
        ((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
          hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members), key=repr)


def trie(spark, rows, rule=prefix_trie.Rule()):
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(1), "k1": F.lit("x"), "part": F.lit(2)})
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(turns, rule).select(COLUMNS).collect()), key=repr)


def conversations(seed, n, longest):
    draw, rows = random.Random(seed), []
    for c in range(-6, n):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a", "é", "漢字", ""])))
    draw.shuffle(rows)
    return rows


def test_trie_of_short_conversations(spark):
    rows = conversations(1, 40, 6)
    # Nulls, ties, repeated rows, a very long text, rows without a conversation.
    rows += [(41, None, None, None), (41, None, "user", "x"), (41, 3, "user", "b"), (41, 3, "user", "a"), (41, 3, "user", "a"), (None, 1, "user", "x"),
             (43, 0, "user", "long " * 200_000), (44, 0, "user", "long " * 200_000 + "er"), (50, 7, None, "")]
    assert trie(spark, rows) == plain(rows)


def test_deep_trie_over_many_bands(spark):
    draw, rows = random.Random(2), []
    stem = [("user", draw.choice("ab")) for _ in range(60)]
    for c in range(20):
        own = stem[: draw.randint(0, 60)] + [("user", draw.choice("abc")) for _ in range(draw.randint(1, 25))]
        rows += [(5 * c, i, *x) for i, x in enumerate(own)]
    want = plain(rows)
    assert max(r[1] for r in want) > 60
    assert trie(spark, rows, prefix_trie.Rule(band=2, block=7)) == want
    assert trie(spark, rows, prefix_trie.Rule(band=5, block=1)) == want
    assert trie(spark, rows) == want


def test_copies_and_a_conversation_with_most_rows(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300, 5) for t in range(4)]
    rows += [(1000, t, "user", f"{t % 7}") for t in range(3000)]
    assert trie(spark, rows, prefix_trie.Rule(band=16, block=64)) == plain(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []
    # All turns lie in the head, which the absent conversation 5 does not have.
    assert trie(spark, [(7, 0, "user", "x")]) == plain([(7, 0, "user", "x")])


def test_texts_of_ends_are_joined_over_ranges(spark):
    ids = list(range(30_000))
    ends = spark.range(30_000, numPartitions=4).select(F.lit(1).cast("long").alias("depth"), F.lit(2).cast("long").alias("k1"), (F.col("id") % 2 * 0 + 3).alias("k2"), F.col("id").alias("conv_id"))
    (row,) = prefix_trie.end_digests(ends).collect()
    assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
