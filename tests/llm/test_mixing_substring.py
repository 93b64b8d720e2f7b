import random
import re

import pytest

from textgauge.llm import mixing, substring

DOCS = "doc_id long, source string, text string, size int"


def words(n):
    return " ".join(["w"] * n)


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in over})


def test_targets_stop_at_three_times_the_source(spark):
    sizes = {"a": 1000, "b": 10, "c": 90000, "d": 0, "é": 700, "z": 33, None: 5}
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = mixing.targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    want = brute_targets(sizes)
    assert {r["source"]: pytest.approx(r["target"]) for r in got} == want
    assert sum(r["target"] for r in got) == pytest.approx(sum(sizes.values()))


def test_mixture_meets_targets_and_reruns_agree(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", None]), words(r.randrange(400)), 0) for i in range(300)]
    rows += [(300, "a", None, 0), (301, None, "", 0), (None, "b", words(70), 0), (302, "b", words(90), 0), (302, "b", words(90), 0), (303, "tiny", words(4), 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    taken, target = {}, {}
    for g in got:
        assert 0 <= g["taken"] <= 3 * g["size"]
        key = (g["source_size"], g["target"])
        taken[key] = taken.get(key, 0) + g["taken"]
    for (size, target), t in taken.items():
        assert abs(t - target) <= 2 * 64
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    assert [(g["size"], g["target"], g["taken"]) for g in mixing.mix_sources(spark.createDataFrame([(1, None, None, 0)], DOCS)).collect()] == [(0, 0.0, 0)]


def test_permutations_are_permutations():
    import numpy as np

    for n in (1, 2, 3, 64, 1000):
        for key in (1, 99):
            assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))


def test_mixed_blocks_hold_the_words_of_their_documents(spark):
    rows = [(i, "ab"[i % 2], " ".join(f"d{i}x{j}" for j in range(50 + i)), 0) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    rule = mixing.Mixture(shard=8)
    blocks = mixing.mixed_blocks(docs, rule).collect()
    seen = {}
    for b in blocks:
        assert len(b["text"].split()) <= 64
        for w in b["text"].split():
            i = int(re.match(r"d(\d+)x", w)[1])
            seen[i] = seen.get(i, 0) + 1
    assert seen == {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs, rule).collect() if r["taken"]}
    assert len({(b["shard"], b["slot"], b["source"]) for b in blocks}) == len(blocks)


def noise(r, n):
    return [f"n{r.randrange(10**9)}" for _ in range(n)]


def test_planted_passages_are_found_in_full(spark):
    r = random.Random(7)
    docs, want = [], {}
    for g in range(40):
        length = r.choice([50, 51, 60, 75, 120, 300])
        passage = noise(r, length)
        for c in range(r.choice([2, 2, 3, 6])):
            before, after = noise(r, r.randrange(90)), noise(r, r.randrange(90))
            i = len(docs)
            docs.append((i, "\n".join([" ".join(before), " ".join(passage)]) + " " + " ".join(after)))
            if c:
                want[i] = (len(before), len(before) + length)
    for _ in range(20):
        short = noise(r, 49)
        for _ in range(2):
            docs.append((len(docs), " ".join(noise(r, 40) + short + noise(r, 40))))
    twice = " ".join(noise(r, 60))
    docs += [(len(docs), twice + " x " + twice), (None, twice), (9000, None), (9001, ""), (9002, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring.repeated_passages(df).collect()
    assert {g["doc_id"]: (g["start"], g["stop"]) for g in got} == want
    assert all(g["other"] < g["doc_id"] and g["cluster"] <= g["other"] for g in got)
    wide = df.selectExpr("doc_id", "text as text", "1 as cluster", "'x' as start")
    cut = {x["doc_id"]: x["text"] for x in substring.without_passages(wide).collect()}
    assert len(cut) == len(docs)
    for i, t in docs:
        if i not in want:
            assert cut[i] == t
        else:
            a, b = want[i]
            w = t.split()
            assert cut[i].split() == w[:a] + w[b:]


def near_passages_of_large_buckets():
    """Many texts share one word less than a paragraph, so their bands meet
    without a passage; pairs of them hold a near passage, not an equal one."""
    r = random.Random(21)
    common = noise(r, 49)
    docs = [(i, " ".join(noise(r, 12) + common + noise(r, 12))) for i in range(30)]
    for k in range(8):
        passage = common + noise(r, 8)
        for i, words in ((200 + 2 * k, passage), (201 + 2 * k, passage[: 22 + k] + passage[23 + k :])):
            docs.append((i, " ".join(noise(r, 12) + words + noise(r, 12))))
    return docs


def test_near_passages_in_a_bucket_of_any_size(spark):
    df = spark.createDataFrame(near_passages_of_large_buckets(), "doc_id long, text string")
    pairs = {(201 + 2 * k, 200 + 2 * k) for k in range(8)}
    # Where all buckets are small, all members are compared.
    found = [{(g["doc_id"], g["other"]) for g in substring.repeated_passages(df, substring.Rule(few=few)).collect()} for few in (16, 1000)]
    assert found[0] == found[1] and found[0] <= pairs and len(found[0]) >= 6


def test_a_hot_passage_and_near_passages(spark):
    r = random.Random(8)
    passage = noise(r, 100)
    docs = [(i, " ".join(noise(r, 20) + passage + noise(r, 20))) for i in range(200)]
    changed = list(passage)
    changed[60] = "other"
    docs.append((500, " ".join(noise(r, 20) + changed)))
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {g["doc_id"] for g in got} == {*range(1, 200), 500} and {g["cluster"] for g in got} == {0}
    assert {(g["start"], g["stop"]) for g in got} == {(20, 120)}
    gone = substring.without_passages(spark.createDataFrame([(1, " ".join(passage)), (2, " ".join(passage))], "doc_id long, text string"), drop_emptied=True)
    assert [g["doc_id"] for g in gone.collect()] == [1]
    assert substring.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_changed_paragraphs_are_met_as_often_as_stated(spark):
    r = random.Random(9)
    docs = []
    for _ in range(150):
        passage = noise(r, r.choice([50, 53, 60]))
        changed = list(passage)
        changed[len(passage) // 2] = "other"
        for text in (passage, changed):
            docs.append((len(docs), " ".join(noise(r, 30) + text + noise(r, 30))))
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(g["doc_id"] == g["other"] + 1 and g["other"] % 2 == 0 for g in got)
    assert len({g["doc_id"] for g in got}) >= 0.9 * 150


def test_what_the_first_of_a_bucket_does_not_hold(spark):
    r = random.Random(10)
    docs, want = [], set()
    # A notice that the first of all documents holds alone, in passages of two later ones.
    notice = noise(r, 45)
    docs.append((0, " ".join(noise(r, 20) + notice + noise(r, 20))))
    for _ in range(40):
        before = r.randrange(1, 7)
        passage = noise(r, before) + notice + noise(r, 10 - before)
        for _ in range(2):
            docs.append((len(docs), " ".join(noise(r, 20) + passage + noise(r, 20))))
        want.add(len(docs) - 1)
    # The same for few documents, with a changed word.
    small = noise(r, 40)
    docs.append((len(docs), " ".join(noise(r, 20) + small + noise(r, 20))))
    passage = noise(r, 40) + small + noise(r, 40)
    changed = [*passage[:60], "other", *passage[61:]]
    for text in (passage, changed):
        docs.append((len(docs), " ".join(noise(r, 20) + text + noise(r, 20))))
    want.add(len(docs) - 1)
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {g["doc_id"] for g in got} == want and all(g["other"] == g["doc_id"] - 1 for g in got)


def test_inserted_and_deleted_words(spark):
    r = random.Random(12)
    docs, want = [], {}
    for g in range(60):
        passage = noise(r, 62)
        longer = [*passage[:31], "more", *passage[31:]]
        before = noise(r, 30)
        first, second = (passage, longer) if g % 2 else (longer, passage)
        docs.append((len(docs), " ".join(noise(r, 25) + first + noise(r, 30))))
        docs.append((len(docs), " ".join(before + second + noise(r, 30))))
        want[len(docs) - 1] = (30, 30 + len(second), 25)
    got = {g["doc_id"]: (g["start"], g["stop"], g["other_start"]) for g in substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(got.items()) <= set(want.items())
    assert len(got) >= 0.9 * 60


def test_a_passage_inside_another_one_connects_its_documents(spark):
    r = random.Random(13)
    passage = noise(r, 230)
    # Changed words at other places: both are near the passage, but not near each other.
    one = ["x%d" % i if i % 50 == 25 or i == 0 else w for i, w in enumerate(passage[:200])]
    two = ["y%d" % i if i % 50 == 0 else w for i, w in enumerate(passage)]
    docs = [(i, " ".join(noise(r, 20) + text + noise(r, 20))) for i, text in enumerate((one, two, passage))]
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(g["doc_id"], g["other"], g["start"], g["stop"]) for g in got] == [(2, 1, 21, 250)]
    assert got[0]["cluster"] == 0


def brute_exact_passages(docs, least=50):
    """Longest equal runs of words with an earlier document, none inside another."""
    out = {}
    for d, a in docs:
        found = set()
        for o, b in docs:
            before = [0] * (len(b) + 1)
            for i, x in enumerate(a if o < d else []):
                now = [0] + [before[j] + 1 if x == y else 0 for j, y in enumerate(b)]
                found |= {(i + 1 - n, i + 1) for n in set(now) if n >= least}
                before = now
        found = sorted(s for s in found if not any(t[0] <= s[0] and s[1] <= t[1] and s != t for t in found))
        if found:
            out[d] = found
    return out


def test_runs_of_few_words_repeated(spark):
    r = random.Random(14)
    docs = []
    for i in range(24):
        text = noise(r, 7)
        for _ in range(r.choice([1, 2])):
            cycle = r.choice([["w"], ["a", "b"], ["k", "l", "m", "n", "o"]])
            length, start = r.randrange(40, 130), r.randrange(len(cycle))
            text += [cycle[(start + j) % len(cycle)] for j in range(length)] + noise(r, 6)
        docs.append((i, text))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    got, texts = {}, dict(docs)
    for g in substring.repeated_passages(df).collect():
        got.setdefault(g["doc_id"], set()).add((g["start"], g["stop"]))
        n = g["stop"] - g["start"]
        assert texts[g["doc_id"]][g["start"] : g["stop"]] == texts[g["other"]][g["other_start"] : g["other_start"] + n]
    assert {d: sorted(x) for d, x in got.items()} == brute_exact_passages(docs)
