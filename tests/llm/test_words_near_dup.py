import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textgauge.llm import near_dup
from textgauge.llm.components import connected_components
from textgauge.llm.words import pieces

SCHEMA = "doc_id long, text string"


def found_words(texts):
    out = []
    for p in pieces(pa.array(texts, pa.string())):
        out += [(p.first_row + o, bytes(p.data[a:b]).decode()) for o, a, b in zip(p.owner, p.starts, p.ends)]
    return out


def test_words_are_those_of_the_pattern():
    texts = ["a b", None, "", " \t", "x y\x1cz  é\n", "one", "two", "\x0b\x0cq\r"]
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert found_words(texts) == want
    assert found_words([]) == []


def test_equal_words_have_equal_hashes_wherever_they_are():
    (p,) = pieces(pa.array(["the Cat the", "cat", "THE, cat!"]))
    plain, low, (core, lead) = p.word_hashes(), p.word_hashes(lower=True), p.core_hashes((2,))
    assert plain[0] == plain[2] and plain[1] != plain[3]
    assert low[1] == low[3]
    assert core[4] == core[0] and core[5] == core[3]
    assert lead[0] == lead[4] != lead[1] and lead[1] == lead[3]
    assert p.sentence_of().tolist() == [0, 0, 0, 1, 2, 2]


def brute(rows, k, percent, lower=True):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w] if lower else w
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and up[a] != up[b]:
                    up[a] = up[b] = min(up[a], up[b])
                    changed = True
    return {i: (len(sets[i]), up[i], up[i] == i) for i in sets}


def variants(n, length, changes, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(changes)):
            w[r.randrange(length)] = f"v{r.randrange(400)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [192, 8])
def test_links_are_those_of_brute_force(spark, block):
    texts = variants(60, 60, 9, 1) + variants(30, 12, 3, 2) + variants(20, 7, 2, 3) + [None, "", "a", "A", "a b", "a b", "c b a"] * 2
    rows = list(enumerate(texts))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), near_dup.Rule(block=block)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 3, 85)


def test_null_ids_repeated_rows_extra_columns_and_empty_tables(spark):
    rows = [(None, "x y z", 1), (None, "x y z", 1), (4, "x y z", 2), (4, "x y z", 2), (3, "x y z", 3)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA + ", component_id int")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (0, 0, True), (3, 3, True), (4, 3, False), (4, 3, False)]
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registers_agree_as_often_as_sets_do():
    r = np.random.default_rng(5)
    for size in (6, 40, 900):
        pool = r.integers(0, 1 << 63, size + size // 4, dtype=np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size // 4 :])
        s, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        n = 4096
        x, y = near_dup.registers_of(s, first, n)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((x == y).mean() - true) < 5 * np.sqrt(0.25 / min(n, size)) + 0.02


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(30)}}
