import random

import pytest
from pyspark.sql import functions as F

from textgauge.llm import compression, quality_rules, toxicity

DOCS = "doc_id long, text string"
LABELS = "doc_id long, label int"
BAD = ["idiot", "scum", "moron"]


def corpus(n, seed):
    r = random.Random(seed)
    plain = [f"w{r.randrange(10**6)}" for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        s = [[r.choice(plain) for _ in range(r.randrange(4, 12))] for _ in range(r.randrange(1, 8))]
        bad = r.random() < 0.3
        if bad:
            x = r.choice(s)
            x.insert(r.randrange(len(x)), r.choice(BAD) + r.choice(["", ",", "###"]))
        docs.append((i, " ".join(" ".join(x).capitalize() + "." for x in s)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_finds_documents_and_sentences(spark):
    docs, labels = corpus(500, 1)
    df, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels[:350], LABELS)
    model = toxicity.fit(df, known)
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    right = sum((got[i]["score"] >= 0.7) == bool(y) for i, y in labels[350:])
    assert right >= 147
    texts = dict(docs)
    for i, y in labels[350:]:
        for s in got[i]["toxic_sentences"]:
            assert any(b in texts[i][s["start"] : s["stop"]].lower() for b in BAD)
        assert all(0 <= got[i]["score"] <= 1 for i in got)


def test_toxicity_edges(spark):
    docs, labels = corpus(300, 2)
    known = spark.createDataFrame(labels + [(None, 1), (5, None)], LABELS)
    df = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(df, known)
    odd = spark.createDataFrame([(None, "idiot.", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, " \n. é idiot\n" + "x " * 50000 + "ï scum!", 4)], DOCS + ", score int")
    got = sorted(toxicity.score(odd, model).collect(), key=str)
    assert len(got) == 5
    by = {(r["doc_id"]): r for r in got}
    assert by[None]["score"] > 0.7 and by[1]["score"] == by[2]["score"] < 0.3
    assert len(by[3]["toxic_sentences"]) == 2
    first = by[3]["toxic_sentences"][0]
    assert (first["start"], first["stop"]) == (4, 11)
    empty = spark.createDataFrame([], LABELS)
    assert toxicity.fit(df, empty).leak == pytest.approx(0.01)
    assert toxicity.score(spark.createDataFrame([], DOCS), toxicity.fit(df, empty)).collect() == []
    ones = spark.createDataFrame([(i, 1) for i, _ in docs], LABELS)
    assert toxicity.fit(df, ones).leak == pytest.approx(0.99)


def test_compression_separates_and_has_edges(spark):
    r = random.Random(4)
    good = lambda: " ".join(r.choice(["the", "of", "and", "house", "river", "walks", "green", "slowly"]) for _ in range(120))
    bad = lambda: " ".join(r.choice(["BUY!!", "$$$", "NOW###", "click", "win%%%"]) for _ in range(120))
    docs = [(i, good() if i % 3 else bad()) for i in range(300)]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(None, 0), (7, None)], LABELS)
    model = compression.fit(df, labels)
    got = {x["doc_id"]: x["score"] for x in compression.score(df, model).collect()}
    assert all((got[i] >= 0.7) == (i % 3 > 0) for i in range(200, 300))
    odd = spark.createDataFrame([(None, good()), (1, None), (2, ""), (2, ""), (3, good() * 200)], DOCS + "").withColumn("score", F.lit("x"))
    odd_scores = compression.score(odd, model).collect()
    assert len(odd_scores) == 5 and all(0 <= x["score"] <= 1 for x in odd_scores)
    assert {x["score"] for x in odd_scores if x["doc_id"] in (1, 2)} == {model.prior}
    none = compression.fit(df, spark.createDataFrame([], LABELS))
    assert none.curve is None and compression.score(spark.createDataFrame([], DOCS), none).collect() == []


def brute_statistics(text):
    import re

    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_statistics_are_those_of_brute_force(spark):
    r = random.Random(6)
    texts = [None, "", " \n\t", "a", "é|ü\n\né|ü\n é|ü", "x " * 30, "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h"]
    texts += ["".join(r.choice(["ab ", "c\n", "d\t", "# ", "é ", "\x1c"]) for _ in range(r.randrange(300))) for _ in range(60)]
    texts.append(" ".join(f"t{r.randrange(3000)}" for _ in range(30000)) + " q" * 20)
    rows = list(enumerate(texts)) + [(None, "a b"), (3, "a")]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("clash"))
    got = quality_rules.statistics(df).collect()
    assert sorted((str(g[0]), *g[1:]) for g in got) == sorted((str(i), *brute_statistics(t)) for i, t in rows)
    assert quality_rules.statistics(spark.createDataFrame([], DOCS)).collect() == []


def test_the_decision_list_learns_a_conjunction(spark):
    r = random.Random(9)
    rows = []
    for i in range(3000):
        n, symbols = r.randrange(20, 400), r.randrange(0, 60)
        bad = symbols / n > 0.3 or (n < 60 and r.random() < 0.02)
        rows.append((i, n, n * 5, symbols, 0, 0, None if i % 50 == 0 else int(not bad)))
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, label int"
    df = spark.createDataFrame(rows, schema)
    rules = quality_rules.learn(df)
    assert 1 <= len(rules.rules) <= 3
    judged = quality_rules.judge(df, rules).where("label is not null").select((F.col("kept").cast("int") == F.col("label")).alias("ok"))
    assert judged.where("ok").count() >= 0.97 * judged.count()
    only_good = quality_rules.learn(df.withColumn("label", F.lit(1)))
    assert only_good.rules == [] and only_good.default == 1.0
    assert quality_rules.learn(df.limit(0)).rules == []
