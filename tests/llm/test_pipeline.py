import random

import pytest

import corpus_pipeline
from textgauge.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """A small corpus with planted cases, and what each stage must drop."""
    r = random.Random(11)
    noise = lambda n: [f"q{r.randrange(10**7)}" for _ in range(n)]
    docs, labels, drops = [], [], {"toxicity": set(), "near_dedup": set(), "decontamination": set()}

    def add(words):
        docs.append((len(docs), " ".join(words)))
        return len(docs) - 1

    for _ in range(120):
        i = add(noise(60))
        labels.append((i, 1, 0))
    for k in range(60):
        w = noise(60)
        w[r.randrange(60)] = "vermin"
        i = add(w)
        drops["toxicity"].add(i)
        if k < 45:
            labels.append((i, 1, 1))
    for _ in range(6):
        w = noise(100)
        add(w)
        for copy in (w, w[:50] + ["z"] + w[51:]):
            drops["near_dedup"].add(add(copy))
    passage = noise(70)
    first = add(noise(80) + passage)
    cut = {add(noise(80) + passage + noise(80)): passage for _ in range(4)}
    item = noise(30)
    for _ in range(3):
        drops["decontamination"].add(add(noise(40) + item + noise(40)))
    docs += [(5000, None), (5001, ""), (None, "row without an id")]
    rows = [(i, t, "en", None if (i or 0) % 7 == 0 else f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in docs]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(docs), drops, cut, first


def test_every_stage_takes_its_decisions_and_keeps_the_rest(spark, fixture):
    path, texts, drops, cut, first = fixture
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = dict(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        left = {i: t for i, t in left.items() if i not in drops.get(name, ())}
        if name == "substring_dedup":
            for i, p in cut.items():
                left[i] = left[i].replace(" ".join(p) + " ", "")
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == left, name
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in docs.collect())
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r["doc_id"]: r["size"] for r in mixed} == {i: len((t or "").split()) for i, t in left.items()}


def test_the_whole_pipeline_and_an_empty_corpus(spark, fixture, tmp_path):
    path, texts, drops, *_ = fixture
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, path).collect()}
    assert kept == set(texts) - set().union(*drops.values())
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_query_is_registered_once():
    names = [n for n in queries.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(queries.ORACLE) <= set(names)
