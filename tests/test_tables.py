"""Schemas, duplicates, splits, ranks, perturbation and sinks."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textgauge.operators import dedup, perturb, quality, ranking, splits
from textgauge.sources import crawl, schema, scratch, sinks


@pytest.fixture(scope="module")
def labelled(spark):
    """Nine rows in ten have label 1, so one class dominates."""
    return spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 != 0).cast("int").alias("label")).persist()


def test_crawl_schema():
    assert len(schema.CRAWL_SCHEMA) == 5
    assert {f.name for f in schema.CRAWL_SCHEMA if not f.nullable} == {"url", "crawl_date", "text"}


def test_valid_record_and_bad_type(spark):
    good = [("https://a.b", "2024-01-01", 10, "eng", "text")]
    assert spark.createDataFrame(good, schema.CRAWL_SCHEMA).count() == 1
    with pytest.raises(PySparkException):
        spark.createDataFrame([("https://a.b", "2024-01-01", "ten", "eng", "text")], schema.CRAWL_SCHEMA).collect()


def test_strict_and_lenient_schema(spark):
    cols = "url string, crawl_date string, content_length string, language string, text string"
    df = spark.createDataFrame([("u", "d", "5", "en", "t"), ("u", "d", "five", "en", "t"), (None, "d", "5", "en", None)], cols)
    good, bad = schema.good_and_quarantine(df, schema.CRAWL_SCHEMA)
    assert good.count() == 1 and {tuple(r.violations) for r in bad.collect()} == {("content_length:type",), ("url:null", "text:null")}
    assert schema.enforce(df.limit(1), schema.CRAWL_SCHEMA).schema == schema.CRAWL_SCHEMA
    for row in (1, 2):
        broken = spark.createDataFrame([df.collect()[row]], df.schema)
        with pytest.raises(PySparkException):
            schema.enforce(broken, schema.CRAWL_SCHEMA).collect()


def test_dedup_is_deterministic(spark):
    rows = [(5, "x", 1), (2, "x", 0), (9, "y", 1)] + [(i, "copy", i % 2) for i in range(100, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    for parts in (1, 7):
        kept = dedup.drop_duplicate_texts(df.repartition(parts)).collect()
        assert sorted((r.doc_id, r.label) for r in kept) == [(2, 0), (9, 1), (100, 0)]


def test_null_audit_and_funnel(spark):
    df = spark.createDataFrame([("a" * 120, " ", 1), ("a" * 120, None, None), ("1" * 120, "s", 0), (None, "s", 0), ("short", "s", 0)], "text string, source string, label int")
    assert {r.column_name: r.blank_rows for r in quality.null_audit(df, ["text", "source", "label"]).collect()} == {"text": 1, "source": 2, "label": 1}
    assert [r.rows for r in quality.quality_funnel(df).orderBy("step").collect()] == [5, 4, 3, 2, 1]


@pytest.mark.parametrize("bits", [2, 10])
def test_rank_and_cuts_equal_a_plain_sort(labelled, bits):
    ranked = ranking.grouped_rank(labelled, ["label"], 42, bits=bits, count_col="n").toPandas()
    keyed = labelled.withColumn("h", splits.hash32(42, "doc_id")).toPandas().sort_values(["label", "h", "doc_id"])
    keyed["want"] = keyed.groupby("label").cumcount() + 1
    both = ranked.merge(keyed, on="doc_id")
    assert (both["rank"] == both["want"]).all() and set(ranked.n) == {300, 2700}
    joined, within = ranking.with_exact_cuts(labelled, "label", (0, 1), 42, {"t": lambda n: F.floor(n * 0.31)}, bits=bits)
    chosen = {r.doc_id for r in joined.where(within["t"]).collect()}
    assert chosen == set(keyed[keyed.want <= keyed.label.map({0: 93, 1: 837})].doc_id)


def test_splits(labelled):
    for split in (splits.hash_split, splits.stratified_split, splits.stratified_split_exact):
        a = split(labelled).orderBy("doc_id").collect()
        assert a == split(labelled.repartition(5)).orderBy("doc_id").collect() and len(a) == 3000
    exact = splits.stratified_split_exact(labelled).groupBy("label", "split").count().collect()
    assert {(r.label, r.split): r["count"] for r in exact} == {
        (0, "train"): 210, (0, "validation"): 45, (0, "test"): 45, (1, "train"): 1890, (1, "validation"): 405, (1, "test"): 405}
    empty = splits.split_summary(splits.hash_split(labelled).where("split = 'train'")).collect()
    assert {r.split: r.positive_ratio for r in empty}["test"] == 0.0


def test_folds_and_samples(labelled):
    sizes = [r["count"] for r in splits.fold_assignment(labelled, 5).groupBy("label", "fold_stratified").count().collect()]
    assert sorted(sizes) == [60] * 5 + [540] * 5
    quarter = {r.doc_id for r in splits.sample_fraction(labelled, 0.25).collect()}
    half = {r.doc_id for r in splits.sample_fraction(labelled, 0.5).collect()}
    assert quarter < half and 1300 < len(half) < 1700
    assert sorted(r.position for r in splits.seeded_shuffle(labelled).collect()) == list(range(1, 3001))
    assert splits.limit_sample(labelled, 10).count() == 10
    balanced = {r.label: r["count"] for r in splits.undersample(labelled).groupBy("label").count().collect()}
    assert balanced[0] == 300 and 240 < balanced[1] < 360
    assert {r.label: r.weight for r in splits.class_weights(labelled).collect()} == {0: 5.0, 1: 3000 / 5400}


def test_label_noise_budget(labelled):
    flipped = perturb.flip_labels(labelled)
    assert {r.label: r["count"] for r in flipped.where("flipped").groupBy("label").count().collect()} == {1: 15, 0: 135}
    df = labelled.withColumn("text", F.concat(F.lit("w1 w2 w3 w4 of "), F.col("doc_id").cast("string")))
    mixed = perturb.cross_contaminate(df).where("donor_id is not null").collect()
    assert len(mixed) == 150 and all(r.text == f"w1 w2 w3 w1 w2 w3 w4 of {r.donor_id}" for r in mixed)
    assert all((r.donor_id % 10 != 0) != bool(r.label) for r in mixed)
    touched = {r.doc_id for r in mixed} & {r.doc_id for r in flipped.where("flipped").collect()}
    assert not touched


def test_text_noise(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("One. Two. Three.").alias("text"))
    noisy = [r.text for r in perturb.insert_noise(df).collect() if r.text != "One. Two. Three."]
    assert 130 < len(noisy) < 230
    phrases = {p.capitalize() + "." for p in perturb.NOISE_PHRASES}
    for t in noisy:
        for p in phrases:
            t = t.replace(p, "")
        assert t.split() == ["One.", "Two.", "Three."]
    neutral = [r.text for r in perturb.append_neutral(df).collect() if r.text != "One. Two. Three."]
    assert 60 < len(neutral) < 140 and all(t.endswith(tuple(perturb.NEUTRAL_SENTENCES)) for t in neutral)


def test_weak_labels_match_subdomains(spark):
    pages = spark.createDataFrame([(1, "https://a.good.org/x"), (2, "http://bad.good.org:80/"), (3, "https://notgood.org/"), (4, "ftp://x")], "page_id long, url string")
    got = {r.page_id: r.label for r in crawl.weak_labels(pages, {"good.org": 0, "bad.good.org": 1}).collect()}
    assert got == {1: 0, 2: 1, 3: None, 4: None}


def test_csv_survives_quotes_and_breaks(spark, tmp_path):
    rows = [(1, 'a "quoted", text'), (2, "two\nlines"), (3, "back\\slash \\\" end"), (4, "plain")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sorted((r.doc_id, r.text) for r in sinks.read_csv(spark, str(tmp_path / "c"), df.schema).collect()) == rows


def test_partitioned_table_prunes(spark, tmp_path, labelled):
    path = str(tmp_path / "p")
    sinks.write_partitioned(labelled, path, "label")
    one = spark.read.parquet(path).where("label = 0")
    assert one.count() == 300 and "PartitionFilters: [isnotnull(label" in one._jdf.queryExecution().toString()


def test_scratch_comes_from_the_session(spark):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
