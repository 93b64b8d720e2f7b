"""Text statistics, cleaning, tokens and the feature stages."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textgauge.functions.text import cleaned, stop_words, with_text_stats
from textgauge.operators import features, quality, terms


def texts(spark, values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "doc_id long, text string")


def test_statistics_edge_rows(spark):
    rows = with_text_stats(texts(spark, ["", "  two  words ", "WOW!!! Éé", None])).orderBy("doc_id").collect()
    assert (rows[0].text_length, rows[0].word_count, rows[0].avg_word_length, rows[0].caps_ratio) == (0, 1, 0, 0)
    assert (rows[1].text_length, rows[1].word_count) == (13, 4)
    assert (rows[2].exclamation_count, rows[2].caps_ratio) == (3, 3 / 9)
    assert rows[3].text_length is None


def test_cleaning_matches_the_plain_patterns(spark):
    samples = ["See https://a.b/c?d=1 NOW!", "Tab\tand\nline\r\n  end ", "naïve Ünïcode — test’s", "a b  c\x0bd", "123", ""]
    df = texts(spark, samples)
    plain = F.regexp_replace("text", r"https?://\S+", "")
    plain = F.regexp_replace(plain, r"[^a-zA-Z\s]", "")
    plain = F.trim(F.lower(F.regexp_replace(plain, r"\s+", " ")))
    for r in df.select(cleaned("text").alias("a"), plain.alias("b")).collect():
        assert r.a == r.b


def test_minimum_length_boundary(spark):
    df = texts(spark, ["a" * 99, "a" * 100, None])
    assert [r.doc_id for r in quality.clean_text(df).collect()] == [1]


def test_tokenizer_and_stop_words(spark):
    df = spark.createDataFrame([("the cat sat on the mat",)], ["clean_text"])
    row = features.tokens(df).first()
    assert row.words == ["the", "cat", "sat", "on", "the", "mat"]
    assert "the" not in row.filtered_words and "cat" in row.filtered_words and "mat" in row.filtered_words
    mine = terms.with_content_words(df.withColumnRenamed("clean_text", "text"), stop_words()).first()
    assert mine.words == row.filtered_words


def test_term_counts_equal_group_by(spark):
    df = texts(spark, ["b a b", "c", "", "a a a a"]).withColumn("words", F.filter(F.split("text", " "), lambda w: w != "")).drop("text")
    got = {(r.doc_id, r.term): r.tf for r in terms.term_counts(df).collect()}
    assert got == {(0, "a"): 1, (0, "b"): 2, (1, "c"): 1, (3, "a"): 4}


def test_hashing_dimension_and_buckets(spark):
    words = spark.createDataFrame([(w,) for w in ["share", "exposed", "truth", "ab", "abcd", "abcde"]], ["word"])
    tf = HashingTF(numFeatures=1024, inputCol="filtered_words", outputCol="raw_features")
    for r in features.word_buckets(words, 1024).collect():
        assert r.bucket == tf.indexOf(r.word)
    assert features.hashing_tf(1024).transform(words.select(F.array("word").alias("filtered_words"))).first().raw_features.size == 1024


def test_feature_model_end_to_end_and_saved(spark, tmp_path):
    df = spark.createDataFrame([
        (0, 0, "Officials confirmed the budget"), (1, 1, "SHOCKING truth EXPOSED!!!"), (2, 0, "Researchers published the study"),
    ], "doc_id long, label long, text string")
    model = features.fit_features(df, num_features=256, min_doc_freq=1, min_chars=1)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(df).orderBy("doc_id").collect()
    again = model.transform(df).orderBy("doc_id").collect()
    assert len(out) == 3 and out[0].features.size == 256 + 5 and out[0].tfidf_features.numNonzeros() > 0
    assert [r.features for r in out] == [r.features for r in again]


def test_idf_equals_mllib(spark):
    docs = texts(spark, ["apple pear", "apple", "apple fig fig"]).withColumn("words", F.split("text", " "))
    weights = {r.term: r.idf for r in terms.idf_weights(terms.document_frequency(docs), F.lit(3), 1).collect()}
    from pyspark.ml.feature import IDF
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 14)
    idf = IDF(inputCol="tf", outputCol="x", minDocFreq=1).fit(tf.transform(docs)).idf
    for term, w in weights.items():
        assert abs(idf[tf.indexOf(term)] - w) < 1e-12


def test_naive_bayes_equals_mllib(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    docs = spark.createDataFrame([
        (0, 0, "a b b c"), (1, 0, "a c"), (2, 1, "b d d"), (3, 1, "d"), (4, 0, "c"),
    ], "doc_id long, label int, text string").withColumn("words", F.split("text", " "))
    cv = CountVectorizer(inputCol="words", outputCol="features").fit(docs)
    model = NaiveBayes(smoothing=1.0).fit(cv.transform(docs))
    classes, weights = terms.naive_bayes_terms(docs.drop("text"))
    theta = model.theta.toArray()
    for r in weights.collect():
        j = cv.vocabulary.index(r.term)
        assert abs(theta[0, j] - r.theta0) < 1e-9 and abs(theta[1, j] - r.theta1) < 1e-9
    mine = {r.doc_id: r.prediction for r in terms.naive_bayes_predict(docs, classes, weights).collect()}
    theirs = {r.doc_id: r.prediction for r in model.transform(cv.transform(docs)).collect()}
    assert mine == theirs


def test_first_words_of_a_bucket(spark):
    words = spark.createDataFrame([("d", 1), ("a", 1), ("c", 1), ("b", 1), ("x", 2)], "word string, bucket int")
    assert {r.bucket: r.words for r in terms.words_per_bucket(words).collect()} == {1: "a, b, c", 2: "x"}


def test_stop_words_of_the_sql_are_sparks(spark):
    from textgauge.plans.oracle import STOP_WORDS
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert Tokenizer(inputCol="t", outputCol="w").transform(spark.createDataFrame([("A b",)], ["t"])).first().w == ["a", "b"]


def test_stat_slots_of_the_vector(spark):
    df = spark.createDataFrame([(0, "Hello WORLD!")], "doc_id long, text string")
    out = features.fit_features(df, num_features=64, min_doc_freq=1, min_chars=1).transform(df)
    assert out.select(vector_to_array("features").alias("v")).first().v[-5:] == [12.0, 2.0, 6.0, 0.5, 1.0]


def test_naive_bayes_folds_equal_a_model_per_fold(spark):
    rows = [(i, i % 3 % 2, i % 4, [f"w{(i * k) % 11}" for k in range(i % 6)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, label int, fold int, words array<string>")
    got = terms.naive_bayes_folds(docs, 4, [0.5, 1.0])
    # A model per fold and smoothing reads the documents again for each; here once for the counts and once for the answers.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
    got = {r.doc_id: (r.label, r.fold, r.margins) for r in got.collect()}
    assert len(got) == 60
    for k in range(4):
        for j, smoothing in enumerate((0.5, 1.0)):
            classes, weights = terms.naive_bayes_terms(docs.where(F.col("fold") != k), smoothing)
            for r in terms.naive_bayes_predict(docs.where(F.col("fold") == k), classes, weights).collect():
                label, fold, margins = got[r.doc_id]
                assert (label, fold) == (r.label, k) and abs(margins[j] - r.margin) < 1e-9


def test_statistics_of_raw_texts_are_made_once(spark, capsys):
    """Null, empty and short texts have no features; no filter repeats the statistics."""
    long = "Some WORDS of a text that is long enough to be kept by the cleaning stage, whatever it says! " * 2
    rows = [(1, long), (2, long.upper()), (3, None), (4, ""), (5, "short"), (6, " \n" * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = features.fit_features(docs, num_features=64, min_doc_freq=0).transform(docs).select("doc_id", "text_stats", "features")
    capsys.readouterr()
    made.explain()
    assert capsys.readouterr().out.count("[^A-Z]+") == 1
    got = {r.doc_id: r for r in made.collect()}
    assert set(got) == {1, 2}
    assert got[1].text_stats[0] == len(long) and got[2].text_stats[3] > got[1].text_stats[3] and got[1].features.size == 64 + 5
