"""The registered queries: each reads the given tables and returns a table.

Every function takes ``(spark, sf_dir)``.  Doubles in results are rounded to
six digits so that they can be compared with another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import bucket
from ..functions.text import STAT_COLUMNS, stop_words, with_text_stats
from ..operators import (
    dedup,
    evaluate,
    features,
    forest,
    importance,
    model_tables,
    perturb,
    quality,
    reports,
    roc,
    search,
    significance,
    splits,
    terms,
    train,
)
from ..operators.predictions import (
    PRICE_RULES,
    TEXT_RULES,
    document_predictions,
    document_rules,
    lineitem_predictions,
    lineitem_rules,
)
from ..operators.reports import rounded
from ..sources import crawl, observed, scratch, sinks, tables
from ..sources import schema as schemas

QUERIES = {}
FOLDS = 5


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _clean_docs(spark, sf_dir) -> DataFrame:
    """(doc_id, text) of all documents after cleaning."""
    return quality.clean_text(tables.texts(spark, sf_dir))


def _words(spark, sf_dir) -> DataFrame:
    return terms.with_content_words(_clean_docs(spark, sf_dir), stop_words())


def _labelled_words(spark, sf_dir) -> DataFrame:
    """Tokens of the labelled documents, written once: every use after this
    reads columns of a table instead of cleaning the texts again."""
    docs = _words(spark, sf_dir).join(tables.labels(spark, sf_dir), "doc_id")
    return scratch.materialise(docs, "labelled-words")


def _labelled_ids(spark, sf_dir) -> DataFrame:
    return tables.labelled_documents(spark, sf_dir, ["doc_id"])


def _labelled_stats(spark, sf_dir) -> DataFrame:
    """Statistics next to the scan, so no text takes part in the join."""
    stats = with_text_stats(tables.texts(spark, sf_dir)).drop("text")
    return stats.join(tables.labels(spark, sf_dir), "doc_id")


# --- sources and sinks ---------------------------------------------------------

@query
def schema_enforced_articles(spark, sf_dir):
    arts = tables.articles(spark, sf_dir)
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), *schemas.ARTICLE_SCHEMA.fields])
    return schemas.enforce(arts, schema)


@query
def schema_violations(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    dirty = docs.select(
        F.when(F.col("doc_id") % 11 != 0, F.concat_ws("/", "source", "doc_id")).alias("url"),
        F.when(F.col("lang") != "de", "2024-01-01").alias("crawl_date"),
        F.when(F.col("doc_id") % 7 == 0, "n/a").otherwise(F.length("text").cast("string")).alias("content_length"),
        F.col("lang").alias("language"),
        F.when(F.length("text") >= 100, F.col("text")).alias("text"),
    )
    return schemas.violation_counts(dirty, schemas.CRAWL_SCHEMA)


@query
def scan_articles(spark, sf_dir):
    return tables.documents(spark, sf_dir, ["doc_id", "text", "lang", "source", "n_chars"])


@query
def scan_projected(spark, sf_dir):
    return tables.documents(spark, sf_dir, ["doc_id", "n_chars"]).where(F.col("n_chars") >= 100)


@query
def partitioned_roundtrip(spark, sf_dir):
    path = scratch.scratch_path(spark, "articles")
    sinks.write_partitioned(quality.clean_articles(tables.articles(spark, sf_dir)), path, "subject")
    return spark.read.parquet(path).groupBy("subject").agg(F.count("*").alias("rows"), F.sum("label").alias("positives"))


@query
def split_roundtrip(spark, sf_dir):
    path = scratch.scratch_path(spark, "splits")
    sinks.write_splits(splits.hash_split(_labelled_ids(spark, sf_dir)), path)
    return train.union_all([
        sinks.read_split(spark, path, s).withColumn("split", F.lit(s)) for s in splits.SPLIT_NAMES])


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch.scratch_path(spark, "raw-csv")
    sinks.write_csv(tables.labelled_documents(spark, sf_dir, ["doc_id", "text"]), path, by="label")
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("label", "integer")
    return sinks.read_csv(spark, path, schema)


@query
def report_export_roundtrip(spark, sf_dir):
    report = rounded(evaluate.classification_metrics(document_predictions(spark, sf_dir), ["model"]), 4)
    path = scratch.scratch_path(spark, "report")
    sinks.write_report(report, path)
    return sinks.read_report(spark, path, report.schema)


@query
def repartition_balance(spark, sf_dir):
    """Rows of the table, partitions with rows, and whether none holds more
    than twice the mean, after a spread over eight partitions."""
    sizes = sinks.partition_sizes(tables.documents(spark, sf_dir, ["doc_id"]), 8)
    return sizes.agg(F.sum("rows").alias("rows"), F.count("*").alias("partitions"), (F.max("rows") <= 2 * F.avg("rows")).alias("balanced"))


# --- projections ---------------------------------------------------------------

@query
def text_statistics(spark, sf_dir):
    return rounded(with_text_stats(tables.texts(spark, sf_dir)).drop("text"))


@query
def text_stats_transformer(spark, sf_dir):
    stage = features.TextStatistics(inputCol="text")
    return rounded(stage.transform(tables.texts(spark, sf_dir)).drop("text"))


@query
def clean_text(spark, sf_dir):
    return _clean_docs(spark, sf_dir)


@query
def label_names(spark, sf_dir):
    return tables.labels(spark, sf_dir).withColumn("label_name", quality.label_name())


@query
def fill_defaults(spark, sf_dir):
    return quality.fill_defaults(tables.raw_articles(spark, sf_dir)).drop("text")


@query
def text_stats_by_class(spark, sf_dir):
    return rounded(quality.stats_by_class(_labelled_stats(spark, sf_dir)))


@query
def text_stats_summary(spark, sf_dir):
    return rounded(quality.stats_summary(_labelled_stats(spark, sf_dir)))


# --- filters, duplicates, set operations -----------------------------------------

@query
def clean_articles(spark, sf_dir):
    """The kept ids are found from digests next to the scan, the labels join
    numbers only, and a text moves once."""
    docs = tables.documents(spark, sf_dir)
    kept = docs.where(F.length("text") >= quality.MIN_CHARS).select("doc_id", F.sha2("text", 256).alias("digest"))
    kept = kept.join(tables.labels(spark, sf_dir), "doc_id").groupBy("digest").agg(F.min_by("label", "doc_id").alias("label"), F.min("doc_id").alias("doc_id"))
    return quality.fill_defaults(tables.as_articles(docs.join(kept.select("doc_id", "label"), "doc_id")))


@query
def dedup_text(spark, sf_dir):
    return dedup.drop_duplicate_texts(tables.documents(spark, sf_dir)).drop("text")


@query
def split_subtract(spark, sf_dir):
    ids = _labelled_ids(spark, sf_dir)
    chosen = splits.stratified_split(ids).where(F.col("split") == "train")
    return dedup.subtract_rows(ids, chosen)


@query
def distinct_subjects(spark, sf_dir):
    return quality.distinct_values(tables.documents(spark, sf_dir, ["lang"]), "lang")


@query
def union_classes(spark, sf_dir):
    arts = tables.labelled_documents(spark, sf_dir, ["doc_id", "lang", "source"])
    by_class = {name: arts.where(F.col("label") == value) for value, name in tables.LABEL_NAMES.items()}
    # Rows of another or no class are part of the union too.
    by_class["Unknown"] = arts.where(~F.coalesce(F.col("label").isin(list(tables.LABEL_NAMES)), F.lit(False)))
    return reports.stack(by_class, "label_name")


@query
def seeded_shuffle(spark, sf_dir):
    return splits.seeded_shuffle(tables.documents(spark, sf_dir, ["doc_id"]))


@query
def limit_sample(spark, sf_dir):
    return splits.limit_sample(tables.documents(spark, sf_dir, ["doc_id", "lang"]), 500)


# --- audits and aggregates -------------------------------------------------------

@query
def row_counts(spark, sf_dir):
    return quality.row_counts(tables.documents(spark, sf_dir, ["doc_id"]))


@query
def class_distribution(spark, sf_dir):
    return quality.class_distribution(_labelled_ids(spark, sf_dir))


@query
def class_imbalance(spark, sf_dir):
    return rounded(quality.class_imbalance(_labelled_ids(spark, sf_dir)))


@query
def null_audit(spark, sf_dir):
    cols = ["title", "text", "subject", "date", "source", "label"]
    return quality.null_audit(tables.raw_articles(spark, sf_dir), cols)


@query
def quality_funnel(spark, sf_dir):
    return quality.quality_funnel(tables.texts(spark, sf_dir).select("text"))


@query
def funnel_while_writing(spark, sf_dir):
    """The funnel counted by the job that writes the cleaned texts."""
    watch = observed.Observed()
    watch.write(quality.cleaned_and_counted(tables.texts(spark, sf_dir), watch), scratch.scratch_path(spark, "cleaned"))
    return watch.funnel(spark)


@query
def splits_while_writing(spark, sf_dir):
    """The split summary counted by the job that writes the splits."""
    watch = observed.Observed()
    table = watch.at(splits.hash_split(_labelled_ids(spark, sf_dir)), "splits", **splits.split_metrics())
    watch.write(table, scratch.scratch_path(spark, "splits"), by="split")
    (_, m), = watch.metrics()
    rows = [(s, m[f"{s}_rows"], m[f"{s}_positives"], m[f"{s}_positives"] / max(m[f"{s}_rows"], 1)) for s in splits.SPLIT_NAMES]
    return rounded(spark.createDataFrame(rows, "split string, rows long, positives long, positive_ratio double"))


@query
def data_quality_summary(spark, sf_dir):
    return quality.data_quality_summary(tables.raw_articles(spark, sf_dir))


# --- splits and folds -------------------------------------------------------------

@query
def hash_split(spark, sf_dir):
    return splits.hash_split(tables.documents(spark, sf_dir, ["doc_id"]))


@query
def stratified_split(spark, sf_dir):
    return splits.stratified_split(_labelled_ids(spark, sf_dir))


@query
def stratified_split_exact(spark, sf_dir):
    return splits.stratified_split_exact(_labelled_ids(spark, sf_dir))


@query
def split_summary(spark, sf_dir):
    return rounded(splits.split_summary(splits.hash_split(_labelled_ids(spark, sf_dir))))


@query
def fold_assignment(spark, sf_dir):
    return splits.fold_assignment(_labelled_ids(spark, sf_dir))


@query
def fraction_samples(spark, sf_dir):
    return splits.smallest_fraction(tables.documents(spark, sf_dir, ["doc_id"]))


@query
def class_weights(spark, sf_dir):
    return rounded(splits.with_class_weights(_labelled_ids(spark, sf_dir)))


@query
def undersample(spark, sf_dir):
    return splits.undersample(_labelled_ids(spark, sf_dir))


# --- evaluation ---------------------------------------------------------------------

@query
def classification_metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(document_predictions(spark, sf_dir), ["model"]))


@query
def confusion_report(spark, sf_dir):
    cells = evaluate.confusion(document_predictions(spark, sf_dir), ["model"])
    return rounded(evaluate.with_metrics(cells).select("model", *evaluate.CELLS, "accuracy"), 4)


@query
def roc_curve(spark, sf_dir):
    return rounded(roc.roc_curve(document_predictions(spark, sf_dir), ["model"]))


@query
def auc_by_model(spark, sf_dir):
    return rounded(roc.area_under_roc(document_predictions(spark, sf_dir), ["model"]))


@query
def lineitem_metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(lineitem_predictions(spark, sf_dir), ["model"]))


def _lineitem_rows(spark, sf_dir):
    """Rows of ``lineitem_predictions``, from the footers of the files."""
    return tables.table(spark, sf_dir, "lineitem").count() * len(PRICE_RULES)


@query
def lineitem_roc_curve(spark, sf_dir):
    return rounded(roc.roc_curve(lineitem_predictions(spark, sf_dir), ["model"], rows=_lineitem_rows(spark, sf_dir)))


@query
def lineitem_roc_sketch(spark, sf_dir):
    """The curve of bounded size next to the exact one: points, the largest
    deviation of a rate and that of the area, against their bounds."""
    rows = lineitem_predictions(spark, sf_dir).select("model", "label", "score")
    curve = scratch.materialise(roc.bounded_roc_curve(rows, ["model"]), "roc-sketch")
    found = roc.curve_deviation(rows, curve, ["model"], _lineitem_rows(spark, sf_dir))
    # Several hundred ranks are asked for: some go beyond what 99 of 100 keep.
    bound = F.lit(2 * roc.sketch_error())
    return found.select(
        "model", (F.col("points") <= roc.POINTS).alias("bounded"), (F.col("off") <= bound).alias("rates_within"),
        (F.abs(F.col("area") - F.col("exact_area")) <= bound).alias("area_within"))


@query
def lineitem_auc(spark, sf_dir):
    return rounded(roc.area_under_roc(lineitem_predictions(spark, sf_dir), ["model"], rows=_lineitem_rows(spark, sf_dir)))


@query
def lineitem_mcnemar(spark, sf_dir):
    flags = significance.right_flags(lineitem_rules(spark, sf_dir), PRICE_RULES)
    return rounded(significance.mcnemar_test(significance.mcnemar_counts(flags, PRICE_RULES)))


@query
def mcnemar_pairs(spark, sf_dir):
    flags = significance.align(document_predictions(spark, sf_dir), TEXT_RULES)
    return significance.mcnemar_counts(flags, TEXT_RULES)


@query
def mcnemar_test(spark, sf_dir):
    return rounded(significance.mcnemar_test(mcnemar_pairs(spark, sf_dir)))


@query
def bootstrap_ci(spark, sf_dir):
    replicates = significance.poisson_replicates(document_rules(spark, sf_dir), TEXT_RULES)
    return rounded(significance.interval_report(replicates))


@query
def bootstrap_ci_multinomial(spark, sf_dir):
    replicates = significance.multinomial_replicates(lineitem_predictions(spark, sf_dir))
    return rounded(significance.interval_report(replicates), 4)


def _rule_folds(spark, sf_dir):
    return document_predictions(spark, sf_dir).withColumn("fold", bucket(42, FOLDS, "row_id").cast("int"))


@query
def cv_summary(spark, sf_dir):
    per_fold = evaluate.evaluate(_rule_folds(spark, sf_dir), ["model", "fold"])
    return rounded(evaluate.fold_summary(per_fold))


@query
def cv_stability(spark, sf_dir):
    per_fold = evaluate.classification_metrics(_rule_folds(spark, sf_dir), ["model", "fold"])
    std = per_fold.groupBy("model").agg(F.stddev_pop("f1_weighted").alias("std_f1"))
    return rounded(std.withColumn("stability", evaluate.stability(F.col("std_f1"))))


LENGTH_GRID = [100, 250, 500, 1000, 2000]


@query
def best_grid_point(spark, sf_dir):
    """Length limits as a grid: the F1 of each limit, and the best one."""
    docs = tables.documents(spark, sf_dir, ["doc_id", "text"]).select("doc_id", F.length("text").alias("n"))
    scored = docs.join(tables.labels(spark, sf_dir), "doc_id")
    points = F.array(*[F.struct(F.lit(i).alias("grid_index"), (F.col("n") >= limit).cast("double").alias("prediction"))
                       for i, limit in enumerate(LENGTH_GRID)])
    grid = scored.select(F.lit("len_rule").alias("model"), "label", F.inline(points))
    per_point = rounded(evaluate.classification_metrics(grid, ["model", "grid_index"]))
    return evaluate.best_of_grid(per_point, "f1_weighted")


# --- reports ------------------------------------------------------------------------

def _metrics_of_split(spark, sf_dir, split):
    """Report rows of one split; the split is a hash of the row id, so the
    other rows are dropped before anything is aggregated."""
    in_split = splits.hash_split(document_predictions(spark, sf_dir), id_col="row_id").where(F.col("split") == split)
    return evaluate.classification_metrics(in_split.drop("split"), ["model"])


def _run_log(spark, sf_dir):
    """Raw timing events read as scaling runs."""
    ev = tables.table(spark, sf_dir, "events", ["event_type", "user_id", "value"])
    slot = F.col("user_id") % 4
    return ev.select(
        F.when(F.col("event_type").isin("view", "click", "purchase"), "strong_scaling").otherwise("weak_scaling").alias("experiment"),
        F.col("event_type").alias("profile"),
        (slot + 1).cast("int").alias("executors"),
        ((slot + 1) * 0.25).cast("double").alias("data_fraction"),
        F.col("value").alias("train_time_s"),
    )


@query
def metrics_by_split(spark, sf_dir):
    validation = _metrics_of_split(spark, sf_dir, "validation")
    test = _metrics_of_split(spark, sf_dir, "test")
    return rounded(reports.stack({"validation": validation, "test": test}, "split"))


@query
def compare_runs(spark, sf_dir):
    names = list(zip(TEXT_RULES, ["base_len", "base_word", "base_caps"], ["view", "click", "purchase"]))
    mapping = spark.createDataFrame(names, "Algorithm string, baseline string, timing string")
    baseline_name = F.concat(F.lit("base_"), F.substring_index("model", "_", 1))
    run_a = _metrics_of_split(spark, sf_dir, "validation")
    run_b = _metrics_of_split(spark, sf_dir, "test").withColumn("model", baseline_name)
    times = _run_log(spark, sf_dir).groupBy("profile").agg(F.avg("train_time_s").alias("train_time_s"))
    return rounded(reports.compare_runs(run_a, run_b, times, mapping))


@query
def scaling_report(spark, sf_dir):
    return rounded(reports.scaling_report(_run_log(spark, sf_dir)))


@query
def scaling_combined(spark, sf_dir):
    return rounded(reports.scaling_combined(_run_log(spark, sf_dir)))


# --- terms ----------------------------------------------------------------------------

def _mllib_tokens(spark, sf_dir):
    return features.tokens(_clean_docs(spark, sf_dir).withColumnRenamed("text", "clean_text"))


@query
def tokenize(spark, sf_dir):
    t = features.tokenizer().transform(_clean_docs(spark, sf_dir).withColumnRenamed("text", "clean_text"))
    return t.select("doc_id", F.size("words").alias("n_tokens"), F.array_join("words", "|").alias("tokens"))


@query
def remove_stopwords(spark, sf_dir):
    t = _mllib_tokens(spark, sf_dir)
    return t.select("doc_id", F.size("filtered_words").alias("n_tokens"), F.array_join("filtered_words", "|").alias("tokens"))


@query
def term_frequency(spark, sf_dir):
    return terms.term_counts(_words(spark, sf_dir))


@query
def document_frequency(spark, sf_dir):
    return terms.document_frequency(_words(spark, sf_dir), min_doc_freq=terms.MIN_DOC_FREQ)


@query
def idf_weights(spark, sf_dir):
    words = scratch.materialise(_words(spark, sf_dir), "words")
    return rounded(terms.idf_weights(terms.document_frequency(words), terms.count_scalar(words)))


@query
def tfidf(spark, sf_dir):
    words = scratch.materialise(_words(spark, sf_dir), "words")
    return rounded(terms.tfidf(words, terms.count_scalar(words)))


@query
def top_terms(spark, sf_dir):
    """Terms that most favour class 1 by the naive Bayes weights."""
    _, weights = terms.naive_bayes_terms(_labelled_words(spark, sf_dir))
    gain = rounded(weights.select("term", (F.col("theta1") - F.col("theta0")).alias("weight")))
    return terms.top_terms(gain, 20)


@query
def vocabulary(spark, sf_dir):
    return terms.vocabulary(_clean_docs(spark, sf_dir), stop_words())


@query
def bucket_words(spark, sf_dir):
    words = terms.vocabulary(_clean_docs(spark, sf_dir), stop_words()).select("word")
    return terms.words_per_bucket(terms.hashed_words(words, 1024))


@query
def word_buckets(spark, sf_dir):
    words = terms.vocabulary(_clean_docs(spark, sf_dir), stop_words()).select("word")
    return features.word_buckets(words)


@query
def naive_bayes_params(spark, sf_dir):
    _, weights = terms.naive_bayes_terms(_labelled_words(spark, sf_dir))
    return rounded(weights)


@query
def naive_bayes_predict(spark, sf_dir):
    docs = _labelled_words(spark, sf_dir)
    classes, weights = terms.naive_bayes_terms(docs)
    return rounded(terms.naive_bayes_predict(docs, classes, weights))


# --- perturbation ------------------------------------------------------------------------

@query
def label_flip(spark, sf_dir):
    return perturb.flip_labels(_labelled_ids(spark, sf_dir))


@query
def cross_contaminate(spark, sf_dir):
    return perturb.cross_contaminate(tables.labelled_documents(spark, sf_dir, ["doc_id", "text"]))


@query
def append_neutral(spark, sf_dir):
    return perturb.append_neutral(tables.documents(spark, sf_dir, ["doc_id", "text"]))


@query
def insert_noise(spark, sf_dir):
    return perturb.insert_noise(tables.documents(spark, sf_dir, ["doc_id", "text"]))


# --- crawl -----------------------------------------------------------------------------------

# The curated list for the test pages.
DOMAINS = {"cheap-pills.example.com": 1, "casino-win.example.com": 1, "spam-farm.example.org": 1,
           "example.net": 0, "thther.example.org": 0}


@query
def crawl_articles(spark, sf_dir):
    return crawl.crawl_articles(tables.table(spark, sf_dir, "pages"))


@query
def weak_labels(spark, sf_dir):
    return crawl.weak_labels(tables.table(spark, sf_dir, "pages", ["page_id", "url"]), DOMAINS)


@query
def labelled_documents(spark, sf_dir):
    return tables.labelled_documents(spark, sf_dir, ["doc_id", "lang", "source"])


# --- MLlib: features ----------------------------------------------------------------------------

@query
def hashing_tf(spark, sf_dir):
    hashed = features.hashing_tf().transform(_mllib_tokens(spark, sf_dir)).select("doc_id", "raw_features")
    return features.sparse_parts(hashed, "raw_features").select("doc_id", "vector_size", F.col("total").alias("total_terms"))


@query
def hashing_tf_buckets(spark, sf_dir):
    """The stored entries of the hashed term frequencies, a row each."""
    hashed = features.hashing_tf().transform(_mllib_tokens(spark, sf_dir)).select("doc_id", "raw_features")
    return features.sparse_entries(hashed, "raw_features", "bucket", "tf")


def _raw_docs(spark, sf_dir):
    return tables.texts(spark, sf_dir)


def _features(spark, sf_dir):
    docs = scratch.materialise(features.prepared(_raw_docs(spark, sf_dir)), "prepared")
    return features.fit_prepared(docs).transform(docs)


@query
def tfidf_features(spark, sf_dir):
    out = _features(spark, sf_dir).select("doc_id", "tfidf_features")
    return rounded(features.sparse_parts(out, "tfidf_features"))


@query
def features_assembled(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    out = _features(spark, sf_dir)
    v = F.unwrap_udt("features")
    size = F.coalesce(v["size"], F.size(v["values"]))
    stats = vector_to_array("text_stats")
    return rounded(out.select("doc_id", size.alias("vector_size"), *[stats[i].alias(c) for i, c in enumerate(STAT_COLUMNS)]))


@query
def feature_model_transform(spark, sf_dir):
    """Save the fitted feature model, load it, and score raw text with it."""
    from pyspark.ml import PipelineModel

    docs = _raw_docs(spark, sf_dir)
    path = scratch.scratch_path(spark, "feature-model")
    model = features.fit_features(docs)
    model.write().overwrite().save(path)
    # Both models in one pass over the texts.
    first = model.transform(docs).select("doc_id", "text", F.col("features").alias("kept"))
    both = PipelineModel.load(path).transform(first)
    same = F.unwrap_udt("features") == F.unwrap_udt("kept")
    return both.select("doc_id", (~same).cast("int").alias("differs"))


# --- MLlib: models ------------------------------------------------------------------------------

# Written results of this session: features and searches by application, input
# and settings.  A search takes minutes and a dozen queries read it; inputs are
# taken as unchanged while a session lasts.
_WRITTEN: dict[tuple, object] = {}


def _once(spark, key: tuple, make):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def _feature_splits(spark, sf_dir):
    """Features of the labelled articles, written once per split and read
    back: training starts from files, not from a long lineage.  Statistics and
    words are written too, since fitting and transforming both read them."""
    def make():
        arts = scratch.materialise(features.prepared(quality.clean_articles(tables.articles(spark, sf_dir))), "prepared")
        model = features.fit_prepared(arts)
        table = features.feature_table(model, arts, ["doc_id", "source", "subject", "label"])
        table = splits.hash_split(table).withColumn("fold", bucket("fold", FOLDS, "doc_id").cast("int"))
        path = scratch.scratch_path(spark, "features")
        sinks.write_splits(table, path, balance=True)
        return path

    path = _once(spark, ("features", sf_dir, FOLDS), make)
    return tuple(sinks.read_split(spark, path, s) for s in splits.SPLIT_NAMES)


def _searched(spark, sf_dir, names):
    """What the searches of ``names`` have found, and the three splits."""
    training, validation, test = _feature_splits(spark, sf_dir)

    def make(name):
        path = scratch.scratch_path(spark, f"search-{name}")
        search.searched(training, name, FOLDS, path)
        return path

    paths = [_once(spark, ("search", sf_dir, FOLDS, name), lambda name=name: make(name)) for name in names]
    return search.union([search.load(spark, p) for p in paths]), training, validation, test


def _train_and_measure(spark, sf_dir, name):
    """Test metrics of the best grid point, refitted on all training rows."""
    found, _, _, test = _searched(spark, sf_dir, [name])
    scored = model_tables.predictions(found.fitted(), test)
    measured = evaluate.evaluate(scored, ["model"]).join(found.times, "model")
    return rounded(measured, 4)


@query
def train_logreg(spark, sf_dir):
    return _train_and_measure(spark, sf_dir, "LogisticRegression")


@query
def train_svc(spark, sf_dir):
    return _train_and_measure(spark, sf_dir, "LinearSVC")


@query
def train_rf(spark, sf_dir):
    return _train_and_measure(spark, sf_dir, "RandomForest")


@query
def train_nb(spark, sf_dir):
    return _train_and_measure(spark, sf_dir, "NaiveBayes")


@query
def prediction_scores(spark, sf_dir):
    """A model with probabilities next to one with margins only: rows, labels
    and whether score and prediction are of the right kind."""
    found, _, validation, _ = _searched(spark, sf_dir, ["NaiveBayes", "LinearSVC"])
    scored = model_tables.predictions(found.fitted(), validation)
    bounded = F.when(F.col("model") == "LinearSVC", ~F.isnan("score")).otherwise(F.col("score").between(0, 1))
    return scored.select("row_id", "model", "label", bounded.alias("score_in_bounds"), F.col("prediction").isin(0.0, 1.0).alias("is_class"))


@query
def score_batch(spark, sf_dir):
    found, _, _, test = _searched(spark, sf_dir, ["NaiveBayes"])
    scored = model_tables.predictions(found.fitted(), test, keep=["source", "subject"])
    return scored.select("row_id", "source", "subject", "model", "label", F.col("score").between(0, 1).alias("score_in_bounds"),
                         F.col("prediction").isin(0.0, 1.0).alias("is_class"))


def _test_predictions(spark, sf_dir):
    """Test predictions of the four searched models, written once: a model is
    asked once per row whatever reads its answers."""
    def make():
        found, _, _, test = _searched(spark, sf_dir, train.MODEL_NAMES)
        return scratch.materialise(model_tables.predictions(found.fitted(), test), "predictions")

    return _once(spark, ("predictions", sf_dir, FOLDS), make)


@query
def model_metrics(spark, sf_dir):
    """Validation and test metrics of the searched models, with fit times."""
    found, _, validation, test = _searched(spark, sf_dir, train.MODEL_NAMES)
    both = validation.withColumn("split", F.lit("validation")).unionByName(test.withColumn("split", F.lit("test")))
    scored = scratch.materialise(model_tables.predictions(found.fitted(), both, keep=["split"]), "predictions")
    return rounded(evaluate.evaluate(scored, ["split", "model"]).join(found.times, "model"), 4)


@query
def model_evaluation(spark, sf_dir):
    """Cells, metrics, area and bootstrap intervals of the searched models on
    the test split."""
    scored = _test_predictions(spark, sf_dir)
    intervals = significance.interval_report(significance.multinomial_replicates(scored))
    return rounded(evaluate.evaluate(scored, ["model"]).join(intervals, "model"), 4)


@query
def model_roc_curve(spark, sf_dir):
    scored = _test_predictions(spark, sf_dir)
    return rounded(roc.roc_curve(scored, ["model"], rows=scored.count()))


@query
def model_mcnemar(spark, sf_dir):
    flags = significance.align(_test_predictions(spark, sf_dir), train.MODEL_NAMES)
    return rounded(significance.mcnemar_test(significance.mcnemar_counts(flags, train.MODEL_NAMES)))


@query
def model_roundtrip(spark, sf_dir):
    """Searched models, saved as another version and loaded, score the
    validation split alike."""
    found, _, validation, _ = _searched(spark, sf_dir, train.MODEL_NAMES)
    root = scratch.scratch_path(spark, "model-versions")
    models = found.fitted()
    first, last = model_tables.save(models, root), model_tables.save(model_tables.load(spark, root), root)
    before, after = (model_tables.predictions(m, validation) for m in (models, model_tables.load(spark, root, last)))
    assert (first, last) == (1, 2)
    return train.prediction_mismatches(before, after)


@query
def cv_grid(spark, sf_dir):
    found, _, _, _ = _searched(spark, sf_dir, train.MODEL_NAMES)
    return rounded(found.grid)


@query
def cv_fold_metrics(spark, sf_dir):
    found, training, validation, _ = _searched(spark, sf_dir, train.MODEL_NAMES)
    scored = scratch.materialise(search.fold_predictions(found, training, validation, FOLDS), "fold-predictions")
    per_fold = evaluate.evaluate(scored, ["scope", "model", "fold"])
    return rounded(per_fold.select("scope", "model", "fold", "accuracy", "f1_weighted", "f1_positive", "auc"), 4)


# --- naive Bayes through the evaluation operators ------------------------------------------------

NB_SMOOTHING = {"nb_half": 0.5, "nb_one": 1.0}


def _nb_predictions(words, within, scored, keys=()):
    """Two naive Bayes models fitted on ``within``, asked on ``scored``.

    The margin is rounded, so that texts of the same words tie whatever the
    order of the sums.
    """
    out = []
    for name, smoothing in NB_SMOOTHING.items():
        classes, weights = terms.naive_bayes_terms(words.where(within), smoothing)
        asked = terms.naive_bayes_predict(words.where(scored), classes, weights)
        score = F.round("margin", 6)
        out.append(asked.select(F.col("doc_id").alias("row_id"), F.lit(name).alias("model"), "label", score.alias("score"),
                                (score > 0).cast("double").alias("prediction"), *keys))
    return train.union_all(out)


def _nb_test(spark, sf_dir):
    words = splits.hash_split(_labelled_words(spark, sf_dir))
    return scratch.materialise(_nb_predictions(words, F.col("split") == "train", F.col("split") == "test"), "nb-predictions")


@query
def nb_confusion(spark, sf_dir):
    return rounded(evaluate.classification_metrics(_nb_test(spark, sf_dir), ["model"]))


@query
def nb_roc_curve(spark, sf_dir):
    scored = _nb_test(spark, sf_dir)
    return rounded(roc.roc_curve(scored, ["model"], rows=scored.count()))


@query
def nb_mcnemar(spark, sf_dir):
    models = list(NB_SMOOTHING)
    return rounded(significance.mcnemar_test(significance.mcnemar_counts(significance.align(_nb_test(spark, sf_dir), models), models)))


@query
def nb_bootstrap(spark, sf_dir):
    models = list(NB_SMOOTHING)
    long = _nb_test(spark, sf_dir)
    wide = long.groupBy("row_id", "label").agg(*[
        F.max(F.when(F.col("model") == m, F.struct("score", "prediction"))).alias(m) for m in models])
    return rounded(significance.interval_report(significance.poisson_replicates(wide, models)))


@query
def nb_cv_grid(spark, sf_dir):
    """Grid search of the smoothing by five md5 folds: mean and deviation of
    the area, and the best point."""
    words = splits.hash_split(_labelled_words(spark, sf_dir)).where(F.col("split") == "train")
    words = scratch.materialise(words.withColumn("fold", bucket("fold", FOLDS, "doc_id").cast("int")), "nb-folds")
    margins = terms.naive_bayes_folds(words, FOLDS, list(NB_SMOOTHING.values()))
    # Rounded as in ``_nb_predictions``.
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.round(F.get("margins", F.lit(j)), 6).alias("score")) for j, m in enumerate(NB_SMOOTHING)])
    scored = margins.select("fold", "label", F.inline(models))
    scored = scratch.materialise(scored, "nb-fold-predictions")
    areas = roc.area_under_roc(scored, ["model", "fold"], rows=scored.count())
    grid = rounded(areas.groupBy("model").agg(F.avg("auc").alias("avg_auc"), F.stddev_pop("auc").alias("std_auc")))
    # The first grid point with the largest mean, in the order of NB_SMOOTHING.
    index = F.array_position(F.array(*[F.lit(m) for m in NB_SMOOTHING]), F.col("model")).cast("int")
    best = evaluate.best_of_grid(grid.withColumns({"grid_index": index, "grid": F.lit("nb")}), "avg_auc", key="grid")
    return grid.withColumn("grid_index", index).join(F.broadcast(best.select("grid_index", F.lit(True).alias("best"))), "grid_index", "left").select(
        "model", "avg_auc", "std_auc", F.coalesce("best", F.lit(False)).alias("best"))


def _forest_importances(spark, sf_dir):
    """Importances in the forest of the first grid point on all training rows."""
    training, _, _ = _feature_splits(spark, sf_dir)
    trees, _, blocks = search.fit_forests(training, [search.ALL_ROWS], [0])
    blocks.unpersist()
    return importance.importances_of(spark, forest.importances(trees))


@query
def feature_importance(spark, sf_dir):
    return rounded(importance.top_features(_forest_importances(spark, sf_dir)))


@query
def feature_words(spark, sf_dir):
    top = importance.top_features(_forest_importances(spark, sf_dir))
    words = terms.vocabulary(_clean_docs(spark, sf_dir), stop_words())
    return rounded(importance.with_words(top, words))
