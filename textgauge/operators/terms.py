"""Term statistics on the cleaned text: counts, document frequency, IDF,
TF-IDF, vocabulary and a closed-form multinomial naive Bayes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import bucket
from ..functions.text import content_words
from ..sources.scratch import materialise

MIN_DOC_FREQ = 5


def with_content_words(clean: DataFrame, stops: list[str], text_col: str = "text") -> DataFrame:
    return clean.withColumn("words", content_words(text_col, stops)).drop(text_col)


def term_counts(docs: DataFrame, words_col: str = "words") -> DataFrame:
    """One row per (document, term) with ``tf``.

    All tokens of a document sit in its row, so they are counted there: sort
    the tokens, find where a new term starts, subtract neighbouring starts.
    Nothing is shuffled, unlike ``groupBy(doc_id, term)``.
    """
    keep = [c for c in docs.columns if c != words_col]
    step1 = docs.withColumn("_s", F.sort_array(words_col)).drop(words_col)
    # Position ``size`` is one past the end; it keeps the range valid for
    # documents without tokens and is filtered out again.
    step2 = step1.withColumn("_starts", F.filter(
        F.sequence(F.lit(0), F.size("_s")),
        lambda i: (i < F.size("_s")) & ((i == 0) | (F.get("_s", i) != F.get("_s", i - 1))),
    ))
    terms = F.transform("_starts", lambda s, k: F.struct(
        F.get("_s", s).alias("term"),
        (F.coalesce(F.get("_starts", k + 1), F.size("_s")) - s).cast("bigint").alias("tf"),
    ))
    return step2.select(*keep, F.inline(terms))


def document_frequency(docs: DataFrame, words_col: str = "words", min_doc_freq: int = 1) -> DataFrame:
    """Documents per term.  Each document contributes a term once; counts are
    combined per map task, so a frequent term costs one row per task."""
    terms = docs.select(F.explode(F.array_distinct(words_col)).alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    return df.where(F.col("df") >= min_doc_freq) if min_doc_freq > 1 else df


def idf_weights(df: DataFrame, n_docs: Column, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """ln((m + 1) / (df + 1)), 0 below the frequency cut."""
    idf = F.ln((n_docs + 1) / (F.col("df") + 1))
    return df.withColumn("idf", F.when(F.col("df") >= min_doc_freq, idf).otherwise(0.0))


def count_scalar(df: DataFrame) -> Column:
    """Row count as an uncorrelated scalar subquery."""
    return df.agg(F.count("*")).scalar()


def tfidf(docs: DataFrame, n_docs: Column, min_doc_freq: int = MIN_DOC_FREQ, id_col: str = "doc_id") -> DataFrame:
    """TF-IDF per document and term, zero weights left out as in a sparse
    vector."""
    weights = idf_weights(document_frequency(docs), n_docs, min_doc_freq).where(F.col("idf") != 0).select("term", "idf")
    # Frequent terms make large partitions on the left side only, which adaptive
    # execution splits.
    joined = term_counts(docs.select(id_col, "words")).join(weights, "term")
    return joined.select(id_col, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def top_terms(weighted: DataFrame, k: int, weight: str = "weight") -> DataFrame:
    """The k heaviest terms with rank; ties by term."""
    best = weighted.orderBy(F.desc(weight), "term").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(weight), "term")))


def vocabulary(docs: DataFrame, stops: list[str], text_col: str = "text") -> DataFrame:
    """Distinct lower-case words of two or more letters, without stop words,
    with the number of documents that contain them."""
    words = F.regexp_extract_all(F.lower(text_col), F.lit(r"\b([a-z]{2,})\b"), 1)
    kept = F.filter(F.array_distinct(words), lambda w: ~w.isin(stops))
    return docs.select(F.explode(kept).alias("word")).groupBy("word").agg(F.count("*").alias("documents"))


def words_per_bucket(words: DataFrame, bucket_col: str = "bucket", first: int = 3) -> DataFrame:
    """The alphabetically first words of each bucket, comma-joined.  The rank
    filter runs in every task before the shuffle, so no bucket is ever
    gathered whole."""
    w = Window.partitionBy(bucket_col).orderBy("word")
    kept = words.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= first)
    cells = F.array_join(F.array_sort(F.collect_list("word")), ", ")
    return kept.groupBy(bucket_col).agg(cells.alias("words"))


def hashed_words(words: DataFrame, n: int, seed=42) -> DataFrame:
    return words.withColumn("bucket", bucket(seed, n, "word"))


# --- multinomial naive Bayes in closed form ----------------------------------

def naive_bayes_terms(docs: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """``(classes, terms)`` of a multinomial model for labels 0 and 1:
    per class its log prior and total count, per term its log weights."""
    counts = term_counts(docs.select("doc_id", "label", "words"))
    per_term = counts.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 0, F.col("tf")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("label") == 1, F.col("tf")).otherwise(0)).alias("n1"),
    )
    sizes = docs.agg(F.count_if(F.col("label") == 0).alias("c0"), F.count_if(F.col("label") == 1).alias("c1"))
    totals = per_term.agg(F.struct(F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.count("*").alias("d"))).scalar()

    def theta(i: int) -> Column:
        return F.ln((F.col(f"n{i}") + smoothing) / (totals[f"s{i}"] + smoothing * totals["d"]))

    terms = per_term.select("term", "n0", "n1", theta(0).alias("theta0"), theta(1).alias("theta1"))
    prior = F.ln((F.col("n") + smoothing) / (F.col("c0") + F.col("c1") + 2 * smoothing))
    classes = sizes.select("*", F.inline(F.array(*[
        F.struct(F.lit(i).alias("label"), F.col(f"c{i}").alias("n")) for i in (0, 1)
    ]))).select("label", F.col("n").alias("documents"), prior.alias("log_prior"))
    return classes, terms


def naive_bayes_predict(docs: DataFrame, classes: DataFrame, terms: DataFrame) -> DataFrame:
    """Margin (log odds of class 1) and prediction per document."""
    counts = term_counts(docs.select("doc_id", "words"))
    gain = terms.select("term", (F.col("theta1") - F.col("theta0")).alias("gain"))
    margins = counts.join(gain, "term").groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("gain")).alias("_m"))
    prior = classes.agg(F.sum(F.when(F.col("label") == 1, F.col("log_prior")).otherwise(-F.col("log_prior")))).scalar()
    scored = docs.select("doc_id", "label").join(margins, "doc_id", "left")
    margin = prior + F.coalesce("_m", F.lit(0.0))
    return scored.select("doc_id", "label", margin.alias("margin"), (margin > 0).cast("double").alias("prediction"))


def naive_bayes_folds(docs: DataFrame, n_folds: int, smoothings: list[float]) -> DataFrame:
    """``(doc_id, label, fold, margins)``: the margins of each document under
    the models fitted without its fold, one per smoothing.

    A row per term holds its counts outside every fold, so all models come
    from one pass over the documents and are asked in one join.
    """
    folds, label = range(n_folds), F.col("label")
    counts = term_counts(docs.select("doc_id", "label", "fold", "words"))

    def outside(k: int, condition: Column, value: Column) -> Column:
        return F.sum(F.when((F.col("fold") != k) & condition, value).otherwise(0))

    every = F.lit(True)
    per_term = materialise(counts.groupBy("term").agg(*[c for k in folds for c in (
        outside(k, label == 0, F.col("tf")).alias(f"n0_{k}"), outside(k, label == 1, F.col("tf")).alias(f"n1_{k}"),
        outside(k, every, F.lit(1)).alias(f"rows_{k}"))]), "fold-terms")
    # A row each, whatever the number of documents and terms.
    totals = per_term.agg(F.struct(*[c for k in folds for c in (
        F.sum(f"n0_{k}").alias(f"s0_{k}"), F.sum(f"n1_{k}").alias(f"s1_{k}"), F.count_if(F.col(f"rows_{k}") > 0).alias(f"d_{k}"))])).scalar()
    sizes = docs.agg(F.struct(*[outside(k, label == i, F.lit(1)).alias(f"c{i}_{k}") for k in folds for i in (0, 1)])).scalar()

    def gain(k: int, smoothing: float) -> Column:
        theta = [F.ln((F.col(f"n{i}_{k}") + smoothing) / (totals[f"s{i}_{k}"] + smoothing * totals[f"d_{k}"])) for i in (0, 1)]
        return F.when(F.col(f"rows_{k}") > 0, theta[1] - theta[0])

    def prior(k: int, smoothing: float) -> Column:
        n = sizes[f"c0_{k}"] + sizes[f"c1_{k}"] + 2 * smoothing
        return F.ln((sizes[f"c1_{k}"] + smoothing) / n) - F.ln((sizes[f"c0_{k}"] + smoothing) / n)

    def of_fold(make, smoothing: float) -> Column:
        return F.array(*[make(k, smoothing) for k in folds])

    gains = per_term.select("term", *[of_fold(gain, s).alias(f"gain_{j}") for j, s in enumerate(smoothings)])
    sums = [F.sum(F.col("tf") * F.get(f"gain_{j}", F.col("fold"))).alias(f"_m{j}") for j in range(len(smoothings))]
    margins = counts.drop("label").join(gains, "term").groupBy("doc_id").agg(*sums)
    asked = docs.select("doc_id", "label", "fold").join(margins, "doc_id", "left")
    return asked.select("doc_id", "label", "fold", F.array(*[
        F.get(of_fold(prior, s), F.col("fold")) + F.coalesce(f"_m{j}", F.lit(0.0)) for j, s in enumerate(smoothings)]).alias("margins"))
