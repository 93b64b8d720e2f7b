"""Feature engineering with MLlib: style statistics, TF-IDF, assembly."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, StopWordsRemover, Tokenizer, VectorAssembler
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import MIN_CHARS, NON_LETTER_PATTERN, SPACE_PATTERN, STAT_COLUMNS, URL_PATTERN, with_text_stats

# The length of a feature vector and the least document frequency.
NUM_FEATURES = 1 << 14
MIN_DOC_FREQ = 5


class TextStatistics(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The five style statistics as a pipeline stage that can be saved."""

    @keyword_only
    def __init__(self, *, inputCol: str = "text"):
        super().__init__()
        self._setDefault(inputCol="text")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_text_stats(dataset, self.getInputCol())


def cleaning_stage(input_col: str = "text", output_col: str = "clean_text", min_chars: int = MIN_CHARS) -> SQLTransformer:
    """The cleaning chain as a stage; too short texts are dropped."""

    def lit(pattern: str) -> str:
        return "r'" + pattern + "'"

    expr = f"regexp_replace({input_col}, {lit(URL_PATTERN)}, '')"
    expr = f"regexp_replace({expr}, {lit(NON_LETTER_PATTERN)}, '')"
    expr = f"trim(lower(regexp_replace({expr}, {lit(SPACE_PATTERN)}, ' ')))"
    # A WHERE on the cleaned text would be pushed down and clean it twice.
    return SQLTransformer(statement=(
        f"SELECT * FROM __THIS__ LATERAL VIEW explode(filter(array({expr}), t -> length(t) >= {min_chars})) c AS {output_col}"))


def tokenizer(input_col: str = "clean_text") -> Tokenizer:
    return Tokenizer(inputCol=input_col, outputCol="words")


def stop_word_remover() -> StopWordsRemover:
    return StopWordsRemover(inputCol="words", outputCol="filtered_words")


def hashing_tf(num_features: int = NUM_FEATURES) -> HashingTF:
    return HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features)


def feature_pipeline(num_features: int = NUM_FEATURES, min_doc_freq: int = MIN_DOC_FREQ, input_col: str = "text",
                     min_chars: int = MIN_CHARS) -> Pipeline:
    """Raw text to ``features``: TF-IDF followed by the five statistics.

    Statistics come from the raw text, before cleaning removes capitals and
    punctuation.  Fitting runs one job, the document-frequency count.

    The cleaning stage drops the texts without statistics, so their assembler has
    none to skip: its filter would be pushed below them and make them twice.
    """
    return Pipeline(stages=[
        TextStatistics(inputCol=input_col),
        cleaning_stage(input_col, min_chars=min_chars),
        tokenizer(),
        stop_word_remover(),
        hashing_tf(num_features),
        IDF(inputCol="raw_features", outputCol="tfidf_features", minDocFreq=min_doc_freq),
        VectorAssembler(inputCols=STAT_COLUMNS, outputCol="text_stats", handleInvalid="error"),
        VectorAssembler(inputCols=["tfidf_features", "text_stats"], outputCol="features", handleInvalid="skip"),
    ])


def fit_features(df: DataFrame, **kwargs) -> PipelineModel:
    return feature_pipeline(**kwargs).fit(df)


def prepared(df: DataFrame, input_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Statistics and content words of every text that is long enough after
    cleaning, in place of the text.  Written once, both fitting and
    transforming read it, so no text is cleaned twice."""
    cleaned = cleaning_stage(input_col, min_chars=min_chars).transform(TextStatistics(inputCol=input_col).transform(df))
    return tokens(cleaned).drop(input_col, "clean_text", "words")


def fit_prepared(prepared: DataFrame, num_features: int = NUM_FEATURES, min_doc_freq: int = MIN_DOC_FREQ) -> PipelineModel:
    """The stages of ``feature_pipeline`` that follow ``prepared``."""
    return Pipeline(stages=[
        hashing_tf(num_features),
        IDF(inputCol="raw_features", outputCol="tfidf_features", minDocFreq=min_doc_freq),
        VectorAssembler(inputCols=STAT_COLUMNS, outputCol="text_stats", handleInvalid="skip"),
        VectorAssembler(inputCols=["tfidf_features", "text_stats"], outputCol="features", handleInvalid="skip"),
    ]).fit(prepared)


def feature_table(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Only ``keep`` and the feature vector, ready to be written."""
    return model.transform(df).select(*keep, "features")


def tokens(clean: DataFrame) -> DataFrame:
    """Tokenizer and stop-word stages on a cleaned ``clean_text`` column."""
    return stop_word_remover().transform(tokenizer().transform(clean))


def sparse_parts(df: DataFrame, vector_col: str) -> DataFrame:
    """Size, number of stored entries and their sum, read from the vector's
    own storage, without expanding it to an array."""
    v = F.unwrap_udt(vector_col)
    return df.select(
        *[c for c in df.columns if c != vector_col],
        v["size"].alias("vector_size"),
        F.size(v["indices"]).alias("stored"),
        F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


def sparse_entries(df: DataFrame, vector_col: str, index: str, value: str) -> DataFrame:
    """A row for every stored entry of a sparse vector."""
    v = F.unwrap_udt(vector_col)
    entries = F.explode(F.arrays_zip(v["indices"].alias("i"), v["values"].alias("x")))
    rows = df.select(*[c for c in df.columns if c != vector_col], entries.alias("e"))
    return rows.select(*[c for c in df.columns if c != vector_col], F.col("e")["i"].alias(index), F.col("e")["x"].alias(value))


def word_buckets(words: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Word to hash bucket, asked from ``HashingTF`` itself so that it always
    agrees with the features."""
    one = words.withColumn("filtered_words", F.array("word"))
    hashed = hashing_tf(num_features).transform(one)
    return hashed.select(*words.columns, F.unwrap_udt("raw_features")["indices"][0].alias("bucket"))
