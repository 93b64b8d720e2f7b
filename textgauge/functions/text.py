"""Text expressions: five style statistics, cleaning, tokens."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAT_COLUMNS = ["text_length", "word_count", "avg_word_length", "caps_ratio", "exclamation_count"]
MIN_CHARS = 100

# The patterns of the statistics and of cleaning.
URL_PATTERN = r"https?://\S+"
NON_CAPITAL_PATTERN = r"[^A-Z]+"
SPACE_PATTERN = r"\s+"
# ``[^a-zA-Z\s]`` in the character classes that Java's regex engine matches
# about three times faster; a run is one match.
NON_LETTER_PATTERN = r"[\P{Alpha}&&\S]+"


def with_text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the five style statistics of ``text_col``.

    Lengths are code points; only ASCII capitals count; a text has at least
    one word (splitting the empty string gives one empty piece).
    """
    text = F.col(text_col)
    base = {
        "text_length": F.length(text).cast("double"),
        "word_count": F.size(F.split(text, r"\s+")).cast("double"),
        "_capitals": F.length(F.regexp_replace(text, NON_CAPITAL_PATTERN, "")).cast("double"),
        "exclamation_count": (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("double"),
    }
    ratios = {
        "avg_word_length": F.when(F.col("word_count") > 0, F.col("text_length") / F.col("word_count")).otherwise(0.0),
        "caps_ratio": F.when(F.col("text_length") > 0, F.col("_capitals") / F.col("text_length")).otherwise(0.0),
    }
    out = df.withColumns(base).withColumns(ratios)
    return out.select(*[c for c in df.columns if c not in STAT_COLUMNS], *STAT_COLUMNS)


def cleaned(text: Column | str) -> Column:
    """Drop URLs, keep ASCII letters and blanks, collapse blanks, lower, trim."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.regexp_replace(c, URL_PATTERN, "")
    c = F.regexp_replace(c, NON_LETTER_PATTERN, "")
    c = F.regexp_replace(c, SPACE_PATTERN, " ")
    return F.trim(F.lower(c))


@lru_cache(maxsize=None)
def _load_stop_words(language: str) -> tuple[str, ...]:
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def stop_words(language: str = "english") -> list[str]:
    """Spark's own stop-word list (needs an active session)."""
    return list(_load_stop_words(language))


def content_words(clean_col: Column | str, stops: list[str]) -> Column:
    """Tokens of an already cleaned text without stop words, in text order."""
    c = F.col(clean_col) if isinstance(clean_col, str) else clean_col
    return F.filter(F.split(c, " "), lambda w: ~w.isin(stops))
