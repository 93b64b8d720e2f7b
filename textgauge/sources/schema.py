"""Explicit schemas and what happens to rows that break them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("text", T.StringType(), False),
    T.StructField("subject", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("label", T.IntegerType(), False),
])

CRAWL_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("crawl_date", T.StringType(), False),
    T.StructField("content_length", T.IntegerType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("text", T.StringType(), False),
])


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Strict mode: the first wrong-typed or null value fails the job."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            message = F.lit(f"null in non-null column {f.name}")
            c = F.when(c.isNotNull(), c).otherwise(F.raise_error(message).cast(f.dataType))
            # The branch above cannot yield null; coalesce tells the analyzer so.
            c = F.coalesce(c, _zero(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols).to(schema)


def _zero(dtype: T.DataType) -> Column:
    return F.lit("" if isinstance(dtype, T.StringType) else 0).cast(dtype)


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Lenient mode: typed columns plus ``violations``, an array of
    ``column:type`` and ``column:null`` marks (empty for a good row).
    Columns outside the schema pass through."""
    marks, typed = [], []
    for f in schema.fields:
        raw, value = F.col(f.name), F.col(f.name).try_cast(f.dataType)
        marks.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"{f.name}:type")))
        if not f.nullable:
            marks.append(F.when(raw.isNull(), F.lit(f"{f.name}:null")))
        typed.append(value.alias(f.name))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*extra, *typed, F.array_compact(F.array(*marks)).alias("violations"))


def good_and_quarantine(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    checked = check(df, schema)
    good = checked.where(F.size("violations") == 0).drop("violations")
    return good, checked.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows per kind of violation; ``ok`` counts the good rows."""
    kinds = F.when(F.size("violations") == 0, F.array(F.lit("ok"))).otherwise(F.col("violations"))
    return check(df, schema).select(F.explode(kinds).alias("violation")).groupBy("violation").agg(F.count("*").alias("rows"))
