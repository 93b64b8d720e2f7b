"""Crawled pages as an article table, and labels from the publisher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOST_PATTERN = r"^https?://([^/:?#]+)"


def page_language(html: Column | str = "html") -> Column:
    lang = F.regexp_extract(html, r'<html[^>]*\slang="([A-Za-z]+)', 1)
    return F.when(lang == "", None).otherwise(F.lower(lang))


def page_text(html: Column | str = "html") -> Column:
    """Visible text: script, style and comments out, tags to blanks."""
    c = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def host(url: Column | str = "url") -> Column:
    return F.lower(F.regexp_extract(url, HOST_PATTERN, 1))


def crawl_articles(pages: DataFrame, language: str | None = "en") -> DataFrame:
    """One article per url in the wanted language.

    The newest copy of a url is not known (pages carry no date), so the
    smallest page id wins; only (url, page_id) is aggregated, the pages
    themselves move by their unique id at most.
    """
    wanted = pages.withColumn("language", page_language())
    if language:
        wanted = wanted.where(F.col("language") == language)
    first = wanted.groupBy("url").agg(F.min("page_id").alias("page_id")).select("page_id")
    kept = wanted.join(first, "page_id", "left_semi")
    return kept.select(
        "page_id", "url", "language", F.length("html").alias("content_length"), page_text().alias("text"))


def weak_labels(pages: DataFrame, domains: dict[str, int]) -> DataFrame:
    """Label from a curated domain list; a host matches a listed domain or any
    subdomain of it, other hosts stay unlabelled.  The list is a literal of
    the caller, so broadcasting it is safe."""
    spark = pages.sparkSession
    listed = spark.createDataFrame(sorted(domains.items()), "domain string, label int")
    parts = F.split("host", r"\.")
    # a.b.c -> a.b.c, b.c, c; the first listed one is the equi-join key.
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    domain = F.get(F.filter(suffixes, lambda d: d.isin(list(domains))), 0)
    hosts = pages.select("page_id", host().alias("host")).withColumn("domain", domain)
    return hosts.join(F.broadcast(listed), "domain", "left").select("page_id", "host", "label")
