"""The queries of this subpackage: thin, each applies one operator with its
production parameters to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from ..sources.tables import table
from . import alignment, chat, compression, decontaminate, extract, mixing, near_dup, occurrence_join, prefix_trie, quality_rules, substring, toxicity, warc
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def _fold(modulus: int, remainder: int):
    """True for held-out rows; a null doc_id is not held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


@query
def op3_paragraph_minhash(spark, sf_dir) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op5_weighted_mixture(spark, sf_dir) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))


@query
def op7_sentence_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = _fold(3, 1)
    out = toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "toxic_sentences")


@query
def op1_page_differencing(spark, sf_dir) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@query
def op2_warc_index_first(spark, sf_dir) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_compression_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = _fold(4, 2)
    out = compression.score(docs, compression.fit(docs, labels.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op6_chat_round_trip(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    hard = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(F.explode(F.array(F.lit("user"), F.lit("assistant"))).alias("role")).select(
        F.lit(-7).cast("long").alias("conv_id"), (F.col("role") == "assistant").cast("int").alias("turn"), "role", F.lit(hard).alias("text"))
    written = materialise(chat.format_conversations(turns.unionByName(added)), "chat")
    back = chat.read_back(written)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op8_template_decontamination(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]), decontaminate.Rule(any_case=True))


@query
def op9_decision_list(spark, sf_dir) -> DataFrame:
    stats = materialise(quality_rules.statistics(table(spark, sf_dir, "documents", ["doc_id", "text"])), "quality-statistics")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))
    rules = quality_rules.learn(stats.join(labels, "doc_id"))
    return quality_rules.judge(stats, rules)


@query
def op11_occurrence_join(spark, sf_dir) -> DataFrame:
    return occurrence_join.jaccard_classes(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op12_tokenizer_alignment(spark, sf_dir) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op13_prefix_trie(spark, sf_dir) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
