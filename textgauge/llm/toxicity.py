"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence is toxic with probability
``sigmoid(bias + sum of the weights of its words and their first letters)``; a document is toxic unless none of
its sentences is (noisy-or, with a small leak for labels that no sentence
explains).  Only document labels train the word weights; the sentence
probabilities then point at the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .sizes import small
from .words import distinct_sets, pieces

TABLE_BITS = 20
# Bytes of leading letters that count as features beside the whole word.
PREFIXES = (4, 5, 6, 7, 8)


@dataclass
class Model:
    """``words``: sorted hashes of features, ``weights`` theirs."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -12.0
    leak: float = 0.01

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Weight of every word, 0 if unknown."""
        out = np.zeros(len(hashes))
        if len(self.words):
            table = np.zeros(1 << TABLE_BITS, bool)
            mask = np.uint64((1 << TABLE_BITS) - 1)
            table[self.words & mask] = True
            maybe = np.flatnonzero(table[hashes & mask])
            at = np.minimum(np.searchsorted(self.words, hashes[maybe]), len(self.words) - 1)
            out[maybe] = np.where(self.words[at] == hashes[maybe], self.weights[at], 0.0)
        return out


def _features(p) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the cores and leading letters of all words, and their words."""
    parts = p.core_hashes(PREFIXES)
    words = np.tile(np.arange(len(p.starts)), len(parts))
    flat = np.concatenate(parts)
    some = flat != 0
    return flat[some], words[some]


def _feature_counts(docs: DataFrame) -> DataFrame:
    """``(feature, n, toxic)``: documents and toxic documents that hold each
    feature, summed up in every batch before rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            found, toxic = [np.zeros(0, np.uint64)], [np.zeros(0)]
            for p in pieces(batch.column(0)):
                f, word = _features(p)
                s, first = distinct_sets(f, p.owner[word], p.rows)
                found.append(s)
                toxic.append(np.repeat(labels[p.first_row : p.first_row + p.rows], np.diff(first)))
            features, code = np.unique(np.concatenate(found), return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(features.view(np.int64)), pa.array(np.bincount(code, minlength=len(features))),
                pa.array(np.bincount(code, np.concatenate(toxic), len(features)).astype(np.int64))], ["feature", "n", "toxic"])

    part = docs.select("text", "label").mapInArrow(run, "feature long, n long, toxic long")
    return part.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _bags(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``(label, n_sentences, sentences, features)``: where the words of the
    ``vocabulary`` (their numbers in it) stand."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(vocabulary, np.arange(1, len(vocabulary) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in pieces(batch.column(0)):
                f, word = _features(p)
                at = shared.value.lookup(f).astype(np.int64)
                hit = np.flatnonzero(at)
                sentence = p.sentence_of()
                base = sentence[np.minimum(p.first[:-1], len(sentence) - 1)] if len(sentence) else np.zeros(p.rows, np.int64)
                last = sentence[np.maximum(p.first[1:] - 1, 0)] if len(sentence) else base
                owner = p.owner[word[hit]]
                order = np.argsort(owner, kind="stable")
                first = pa.array(np.searchsorted(owner[order], np.arange(p.rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(p.first_row, p.rows), pa.array(np.where(p.counts > 0, last - base + 1, 0)),
                    pa.ListArray.from_arrays(first, pa.array((sentence[word[hit]] - base[owner])[order])),
                    pa.ListArray.from_arrays(first, pa.array(at[hit][order] - 1))], ["label", "n_sentences", "sentences", "features"])

    return docs.select("text", "label").mapInArrow(run, "label int, n_sentences long, sentences array<long>, features array<long>")


def fit(docs: DataFrame, labels: DataFrame, rows: int = 20_000, words: int = 50_000, min_docs: int = 4, deviations: float = 4.0,
        share: float = 0.5, rounds: int = 200) -> Model:
    """Train on ``docs(doc_id, text)`` with ``labels(doc_id, label)`` (0/1,
    null ignored; of repeated labels the largest counts).

    All labelled documents say which words and leading letters can matter: a
    feature takes part if it is in ``min_docs`` of them, ``share`` of these are
    toxic, and more of them than chance would give, by ``deviations`` standard
    deviations; others would only learn the training documents by heart.  The
    ``words`` with the largest deviations are the vocabulary.  Its weights are
    found on the driver from the places of these features in ``rows`` labelled
    documents at most, those with the smallest hashes of their ids.  Without
    labels of both classes the model is a constant.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = materialise(known, "toxic-labels")
    total, mean = known.agg(F.count("*"), F.avg("label")).first()
    if not total or mean in (0.0, 1.0):
        return Model(leak=float(np.clip(mean or 0.0, 0.01, 0.99)))
    texts = docs.select("doc_id", "text")
    counts = _feature_counts(texts.join(small(known), "doc_id"))
    excess = (F.col("toxic") - mean * F.col("n")) / F.sqrt(F.col("n") * (mean * (1 - mean)))
    counts = counts.where((F.col("n") >= min_docs) & (F.col("toxic") >= share * F.col("n")) & (excess >= deviations))
    chosen = counts.orderBy(excess.desc(), "feature").limit(words).select("feature").toArrow()["feature"]
    vocabulary = np.sort(chosen.to_numpy().view(np.uint64))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Bounded by ``rows``: ids and labels only.
    bags = texts.join(F.broadcast(sample), "doc_id").select("text", "label")
    got = _bags(bags, vocabulary).toArrow()
    y, count = got["label"].to_numpy().astype(float), got["n_sentences"].to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return Model(leak=float(np.clip(mean, 0.01, 0.99)))
    base = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(y)), [len(x) for x in got["sentences"]])
    s = got["sentences"].combine_chunks().flatten().to_numpy() + base[doc]
    w = got["features"].combine_chunks().flatten().to_numpy()
    # A feature counts once per sentence.
    s, w = np.divmod(np.unique(s * max(len(vocabulary), 1) + w), max(len(vocabulary), 1))
    doc_of = np.repeat(np.arange(len(y)), count)
    m, v = len(doc_of), len(vocabulary)

    weights, bias, leak = np.zeros(v), -5.0, 0.03
    step_w, step_b = np.full(v, 1e-3), 1e-3
    for _ in range(rounds):
        z = bias + np.bincount(s, weights[w], m)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        free = (1 - leak) * np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)))
        total = np.clip(1 - free, 1e-9, 1 - 1e-9)
        pull = np.where(y == 1, (1 - total) / total, -1.0)
        g = pull[doc_of] * p
        gw = np.bincount(w, g[s], v) - 0.05 * weights
        gb = g.sum()
        step_w += gw * gw
        step_b += gb * gb
        weights += 0.6 * gw / np.sqrt(step_w)
        bias = float(np.clip(bias + 0.3 * gb / np.sqrt(step_b), -12, -2))
        leak = float(np.clip((leak / total)[y == 1].sum() / len(y), 0.002, 0.2))
    heavy = np.abs(weights) > 0.05
    return Model(vocabulary[heavy], weights[heavy], bias, leak)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, score, toxic_sentences)`` for every row of ``docs(doc_id,
    text, ...)``.

    ``toxic_sentences`` lists ``(start, stop, score)``, code-point positions,
    of the sentences with a probability of at least ``threshold``.  An empty
    or null text has no sentence and scores the leak.  Repeated rows score
    alike; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for p in pieces(batch.column(1)):
                sentence = p.sentence_of()
                f, word = _features(p)
                weight = m.lookup(f)
                hit = np.flatnonzero(weight)
                # A feature repeated in a sentence counts once, as in training.
                order = hit[np.lexsort((f[hit], sentence[word[hit]]))] if len(hit) else hit
                where, what = sentence[word[order]], f[order]
                once = np.ones(len(order), bool)
                once[1:] = (where[1:] != where[:-1]) | (what[1:] != what[:-1])
                n = int(sentence[-1]) + 1 if len(sentence) else 0
                begins = np.searchsorted(sentence, np.arange(n))
                stops = np.searchsorted(sentence, np.arange(n), side="right") - 1
                owner = p.owner[begins] if n else np.zeros(0, np.int64)
                z = m.bias + np.bincount(where[once], weight[order][once], n)
                prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                free = (1 - m.leak) * np.exp(np.bincount(owner, np.log1p(-np.minimum(prob, 1 - 1e-9)), p.rows))
                bad = np.flatnonzero(prob >= threshold)
                spans = pa.StructArray.from_arrays([
                    pa.array(p.code_points(p.starts[begins[bad]], owner[bad])),
                    pa.array(p.code_points(p.ends[stops[bad]], owner[bad])), pa.array(prob[bad])], fields=list(span))
                first = pa.array(np.searchsorted(owner[bad], np.arange(p.rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(p.first_row, p.rows).cast(pa.int64()), pa.array(1 - free),
                    pa.ListArray.from_arrays(first, spans)], ["doc_id", "score", "toxic_sentences"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, toxic_sentences array<struct<start: long, stop: long, score: double>>")
