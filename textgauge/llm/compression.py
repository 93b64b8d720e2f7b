"""Quality by compression: which of two dictionaries helps a text more.

Two zstandard dictionaries are built, from good and from bad labelled texts.
A text like the good ones becomes smaller with the good dictionary; the
difference of the two compressed sizes, divided by the size without any
dictionary, is the evidence.  A logistic curve fitted on labelled texts that
the dictionaries have not seen turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICTIONARY_BYTES = 64 << 10
LEVEL = 3


@dataclass
class Model:
    """``good`` and ``bad``: dictionaries, at most ``DICTIONARY_BYTES`` each;
    ``curve``: weights of the evidence terms, the last one constant."""

    good: bytes = b""
    bad: bytes = b""
    curve: np.ndarray | None = None
    prior: float = 0.5


def _compressors(model: Model):
    def one(raw: bytes):
        if not raw:
            return zstandard.ZstdCompressor(level=LEVEL)
        held = zstandard.ZstdCompressionDict(raw)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=held)

    return one(model.good), one(model.bad), one(b"")


def evidence(texts: list[str | None], model: Model) -> np.ndarray:
    """Terms per text: the size difference over the plain size, and the plain
    size over the length (how much the text repeats itself)."""
    good, bad, plain = _compressors(model)
    out = np.zeros((len(texts), 2))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        if raw:
            none = len(plain.compress(raw))
            out[i] = (len(bad.compress(raw)) - len(good.compress(raw))) / none, none / (len(raw) + 32)
    return out


def _dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """The trained content of a dictionary; the samples themselves if they are
    too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _pieces(raw: bytes, size: int = 2048) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def _terms(x: np.ndarray) -> np.ndarray:
    d, r = x[:, 0], x[:, 1]
    return np.stack([20 * d, 20 * np.minimum(d, 0), 4 * r, 4 * r * r, np.ones(len(d))], axis=1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = 1500) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` (1 good,
    0 bad, null ignored; of repeated labels the smallest counts).

    At most ``rows`` whole texts of each class are used, those of the smallest
    hashes of their ids: half of them build the dictionaries, half fit the
    curve.  Without texts of both classes the model is a constant.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(rows) for k in (0, 1)]
    share = known.agg(F.avg("label")).first()[0]
    # Bounded by ``rows``: ids and labels only.
    sample = docs.select("doc_id", "text").where("length(text) > 0").join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    got = sample.select("text", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("build")).toArrow().to_pydict()
    texts, y, build = got["text"], np.array(got["label"]), np.array(got["build"], bool)
    if len(set(y.tolist())) < 2 or len(set(y[~build].tolist())) < 2 or len(set(y[build].tolist())) < 2:
        return Model(prior=float(share if share is not None else 0.5))
    cut = {k: [p for t, g, b in zip(texts, y, build) if b and g == k for p in _pieces(t.encode())] for k in (0, 1)}
    model = Model(good=_dictionary(cut[1]), bad=_dictionary(cut[0]), prior=float(share))
    use = np.flatnonzero(~build)
    x, t = _terms(evidence([texts[i] for i in use], model)), y[use].astype(float)
    # Classes weigh as they occur among all labels.
    w = np.where(t == 1, share / max(t.mean(), 1e-9), (1 - share) / max(1 - t.mean(), 1e-9))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(beta))
        beta += np.linalg.solve(hess, x.T @ (w * (t - p)) - 0.05 * beta)
    model.curve = beta
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs(doc_id, text, ...)``.

    Whole texts are compressed, one at a time.  A null or empty text has no
    evidence and scores the share of good labels.  Repeated rows score alike;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(1)
            p = np.full(batch.num_rows, m.prior)
            if m.curve is not None and batch.num_rows:
                for i in range(0, batch.num_rows, 256):
                    part = texts.slice(i, 256).to_pylist()
                    some = np.array([bool(t) for t in part])
                    x = _terms(evidence(part, m))
                    q = 1 / (1 + np.exp(-np.clip(x @ m.curve, -30, 30)))
                    p[i : i + len(part)] = np.where(some, q, m.prior)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(p)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
