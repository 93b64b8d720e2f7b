"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Every text is cut by a byte-level vocabulary A and a piece vocabulary B.  Byte
places where tokens of both end cut the text into groups; a link is an
occurrence pair of an A and a B token whose byte ranges overlap.

1. Both encodings are written once, two bytes a token.
2. An A token whose link goes to the B token of the same bytes is counted in a
   vector as long as the vocabulary; only the other links are counted as pairs
   and shuffled.
3. Links are scored from vectors and from the most frequent pairs, both of a
   fixed size; the pairs beyond them are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise

# The pattern by which the byte-level vocabulary splits texts.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The pattern looks ahead inside white space; longer runs take another path.
LONG_SPACE = re.compile(r"\s{400}")
WIDTH = 1 << 16  # ids of both vocabularies are below
TEXT_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``folder`` with the two vocabulary files; ``frequent``: pairs whose
    counts every task holds (16 bytes each, the others are joined);
    ``held``: distinct pairs that a counting task holds before it emits them."""

    folder: str = "/opt/tokenizers"
    bytes_file: str = "byte_bpe_50k.json"
    pieces_file: str = "piece_bpe_32k.model"
    frequent: int = 1 << 18
    held: int = 1 << 20

    def files(self) -> tuple[bytes, bytes]:
        out = []
        for name in (self.bytes_file, self.pieces_file):
            with open(os.path.join(self.folder, name), "rb") as f:
                out.append(f.read())
        return tuple(out)


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabets write printable bytes as themselves and the others
    as the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_json: bytes, piece_model: bytes):
        import sentencepiece
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.byte_json, self._whole = byte_json, None
        model, char = json.loads(byte_json), _byte_of_char()
        special = {t["id"] for t in model["added_tokens"]}
        a = {i: bytes(char[c] for c in token) for token, i in model["model"]["vocab"].items() if i not in special}
        # Merge order is id order, so the ids are ranks.
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={t: i for i, t in a.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        b = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        self.a_bytes = [a.get(i, b"") for i in range(max(a) + 1)]
        self.b_bytes = [b[i] for i in range(len(b))]
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int64)
        # A id to the B id of the same bytes, a proper piece before a byte.
        whole = {t: i for i, t in b.items() if self.b.is_byte(i)}
        whole |= {t: i for i, t in b.items() if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([whole.get(t, -1) for t in self.a_bytes], np.int64)

    def encode_a(self, text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return self.a.encode_ordinary(text)
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_str(self.byte_json.decode())
            self._whole.encode_special_tokens = True
        return self._whole.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none if a side does not spell the text."""
        none = np.zeros(0, np.uint16)
        if not text:
            return none, none
        a, b = self.encode_a(" " + text), self.b.encode(text)
        want = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return none, none
        return np.array(a, np.uint16), np.array(b, np.uint16)


@lru_cache(maxsize=2)
def vocabularies(byte_json: bytes, piece_model: bytes) -> Vocabularies:
    return Vocabularies(byte_json, piece_model)


def _binaries(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in arrays], pa.binary())


def encodings(docs: DataFrame, files) -> DataFrame:
    """``(row, doc_id, a, b)`` of ``docs(doc_id, text)``: ids as 16-bit
    numbers; ``row`` tells repeated ids apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*files.value)
        for batch in batches:
            texts, first = batch.column(2), 0
            while first < batch.num_rows:
                found, size, at = [], 0, first
                while at < batch.num_rows and size < TEXT_BYTES:
                    found.append(v.encode(texts[at].as_py()))
                    size += len(found[-1][0]) + len(found[-1][1])
                    at += 1
                own = batch.slice(first, at - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), _binaries([x for x, _ in found]), _binaries([y for _, y in found])],
                    ["row", "doc_id", "a", "b"])
                first = at

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, a binary, b binary")


class Links:
    """All links of some encoded texts.

    ``a`` and ``b`` are the tokens of all texts, ``doc_a`` and ``doc_b`` their
    texts; a link joins tokens ``left`` and ``right``.  ``a_ends`` and
    ``b_ends`` are byte places over all texts, whose groups end at ``cuts``.
    """

    def __init__(self, a: list[bytes], b: list[bytes], v: Vocabularies):
        self.rows = len(a)
        self.n_a = np.array([len(x) // 2 for x in a], np.int64)
        self.n_b = np.array([len(x) // 2 for x in b], np.int64)
        self.a = np.frombuffer(b"".join(a), np.uint16).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), np.uint16).astype(np.int64)
        self.doc_a = np.repeat(np.arange(self.rows), self.n_a)
        self.doc_b = np.repeat(np.arange(self.rows), self.n_b)
        # Both sides spell the same bytes, so places agree over all texts.
        self.a_ends, self.b_ends = np.cumsum(v.a_length[self.a]), np.cumsum(v.b_length[self.b])
        ends = np.union1d(self.a_ends, self.b_ends)
        # Every stretch between two neighbouring ends is the overlap of one link.
        self.left, self.right = np.searchsorted(self.a_ends, ends), np.searchsorted(self.b_ends, ends)
        self.doc = self.doc_a[self.left]
        self.cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        self.n_groups = np.bincount(self.doc_a[np.searchsorted(self.a_ends, self.cuts)], minlength=self.rows)
        self.n_links = np.bincount(self.doc, minlength=self.rows)
        a_id, b_id = self.a[self.left], self.b[self.right]
        self.same = v.identity[a_id] == b_id
        self.a_id, self.pair = a_id, a_id * WIDTH + b_id

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` per text, in bytes."""
        # The place of a token: all tokens of earlier groups, of its side and,
        # for B, the A tokens of its own group.
        group_a, group_b = np.searchsorted(self.cuts, self.a_ends), np.searchsorted(self.cuts, self.b_ends)
        n = len(self.cuts)
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n))])[:-1]
        upto_a = np.cumsum(np.bincount(group_a, minlength=n))
        if not n:
            return [b""] * self.rows
        at_a = np.arange(len(self.a)) + before_b[group_a]
        at_b = np.arange(len(self.b)) + upto_a[group_b]
        ids, marks = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        last_a, last_b = np.diff(group_a, append=n) > 0, np.diff(group_b, append=n) > 0
        marks[at_a[last_a]], marks[at_b[last_b]] = ord("|"), ord(";")
        digits, width = _digits()
        chars = np.empty((len(ids), digits.shape[1] + 1), np.uint8)
        chars[:, :-1], chars[:, -1] = digits[ids], marks
        used = np.arange(digits.shape[1] + 1) >= digits.shape[1] - width[ids][:, None]
        raw = chars[used].tobytes()
        size = np.concatenate([[0], np.cumsum(width[ids] + 1)])
        first = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        return [raw[size[i] : size[j] - 1] if j > i else b"" for i, j in zip(first[:-1], first[1:])]


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids, right-aligned, and how many there are."""
    n = np.arange(WIDTH)
    digits = np.stack([n // 10**k % 10 for k in range(4, -1, -1)], 1).astype(np.uint8) + ord("0")
    return digits, 1 + sum((n >= 10**k).astype(np.int64) for k in range(1, 5))


def _chunks(batches: Iterator[pa.RecordBatch], size: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their encodings hold about ``size`` bytes."""
    for batch in batches:
        lengths = np.array([len(x.as_buffer()) + len(y.as_buffer()) for x, y in zip(batch.column("a"), batch.column("b"))], np.int64)
        ends, first = np.cumsum(lengths), 0
        while first < batch.num_rows:
            limit = (ends[first - 1] if first else 0) + size
            stop = min(max(int(np.searchsorted(ends, limit, side="right")), first + 1), batch.num_rows)
            yield batch.slice(first, stop - first)
            first = stop


def pair_counts(encoded: DataFrame, files, rule: Rule) -> DataFrame:
    """``(pair, same, n)``: how many texts hold a pair of ids linked.  ``pair``
    is A id x 65536 + B id, ``same`` tells the identity pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*files.value)
        vector = np.zeros(len(v.identity), np.int64)
        held = np.zeros(0, np.int64)
        count = np.zeros(0, np.int64)

        def rows(pair, n, same):
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(np.full(len(pair), same)), pa.array(n, pa.int64())], ["pair", "same", "n"])

        for batch in _chunks(batches):
            x = Links(batch.column("a").to_pylist(), batch.column("b").to_pylist(), v)
            # Regular: a mark per text and A id.  A text counts once.
            mark = np.unique(x.doc[x.same] * WIDTH + x.a_id[x.same])
            vector += np.bincount(mark % WIDTH, minlength=len(vector))
            other = ~x.same
            pair, place = np.unique(x.pair[other], return_inverse=True)
            texts = np.unique(x.doc[other] * max(len(pair), 1) + place)
            n = np.bincount(texts % max(len(pair), 1), minlength=len(pair)) if len(pair) else np.zeros(0, np.int64)
            held, place = np.unique(np.concatenate([held, pair]), return_inverse=True)
            count = np.bincount(place, np.concatenate([count, n]), len(held)).astype(np.int64)
            if len(held) > rule.held:
                yield rows(held, count, False)
                held, count = held[:0], count[:0]
        yield rows(held, count, False)
        a = np.flatnonzero(vector)
        yield rows(a * WIDTH + v.identity[a], vector[a], True)

    found = encoded.select("a", "b").mapInArrow(run, "pair long, same boolean, n long")
    return found.groupBy("pair", "same").agg(F.sum("n").alias("n"))


def _vector(rows: DataFrame, size: int, index: str, value: str) -> np.ndarray:
    """A vector over a vocabulary from at most ``size`` rows."""
    t = rows.select(F.col(index).cast("long").alias("i"), F.col(value).cast("long").alias("v")).limit(size).toArrow()
    out = np.zeros(size, np.int64)
    out[t["i"].to_numpy()] = t["v"].to_numpy()
    return out


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` pairs of the highest counts, sorted by pair: all pairs
    of the upper classes of a logarithmic scale that fit."""
    level = F.floor(F.log2("n") * 8)
    fits, total = None, 0
    for at, rows in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += rows
        if total > most:
            break
        fits = at
    if fits is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t = counts.where(level >= fits).select("pair", "n").toArrow()
    pair, n = t["pair"].to_numpy(), t["n"].to_numpy()
    order = np.argsort(pair)
    return pair[order], n[order]


def scored(encoded: DataFrame, files, known) -> DataFrame:
    """Counts of every text from the vectors and frequent pairs ``known``; the
    pairs that are not there as ``rest_pair`` with ``rest_n`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*files.value)
        same_count, best, pairs, counts = known.value
        for batch in _chunks(batches):
            x = Links(batch.column("a").to_pylist(), batch.column("b").to_pylist(), v)
            at = np.searchsorted(pairs, x.pair)
            at[at == len(pairs)] = 0
            there = pairs[at] == x.pair if len(pairs) else np.zeros(len(at), bool)
            count = np.where(x.same, same_count[x.a_id], counts[at] if len(pairs) else 0)
            there |= x.same
            hit = there & (count == best[x.a_id])
            n_best = np.bincount(x.doc[hit], minlength=x.rows)
            # Integers: sums of floats would be exact only below 2**53.
            total = np.zeros(x.rows, np.int64)
            np.add.at(total, x.doc[there], count[there])
            pair, place = np.unique(x.pair[~there], return_inverse=True)
            key, n = np.unique(x.doc[~there] * max(len(pair), 1) + place, return_counts=True)
            doc = key // max(len(pair), 1)
            rest = pair[key % max(len(pair), 1)] if len(pair) else key
            first = pa.array(np.searchsorted(doc, np.arange(x.rows + 1)), pa.int32())
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in x.group_texts()]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (x.n_a, x.n_b, x.n_groups, x.n_links, n_best, total)),
                pa.array(digests, pa.string()), pa.ListArray.from_arrays(first, pa.array(rest, pa.int64())), pa.ListArray.from_arrays(first, pa.array(n, pa.int64())),
            ], names)

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest_pair", "rest_n"]
    kinds = ["long"] * 8 + ["string", "array<long>", "array<long>"]
    return encoded.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in zip(names, kinds)))


def align(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs(doc_id, text, ...)`` to a row per input row: ``doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text that is null, empty or not spelled exactly by both vocabularies has
    no tokens: zeros and an empty digest.  Repeated rows, also under one id or
    without one, are texts of their own and count each.  Ties in the highest
    count of an A id all count.  Other columns are ignored; an empty table has
    no rows.  A long text is handled whole, in memory in proportion to it.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(rule.files())
    v = vocabularies(*files.value)
    encoded = materialise(encodings(docs, files), "align-ids")
    counts = materialise(pair_counts(encoded, files, rule), "align-counts")
    counts = counts.withColumn("a", F.shiftright("pair", 16))
    size = len(v.identity)
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    best = _vector(highest, size, "a", "highest")
    same_count = _vector(counts.where("same"), size, "a", "n")
    pairs, n = frequent_pairs(counts.where("not same"), rule.frequent)
    known = spark.sparkContext.broadcast((same_count, best, pairs, n))
    out = materialise(scored(encoded, files, known), "align-scores")
    rest = out.select("row", F.explode(F.arrays_zip("rest_pair", "rest_n")).alias("r")).select("row", F.col("r.rest_pair").alias("pair"), F.col("r.rest_n").alias("times"))
    # ``highest`` has a row per A id at most.
    rest = rest.join(counts, "pair").join(F.broadcast(highest), "a")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = out.drop("rest_pair", "rest_n").join(rest, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
