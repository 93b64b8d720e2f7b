"""Word and shingle hashes of whole Arrow text batches, with numpy.

Words are ``[^\\x20\\x09-\\x0D]+``.  A batch of texts is one byte buffer, so a
word hash is a difference of prefix sums and no Python loop runs per word.
Batches are cut into pieces of bounded size; only a single text longer than
the piece size makes a longer piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x2545F4914F6CDD1D


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x + _ODD).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(256, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(name: str, n: int) -> np.ndarray:
    have = _POWERS[name]
    if len(have) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, 2 * len(have), PIECE_BYTES + 1)
        steps = np.full(size, np.uint64(base), np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[name] = have = np.multiply.accumulate(steps)
    return have[:n]


class Piece:
    """Some texts of a batch as one buffer with the words found in it.

    ``first_row`` is the place of the first text in the batch, ``starts`` and
    ``ends`` are byte positions of words, ``owner`` the text (0-based in the
    piece) of each word and ``counts`` the words per text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int):
        self.data, self.offsets, self.first_row = data, offsets, first_row
        n = len(data)
        space = np.ones(n + 1, bool)
        space[:n] = _SPACE[data]
        begins = ~space[:n]
        begins[1:] &= space[: n - 1]
        # A word also begins where a text begins.
        edges = np.unique(offsets[:-1][offsets[:-1] < n])
        begins[edges] = ~space[edges]
        self.starts = np.flatnonzero(begins)
        stops = space.copy()
        stops[edges] = True
        stop_at = np.flatnonzero(stops)
        self.ends = stop_at[np.searchsorted(stop_at, self.starts, side="right")] if len(self.starts) else self.starts
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def rows(self) -> int:
        return len(self.counts)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word, the same for equal words anywhere."""
        data = _LOWER[self.data] if lower else self.data
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE_CODES[data] * _powers("up", len(data)), out=sums[1:])
            raw = (sums[self.ends] - sums[self.starts]) * _powers("down", len(data) + 1)[self.starts]
            return mix(raw ^ (self.ends - self.starts).astype(np.uint64))

    def core_hashes(self, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """As ``word_hashes`` of the letters alone, in lower case: punctuation
        and digits around or inside a word do not count.  Then, for each length
        in ``prefixes``, hashes of so many leading bytes of the letters, 0 for
        words that are no longer."""
        data = _LOWER[self.data]
        letter = _LETTER[data]
        place = np.zeros(len(data) + 1, np.int64)
        np.cumsum(letter, out=place[1:])
        codes = data[letter]
        a, b = place[self.starts], place[self.ends]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_BYTE_CODES[codes] * _powers("up", len(codes)), out=sums[1:])
            down = _powers("down", len(codes) + 1)[a]
            out = [mix(((sums[b] - sums[a]) * down) ^ (b - a).astype(np.uint64))]
            for k in prefixes:
                stop = np.minimum(a + k, len(codes))
                out.append(np.where(b - a > k, mix(((sums[stop] - sums[a]) * down) ^ np.uint64(k << 40)), np.uint64(0)))
        return out

    def sentence_of(self) -> np.ndarray:
        """Sentence (0-based in the piece) of each word.  A sentence ends after
        a word that ends with one of ``.!?``, at a line break and with its text."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64)
        ends = np.isin(self.data[self.ends - 1], np.frombuffer(b".!?", np.uint8))
        breaks = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(self.data == 10, out=breaks[1:])
        ends[:-1] |= breaks[self.starts[1:]] > breaks[self.ends[:-1]]
        ends[:-1] |= self.owner[1:] != self.owner[:-1]
        return np.concatenate([[0], np.cumsum(ends[:-1])])

    def code_points(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Byte positions as code-point positions inside their texts."""
        points = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=points[1:])
        return points[at] - points[self.offsets[owner]]

    def shingles(self, hashes: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words and the text of each.  With
        ``short`` a text of fewer words has its whole sequence as one."""
        n = len(hashes)
        total = np.zeros(max(n - k + 1, 0), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                total = mix(total * _M1 + hashes[j : j + len(total)])
        owner = self.owner[: len(total)]
        inside = owner == self.owner[k - 1 : k - 1 + len(total)] if n >= k else np.zeros(0, bool)
        total, owner = total[inside], owner[inside]
        if short:
            few = np.flatnonzero((self.counts > 0) & (self.counts < k))
            if len(few):
                extra = np.zeros(len(few), np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(k - 1):
                        live = self.counts[few] > j
                        extra[live] = mix(extra[live] * _M1 + hashes[self.first[few[live]] + j])
                    extra = mix(extra + self.counts[few].astype(np.uint64))
                total, owner = np.concatenate([total, extra]), np.concatenate([owner, few])
        return total, owner


def pieces(texts: pa.Array) -> Iterator[Piece]:
    """The texts of an Arrow column (null: empty) in pieces of about
    ``PIECE_BYTES``; every text is whole in one piece."""
    texts = texts.cast(pa.large_binary()) if len(texts) else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield Piece(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], row)
        row = stop


def distinct_sets(shingles: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values per text and where each text's values begin."""
    order = np.lexsort((shingles, owner))
    s, o = shingles[order], owner[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    s, o = s[keep], o[keep]
    return s, np.searchsorted(o, np.arange(rows + 1))
