"""Random forests over sparse rows: all folds and grid points in shared passes.

MLlib lays a row out with a number per feature, whatever is zero in it; a table
of hashed words grows by two orders of magnitude, once for each fold.  Here the
rows stay sparse: blocks hold them by feature, as bins of the stored values.  A
pass grows all trees of all forests by a level.  Tasks walk their rows down the
trees and count classes by node, feature and bin; the counts of a tree meet in
one group, which is bounded by nodes, features and bins, and gives the best
split of each node.

The method is MLlib's: bootstrap by Poisson weights, a random subset of the
features for each node, Gini impurity, candidate splits at quantiles of a
sample of rows.  Weights are a function of the row and the tree, so forests do
not depend on the layout of the table.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid_search import ALL_ROWS, Block, Point

BLOCK_ROWS = 8192
BLOCK_ENTRIES = 1 << 22
TREES_PER_TASK = 8
POISSON = np.cumsum([np.exp(-1) / np.prod(np.arange(1, k + 1)) for k in range(12)])


@dataclass(frozen=True)
class Settings:
    """``least`` rows, or ``bins`` squared, give the candidate splits."""

    depth: int
    bins: int
    seed: int
    least: int = 10_000


@dataclass
class Tree:
    """Nodes in the order of their levels; ``left`` is -1 for a leaf, the right
    child follows the left one.  ``rows`` are weighted rows per class."""

    point: Point
    number: int
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0)])
    levels: list[list[int]] = field(default_factory=list)  # split nodes by level
    open: list[int] = field(default_factory=lambda: [0])

    def grow(self, node: int, feature: int, at: int, gain: float, left, right, last: bool) -> None:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, at, len(self.left), gain
        for rows in (left, right):
            if not last and min(rows) > 0:
                self.open.append(len(self.left))
            self.feature.append(-1)
            self.bin.append(-1)
            self.left.append(-1)
            self.gain.append(0.0)
            self.rows.append((float(rows[0]), float(rows[1])))

    def score(self, node: int) -> float:
        a, b = self.rows[node]
        return b / (a + b) if a + b else 0.0


# --- candidate splits and blocks -------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(rows: np.ndarray, *seeds: int) -> np.ndarray:
    """A number in [0, 1) per row hash."""
    key = np.zeros(1, np.uint64)
    for s in seeds:
        key = _mix(key + np.uint64(s + 0x9E3779B97F4A7C15))
    return (_mix(rows ^ key) >> np.uint64(11)) / float(1 << 53)


def _row_hashes(b: Block, ends: np.ndarray) -> np.ndarray:
    """A hash of the entries of each row."""
    out, start = np.empty(len(ends), np.uint64), 0
    i, x = b.i, b.x
    for r, end in enumerate(ends):
        out[r] = zlib.crc32(x[start:end].tobytes(), zlib.crc32(i[start:end].tobytes()))
        start = end
    return _mix(out + np.uint64(1))


def _read(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            b = Block(batch, r)
            yield b, np.frombuffer(batch.column("ends")[r].as_buffer(), np.int64)


def cuts_of(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between ascending distinct values."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = counts.sum() / (most + 1)
    out, now, target = [], counts[0], stride
    for k in range(1, len(values)):
        before, now = now, now + counts[k]
        if abs(before - target) < abs(now - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out[:most])


def candidate_splits(blocks: DataFrame, size: int, settings: Settings) -> np.ndarray:
    """``size x (bins - 1)`` thresholds, infinite beyond a feature's last one."""
    most = settings.bins - 1
    rows = blocks.select(F.sum(F.length("f") / 4)).first()[0]
    share = min(1.0, max(settings.least, settings.bins**2) / rows)

    def sample(batches):
        for b, ends in _read(batches):
            some = _uniform(_row_hashes(b, ends), settings.seed, -1 & 0xFFFF) < share
            entry = some[b.row]
            i = np.append(b.i[entry], np.int32(-1))  # the rows are counted under feature -1
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.append(b.x[entry], float(some.sum())))], ["i", "x"])

    found = blocks.mapInArrow(sample, "i int, x double")
    taken = found.where("i < 0").agg(F.sum("x")).first()[0]

    def cut(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        i, x = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.lexsort((x, i))
        i, x = i[order], x[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1]) if len(i) else [])
        features, packed = [], []
        for a, b in zip(first, np.append(first[1:], len(i))):
            values, counts = np.unique(x[a:b], return_counts=True)
            if b - a < taken:
                at = np.searchsorted(values, 0.0)
                values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(float), at, taken - (b - a))
            features.append(i[a])
            packed.append(cuts_of(values, counts, most).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(features, pa.int32()), pa.array(packed, pa.binary())], ["i", "cuts"])

    out = np.full((size, most), np.inf)
    for i, cuts in found.where("i >= 0").repartition("i").mapInArrow(cut, "i int, cuts binary").collect():
        cuts = np.frombuffer(cuts)
        out[i, : len(cuts)] = cuts
    return out


def _bins(cuts: np.ndarray, features: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Thresholds of the feature below each value, by binary search."""
    most = cuts.shape[1]
    at, step = np.zeros(len(x), np.int64), 1 << (most.bit_length() - 1)
    flat = cuts.ravel()
    while step:
        probe = at + step - 1
        hit = (probe < most) & (flat[features * most + np.minimum(probe, most - 1)] < x)
        at += step * hit
        step >>= 1
    return at


def by_feature(blocks: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Blocks whose entries are ordered by feature: the first entry of each
    feature, rows and bins; per row its class, fold and hash."""
    size, sent = len(cuts), blocks.sparkSession.sparkContext.broadcast(cuts)

    def packed(held):
        n = np.cumsum([0, *(len(b.y) for b, _ in held)])
        i = np.concatenate([b.i for b, _ in held]).astype(np.int64)
        row = np.concatenate([b.row + k for (b, _), k in zip(held, n)])
        bins = _bins(sent.value, i, np.concatenate([b.x for b, _ in held])).astype(np.uint8)
        order = np.argsort(i, kind="stable")
        starts = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(i, minlength=size), out=starts[1:])
        arrays = [np.concatenate([b.y > 0.5 for b, _ in held]).astype(np.uint8), np.concatenate([b.f for b, _ in held]),
                  np.concatenate([_row_hashes(b, ends) for b, ends in held]), starts, row[order].astype(np.uint16), bins[order]]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["y", "f", "h", "starts", "row", "bin"])

    def run(batches):
        held, rows, entries = [], 0, 0
        for b, ends in _read(batches):
            if held and (rows + len(b.y) > BLOCK_ROWS or entries + len(b.i) > BLOCK_ENTRIES):
                yield packed(held)
                held, rows, entries = [], 0, 0
            held.append((b, ends))
            rows, entries = rows + len(b.y), entries + len(b.i)
        if held:
            yield packed(held)

    return blocks.mapInArrow(run, "y binary, f binary, h binary, starts binary, row binary, bin binary")


class Columns:
    """A block by feature."""

    KINDS = {"y": np.uint8, "f": np.int32, "h": np.uint64, "starts": np.int64, "row": np.uint16, "bin": np.uint8}

    def __init__(self, batch: pa.RecordBatch, r: int):
        for name, kind in self.KINDS.items():
            setattr(self, name, np.frombuffer(batch.column(name)[r].as_buffer(), kind))
        self.owner = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int32), np.diff(self.starts))

    def entries(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some features, and the place of each one's
        feature among them."""
        start = self.starts[features]
        n = self.starts[features + 1] - start
        owner = np.repeat(np.arange(len(features)), n)
        return np.arange(len(owner)) + np.repeat(start - np.cumsum(n) + n, n), owner

    def nodes(self, tree: dict, zero: np.ndarray) -> np.ndarray:
        """The node that each row reaches."""
        at = np.zeros(len(self.y), np.int32)
        feature, bins, left = tree["feature"], tree["bin"], tree["left"]
        for split in tree["levels"]:
            # A row without an entry goes where the zeros go.
            child = np.arange(len(left), dtype=np.int32)
            child[split] = left[split] + (zero[feature[split]] > bins[split])
            entry, owner = self.entries(feature[split])
            row, node = self.row[entry], split[owner]
            mine = at[row] == node
            entry, row, node = entry[mine], row[mine], node[mine]
            at = child[at]
            at[row] = left[node] + (self.bin[entry] > bins[node])
        return at


def _blocks(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            yield Columns(batch, r)


# --- growing ---------------------------------------------------------------------------------------

def _sent(tree: Tree) -> dict:
    return {"point": tree.point, "number": tree.number, "feature": np.array(tree.feature, np.int32), "bin": np.array(tree.bin, np.int16),
            "left": np.array(tree.left, np.int32), "levels": [np.array(s, np.int64) for s in tree.levels], "open": np.array(tree.open, np.int64)}


def _subsets(tree: Tree, size: int, count: int, seed: int) -> np.ndarray:
    """The features of each open node, ascending."""
    kind = np.int16 if size < 1 << 15 else np.int32
    draw = (np.random.default_rng([seed, tree.number, node]).choice(size, count, replace=False, shuffle=False) for node in tree.open)
    return np.stack([np.sort(d) for d in draw]).astype(kind)


def _best(counts: np.ndarray, totals: np.ndarray, subset: np.ndarray, zero: np.ndarray):
    """Feature, bin, gain and both sides of the best split of each node;
    ``counts`` is nodes x features x bins x classes."""
    k, m = subset.shape
    rest = totals[:, None] - counts.sum(2)
    counts[np.arange(k)[:, None], np.arange(m), zero[subset]] += rest
    left = counts.cumsum(2)[:, :, :-1]
    right = totals[:, None, None] - left
    n, nl, nr = totals.sum(1), left.sum(3), right.sum(3)

    def impure(part, whole):
        """Gini impurity times rows."""
        whole = np.maximum(whole, 1)
        return 2.0 * part[..., 0] * part[..., 1] / whole

    gain = impure(totals, n)[:, None, None] - impure(left, nl) - impure(right, nr)
    gain = np.where((nl > 0) & (nr > 0), gain, -1.0).reshape(k, -1)
    best = gain.argmax(1)
    f, at = np.divmod(best, left.shape[2])
    j = np.arange(k)
    return subset[j, f], at, gain[j, best] / np.maximum(n, 1), left[j, f, at], right[j, f, at]


def _level(blocks: DataFrame, trees: list[Tree], size: int, zero: np.ndarray, settings: Settings, count: int):
    """The best splits of all open nodes: ``(tree, features, bins, gains, left
    rows, right rows, rows)`` per tree."""
    context = blocks.sparkSession.sparkContext
    some = [t for t, tree in enumerate(trees) if tree.open]
    # Trees of one number have the same weights: they come one after the other.
    some.sort(key=lambda t: trees[t].number)
    subsets: dict = {}
    for t in some:
        key = (trees[t].number, tuple(trees[t].open))
        if key not in subsets:
            subsets[key] = _subsets(trees[t], size, count, settings.seed)
    sent = context.broadcast((
        [(t, _sent(trees[t]), subsets[trees[t].number, tuple(trees[t].open)]) for t in some], zero))
    bins = settings.bins

    def parts(batches):
        asked, zero = sent.value
        for b in _blocks(batches):
            out, number, y = [], None, b.y.astype(bool)
            for t, tree, subset in asked:
                if tree["number"] != number:
                    number = tree["number"]
                    weight = np.searchsorted(POISSON, _uniform(b.h, settings.seed, number), side="right")
                k, m = subset.shape
                # Rows outside the bootstrap, the fold or the open nodes are at k.
                place = np.full(len(tree["left"]), k, np.int32)
                place[tree["open"]] = np.arange(k)
                at = place[b.nodes(tree, zero)]
                at[(weight == 0) | (b.f == tree["point"].fold)] = k
                totals = np.stack([np.bincount(at[~y], weight[~y], k + 1)[:k], np.bincount(at[y], weight[y], k + 1)[:k]], 1)
                features = np.unique(subset)
                if 2 * len(features) > len(zero):
                    # Asked for most features, going along all entries is cheaper.
                    features, entry, owner, row = np.arange(len(zero)), None, b.owner, b.row
                else:
                    entry, owner = b.entries(features)
                    row = b.row[entry]
                asks = np.full((len(features), k + 1), -1, np.int16)
                asks[np.searchsorted(features, subset), np.arange(k)[:, None]] = np.arange(m)
                node = at.take(row)
                own = asks.ravel().take(owner * np.int32(k + 1) + node)
                hit = np.flatnonzero(own >= 0)
                row = row[hit]
                key = (node[hit].astype(np.int64) * m + own[hit]) * bins + b.bin[hit if entry is None else entry[hit]]
                key, where = np.unique(key * 2 + y[row], return_inverse=True)
                counts = np.bincount(where, weight[row], len(key))
                out.append((t, totals.astype(np.int64).tobytes(), key.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()))
                if len(out) == 64:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    def _rows(out):
        t, totals, key, counts = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(t, pa.int32()), *(pa.array(v, pa.binary()) for v in (totals, key, counts))], ["tree", "totals", "key", "counts"])

    def decide(batches):
        asked, zero = sent.value
        subsets = {t: subset for t, _, subset in asked}
        now, totals, counts = None, None, None

        def result():
            subset = subsets[now]
            k, m = subset.shape
            found = _best(counts.reshape(k, m, bins, 2), totals, subset, zero)
            kinds = (np.int32, np.int32, np.float64, np.int64, np.int64)
            packed = [np.ascontiguousarray(v, kind).tobytes() for v, kind in zip((*found, totals), (*kinds, np.int64))]
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)],
                                              ["tree", "feature", "bin", "gain", "below", "above", "rows"])

        for batch in batches:
            for r in range(batch.num_rows):
                t = batch.column(0)[r].as_py()
                own, key, n = (np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in ((1, np.int64), (2, np.int32), (3, np.int32)))
                if t != now:
                    if now is not None:
                        yield result()
                    k, m = subsets[t].shape
                    now, totals, counts = t, np.zeros((k, 2), np.int64), np.zeros(k * m * bins * 2, np.int64)
                totals += own.reshape(-1, 2)
                counts[key] += n  # a block has a key once
        if now is not None:
            yield result()

    schema = "tree int, totals binary, key binary, counts binary"
    tasks = -(-len(some) // TREES_PER_TASK)
    met = blocks.mapInArrow(parts, schema).repartition(tasks, "tree").sortWithinPartitions("tree")
    kinds = (np.int32, np.int32, np.float64, np.int64, np.int64, np.int64)
    try:
        found = met.mapInArrow(decide, "tree int, feature binary, bin binary, gain binary, below binary, above binary, rows binary").collect()
    finally:
        sent.destroy()
    for r in sorted(found, key=lambda r: r.tree):
        feature, at, gain, below, above, rows = (np.frombuffer(v, kind) for v, kind in zip(r[1:], kinds))
        yield r.tree, feature, at, gain, below.reshape(-1, 2), above.reshape(-1, 2), rows.reshape(-1, 2)


def grow(blocks: DataFrame, cuts: np.ndarray, points: list[tuple[Point, int]], settings: Settings) -> list[Tree]:
    """The trees of the forests ``points``, each with its number of trees, over
    blocks by feature."""
    size = len(cuts)
    zero = (cuts < 0).sum(1).astype(np.int64)
    trees = [Tree(point, number) for point, n in points for number in range(n)]
    # One tree asks all features, as MLlib does.
    count = size if max(n for _, n in points) == 1 else int(np.ceil(np.sqrt(size)))
    for depth in range(settings.depth):
        if not any(t.open for t in trees):
            break
        for t, feature, at, gain, below, above, rows in _level(blocks, trees, size, zero, settings, count):
            tree = trees[t]
            nodes, tree.open, split = tree.open, [], []
            for j, node in enumerate(nodes):
                tree.rows[node] = (float(rows[j][0]), float(rows[j][1]))
                if gain[j] > 1e-12:
                    tree.grow(node, int(feature[j]), int(at[j]), float(gain[j]), below[j], above[j], depth + 1 == settings.depth)
                    split.append(node)
            tree.levels.append(split)
    return trees


# --- what is read from trees ------------------------------------------------------------------------

def held_out_scores(blocks: DataFrame, cuts: np.ndarray, trees: list[Tree], name: str) -> DataFrame:
    """``(model, grid_index, fold, label, score)``: the scores of every fold's
    forest on the rows that it has not seen."""
    forests: dict[Point, list] = {}
    for t in trees:
        if t.point.fold != ALL_ROWS:
            forests.setdefault(t.point, []).append((_sent(t), np.array([t.score(n) for n in range(len(t.left))])))
    sent = blocks.sparkSession.sparkContext.broadcast((forests, (cuts < 0).sum(1)))

    def run(batches):
        forests, zero = sent.value
        for b in _blocks(batches):
            for point, own in forests.items():
                mine = b.f == point.fold
                n = int(mine.sum())
                if n:
                    score = sum(scores[b.nodes(tree, zero)[mine]] for tree, scores in own) / len(own)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * n), pa.array([point.grid_index] * n, pa.int32()), pa.array([point.fold] * n, pa.int32()),
                        pa.array(b.y[mine].astype(np.int32)), pa.array(score)], ["model", "grid_index", "fold", "label", "score"])

    return blocks.mapInArrow(run, "model string, grid_index int, fold int, label int, score double")


def importances(trees: list[Tree]) -> dict[int, float]:
    """Gain times rows per feature: each tree's sum to one, and so do all."""
    out: dict[int, float] = {}
    for t in trees:
        own: dict[int, float] = {}
        for node, left in enumerate(t.left):
            if left >= 0:
                own[t.feature[node]] = own.get(t.feature[node], 0.0) + t.gain[node] * sum(t.rows[node])
        whole = sum(own.values())
        for f, v in own.items():
            out[f] = out.get(f, 0.0) + v / whole
    whole = sum(out.values())
    return {f: v / whole for f, v in out.items()}
