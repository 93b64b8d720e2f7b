"""Grid search of linear models and naive Bayes in shared passes.

All folds and grid points advance together.  The training rows are written once
as blocks of sparse rows; a step of the search broadcasts the coefficients of
every model that is still moving and gets back, from one distributed
aggregation, a matrix with a row of losses and gradients per model.  A model is
a generator that asks for values at its next point, so any optimiser joins in.

* Ridge penalties: limited-memory quasi-Newton steps.
* Penalties with an L1 part: coordinate descent on the distributed second-order
  statistics of a working set, along a descending path of penalties whose
  starting sets come from the sequential strong rule; the optimum conditions of
  all features end a point, so screening never changes a result.
* Hinge losses: the quasi-Newton steps on a smoothed hinge, twice less smooth.
* Naive Bayes: closed form from the sums per fold and class.

Objectives are those of MLlib: mean loss, features scaled by their deviation
over the rows of the model, intercept not penalised.  What is broadcast or
returned has ``models x features`` numbers, plus ``working x working`` ones for
each model on an L1 path, whatever the number of rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
BLOCK_ENTRIES = 1 << 19
# Blocks that are read by every pass: products stay in a core's cache, and the
# copies on the way to Python stay small.
PASS_ENTRIES = 1 << 16
ALL_ROWS = -1  # the fold of a model that leaves no row out


@dataclass(frozen=True)
class Settings:
    """``working``: features with second-order statistics at once;
    ``tolerance``: largest violation of the optimum conditions; ``steps``: most
    evaluations of a grid point; ``smooth``: widths of the smoothed hinge and
    ``loose`` the violation left there; ``ratio``: between neighbouring
    penalties of a path."""

    working: int = 256
    tolerance: float = 1e-5
    steps: int = 70
    smooth: tuple[float, ...] = (0.5, 0.1)
    loose: float = 1e-4
    ratio: float = 0.4


@dataclass(frozen=True)
class Point:
    """A model to fit: ``fold`` is left out, ``ALL_ROWS`` leaves none out."""

    model: str
    grid_index: int
    fold: int


@dataclass
class Fitted:
    """Coefficients on the scale of the features; the margin is
    ``weights . x + intercept``.  ``raw`` are those of the raw score of class 1
    where that is not the margin: MLlib's evaluator ranks naive Bayes by the
    joint likelihood of class 1, so the search does too."""

    point: Point
    weights: np.ndarray
    intercept: float
    violation: float = 0.0
    steps: int = 0
    raw: tuple[np.ndarray, float] | None = None


@dataclass
class Moments:
    """Per fold and class: rows and sums; per fold: sums of squares.  Features
    are those of the blocks they were taken from."""

    rows: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    folds: list[int] = field(default_factory=list)

    def of(self, fold: int):
        keep = np.array([f != fold for f in self.folds])
        return self.rows[keep].sum(0), self.sums[keep].sum(0), self.squares[keep].sum(0)

    def live(self) -> np.ndarray:
        """Features that occur in any row."""
        return np.flatnonzero(self.squares.sum(0))

    def only(self, features: np.ndarray) -> Moments:
        return Moments(self.rows, self.sums[:, :, features], self.squares[:, features], self.folds)

    def deviation(self, fold: int) -> np.ndarray:
        rows, sums, squares = self.of(fold)
        n, total = rows.sum(), sums.sum(0)
        if n < 2:
            return np.zeros(len(total))
        return np.sqrt(np.maximum((squares - total * total / n) / (n - 1), 0))


# --- blocks --------------------------------------------------------------------------------------

def feature_blocks(rows: DataFrame, features: str = "features", label: str = "label", fold: str = "fold",
                   most: int = BLOCK_ENTRIES) -> DataFrame:
    """``rows`` as blocks of sparse rows: labels, folds, row ends, feature
    numbers and values as packed arrays.  Rows without label or features have
    no place in a fit and are left out.  A block ends with the row that brings
    it to ``most`` entries."""
    v = F.unwrap_udt(features)
    flat = rows.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"), v["indices"].alias("i"), v["values"].alias("x"),
        F.coalesce(v["size"], F.size(v["values"])).alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for batch in batches:
            for y, f, i, x, size in zip(*(batch.column(k) for k in range(5))):
                values = x.values.to_numpy(zero_copy_only=False)
                at = i.values.to_numpy(zero_copy_only=False) if i.is_valid else np.arange(len(values))
                some = values != 0
                held.append((y.as_py(), f.as_py(), at[some], values[some], size.as_py()))
                entries += int(some.sum())
                if len(held) == BLOCK_ROWS or entries >= most:
                    yield _packed(held)
                    held, entries = [], 0
        if held:
            yield _packed(held)

    return flat.mapInArrow(run, "size int, y binary, f binary, ends binary, i binary, x binary")


def _packed(held) -> pa.RecordBatch:
    y, f, at, values, size = zip(*held)
    arrays = [np.array(y, np.float64), np.array([-2 if k is None else k for k in f], np.int32),
              np.cumsum([len(k) for k in at]).astype(np.int64), np.concatenate(at).astype(np.int32), np.concatenate(values).astype(np.float64)]
    return pa.RecordBatch.from_arrays([pa.array([max(size)], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                                      ["size", "y", "f", "ends", "i", "x"])


class Block:
    """Sparse rows with what products with many coefficient vectors need.
    Products go model by model over contiguous vectors and machine-size
    indices: numpy copies any others once for every model."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def read(name, kind):
            return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

        self.y, self.f, ends, self.x = read("y", np.float64), read("f", np.int32), read("ends", np.int64), read("x", np.float64)
        if "places" in batch.schema.names:
            self.i = _entries(read("i", np.uint8), ends)
            if len(places := _entries(read("places", np.uint8), ends)):
                self.x = self.x.take(places)
        else:
            self.i = read("i", np.int32)
        self.at = self.i.astype(np.intp)
        entries = np.diff(ends, prepend=0)
        self.row = np.repeat(np.arange(len(self.y)), entries)
        # Rows without entries have no sum of their own.
        self.filled = np.flatnonzero(entries)
        self.starts = (ends - entries)[self.filled]

    def margins(self, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
        """rows x models."""
        out = np.zeros((len(weights), len(self.y)))
        if len(self.filled):
            for w, z in zip(weights, out):
                z[self.filled] = np.add.reduceat(w.take(self.at) * self.x, self.starts)
        return out.T + intercepts

    def add_transposed(self, per_row: np.ndarray, out: np.ndarray) -> None:
        """Add to ``out``, models x features, the sums over rows of ``per_row``
        times the row.  Rows that are zero for every model add nothing."""
        at, x, row = self.at, self.x, self.row
        some = per_row.any(1)
        if 4 * np.count_nonzero(some) < 3 * len(some):
            entry = np.flatnonzero(some.take(row))
            at, x, row = at.take(entry), x.take(entry), row.take(entry)
        for c, sums in zip(np.ascontiguousarray(per_row.T), out):
            sums += np.bincount(at, c.take(row) * x, len(sums))

    def columns(self, features: np.ndarray, size: int) -> np.ndarray:
        """Dense columns of some features, and a last one of ones."""
        place = np.full(size, -1)
        place[features] = np.arange(len(features))
        at = place.take(self.at)
        out = np.zeros((len(self.y), len(features) + 1))
        out[:, -1] = 1
        some = at >= 0
        out[self.row[some], at[some]] = self.x[some]
        return out


def _summed(blocks: DataFrame, parts, length: int) -> np.ndarray:
    """Sum over all blocks of ``parts(iterator of blocks)``, a vector of
    ``length`` numbers.  With several tasks the sums of slices are added by
    tasks too, so the driver receives the vector once."""
    slices = max(1, min(32, length >> 16))
    step = -(-length // slices)

    def partial(batches):
        total = parts(Block(b, r) for b in batches for r in range(b.num_rows))
        if total is not None:
            cut = [total[k * step : (k + 1) * step].tobytes() for k in range(slices)]
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array(cut, pa.binary())], ["slice", "part"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(part.as_buffer())
                total[k] = total[k] + own if k in total else own
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["slice", "part"])

    schema = "slice int, part binary"
    found = blocks.mapInArrow(partial, schema)
    if blocks.rdd.getNumPartitions() > 1:
        found = found.repartition(slices, "slice").mapInArrow(add, schema)
    out = np.zeros(length)
    for k, part in found.collect():
        out[k * step : k * step + len(part) // 8] += np.frombuffer(part)
    return out


def moments(blocks: DataFrame, size: int, folds: int) -> Moments:
    """One pass: rows and sums per fold and class, squares per fold.  The last
    fold holds rows without one."""
    n = folds + 1
    shape = n * 2 + n * 2 * size + n * size

    def parts(found):
        rows, sums, squares = np.zeros((n, 2)), np.zeros((n, 2, size)), np.zeros((n, size))
        for b in found:
            fold, label = np.where((b.f >= 0) & (b.f < folds), b.f, folds), (b.y > 0.5).astype(int)
            np.add.at(rows, (fold, label), 1)
            np.add.at(sums, (fold[b.row], label[b.row], b.i), b.x)
            np.add.at(squares, (fold[b.row], b.i), b.x * b.x)
        return np.concatenate([rows.ravel(), sums.ravel(), squares.ravel()])

    flat = _summed(blocks, parts, shape)
    rows, rest = flat[: n * 2].reshape(n, 2), flat[n * 2 :]
    return Moments(rows, rest[: n * 2 * size].reshape(n, 2, size), rest[n * 2 * size :].reshape(n, size), [*range(folds), -2])


def compacted(blocks: DataFrame, live: np.ndarray, size: int) -> DataFrame:
    """Blocks whose features are numbered among ``live``, those that occur:
    what a pass sends and returns is as wide as they are.

    Every pass reads them, so numbers are as short as they can be, and values
    of which a block has few are put down once, with ``places`` among them."""
    place = np.zeros(size, np.int32)
    place[live] = np.arange(len(live), dtype=np.int32)
    sent = blocks.sparkSession.sparkContext.broadcast(place)

    def run(batches):
        for batch in batches:
            features = [_short(sent.value[np.frombuffer(i.as_buffer(), np.int32)], len(live)).tobytes() for i in batch.column("i")]
            values, places = [], []
            for x in batch.column("x"):
                own = np.frombuffer(x.as_buffer())
                distinct, at = np.unique(own, return_inverse=True)
                few = 2 * len(distinct) < len(own)
                values.append((distinct if few else own).tobytes())
                places.append(_short(at, len(distinct)).tobytes() if few else b"")
            columns = {c: batch.column(c) for c in batch.schema.names} | {
                "size": pa.array([len(live)] * batch.num_rows, pa.int32()), "i": pa.array(features, pa.binary()),
                "x": pa.array(values, pa.binary()), "places": pa.array(places, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return blocks.mapInArrow(run, "size int, y binary, f binary, ends binary, i binary, x binary, places binary")


def _short(numbers: np.ndarray, below: int) -> np.ndarray:
    return numbers.astype(np.uint16 if below <= 1 << 16 else np.int32)


def _entries(packed: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What ``_short`` packed, a number per entry."""
    return packed.view(np.uint16 if packed.size == 2 * ends[-1] else np.int32)


# --- one pass for all models -----------------------------------------------------------------------

@dataclass
class Ask:
    """Values at a point: the loss, its gradient and, for ``working``
    features, the second derivatives.  ``width`` smooths a hinge; 0 asks for
    the logistic loss."""

    weights: np.ndarray
    intercept: float
    width: float = 0.0
    working: np.ndarray | None = None


@dataclass
class Values:
    loss: float
    gradient: np.ndarray
    intercept: float
    second: np.ndarray | None = None


def _answers(blocks: DataFrame, asks: list[tuple[int, Ask]], size: int) -> list[Values]:
    """Sums over the rows that each model uses, for all models in one job."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast((
        np.stack([a.weights for _, a in asks]), np.array([a.intercept for _, a in asks]), np.array([a.width for _, a in asks]),
        np.array([fold for fold, _ in asks]), [a.working for _, a in asks]))
    m = len(asks)
    seconds = [0 if a.working is None else (len(a.working) + 1) ** 2 for _, a in asks]
    starts = np.cumsum([m * (size + 2), *seconds])

    def parts(found):
        weights, intercepts, width, folds, working = sent.value
        out = np.zeros(starts[-1])
        main = out[: m * (size + 2)].reshape(m, size + 2)
        for b in found:
            z = b.margins(weights, intercepts)
            used = b.f[:, None] != folds
            sign = np.where(b.y > 0.5, 1.0, -1.0)[:, None]
            short = 1 - sign * z
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-z))
            hinge = width > 0
            w = np.where(hinge, width, 1.0)
            slope = np.clip(short / w, 0, 1)
            loss = np.where(hinge, np.where(short < w, slope * short / 2, short - w / 2), np.logaddexp(0, -sign * z)) * used
            d = np.where(hinge, -sign * slope, p - (sign > 0)) * used
            main[:, 0] += loss.sum(0)
            main[:, 1] += d.sum(0)
            b.add_transposed(d, main[:, 2:])
            for k, features in enumerate(working):
                if features is not None:
                    x = b.columns(features, size)
                    x *= np.sqrt(p[:, k] * (1 - p[:, k]) * used[:, k])[:, None]
                    out[starts[k] : starts[k + 1]] += (x.T @ x).ravel()
        return out

    flat = _summed(blocks, parts, int(starts[-1]))
    sent.destroy()
    main = flat[: m * (size + 2)].reshape(m, size + 2)
    second = [flat[starts[k] : starts[k + 1]].reshape(int(seconds[k] ** 0.5), -1) if seconds[k] else None for k in range(m)]
    return [Values(main[k, 0], main[k, 2:], main[k, 1], second[k]) for k in range(m)]


# --- optimisers: generators that ask for values ------------------------------------------------------

Search = Generator[Ask, Values, tuple[np.ndarray, float, float, int]]


@dataclass
class Scale:
    """Rows of a model and the scale on which its features are penalised; a
    feature that never changes gets no coefficient.

    ``center`` holds means of the features on that scale.  ``theta`` then has
    the intercept of the centred features: the intercept is free, so the
    optimum stays, but features far from zero no longer pull it along."""

    rows: float
    inverse: np.ndarray
    center: np.ndarray | None = None

    def ask(self, theta: np.ndarray, **more) -> Ask:
        shift = 0.0 if self.center is None else self.center @ theta[:-1]
        return Ask(theta[:-1] * self.inverse, theta[-1] - shift, **more)

    def mean(self, v: Values) -> tuple[float, np.ndarray]:
        g = v.gradient * self.inverse
        if self.center is not None:
            g -= self.center * v.intercept
        return v.loss / self.rows, np.append(g, v.intercept) / self.rows

    def second(self, v: Values, working: np.ndarray) -> np.ndarray:
        s = np.append(self.inverse[working], 1.0)
        return v.second * s[:, None] * s / self.rows


def ridge(theta: np.ndarray, penalty: float, scale: Scale, settings: Settings, width: float = 0.0) -> Search:
    """Limited-memory quasi-Newton minimum of loss plus ridge penalty; the
    intercept, last in ``theta``, is free."""

    def total(at, v):
        f, g = scale.mean(v)
        return f + penalty / 2 * at[:-1] @ at[:-1], g + penalty * np.append(at[:-1], 0)

    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    f, g = total(theta, (yield scale.ask(theta, width=width)))
    used = 1
    while used < settings.steps and np.abs(g).max() > settings.tolerance:
        q, stack = g.copy(), []
        for s, y in reversed(pairs):
            a = s @ q / (s @ y)
            stack.append(a)
            q -= a * y
        if pairs:
            q *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1])
        else:
            q /= max(1.0, np.sqrt(g @ g))
        for (s, y), a in zip(pairs, reversed(stack)):
            q += s * (a - y @ q / (s @ y))
        slope, step = -(g @ q), 1.0
        if slope >= 0:
            pairs, q, slope = [], g.copy(), -(g @ g)
        while True:
            new = theta - step * q
            f1, g1 = total(new, (yield scale.ask(new, width=width)))
            used += 1
            if f1 <= f + 1e-4 * step * slope or used >= settings.steps or step < 1e-10:
                break
            step *= min(max(-slope * step / (2 * (f1 - f - slope * step)), 0.1), 0.5)
        if f1 >= f:
            break
        s, y = new - theta, g1 - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[-9:], (s, y)]
        done = f - f1 <= settings.tolerance**2 * max(abs(f), 1e-3)
        theta, f, g = new, f1, g1
        if done:
            break
    return theta, np.abs(g).max(), used


def elastic_net(theta: np.ndarray, l1: float, l2: float, before: float, scale: Scale, settings: Settings) -> Search:
    """Minimum of loss plus ``l1`` and ``l2`` penalties from a start that
    solves the problem of ``before``, the last ``l1``.

    Proximal Newton steps: the working features' second derivatives come from
    the cluster, the quadratic is minimised by coordinate descent here.
    """
    live = scale.inverse > 0

    def total(at, v):
        f, g = scale.mean(v)
        w = at[:-1]
        g[:-1] += l2 * w
        return f + l2 / 2 * w @ w + l1 * np.abs(w).sum(), g

    def violation(at, g):
        w, d = at[:-1], g[:-1]
        return np.where(live, np.where(w != 0, np.abs(d + l1 * np.sign(w)), np.maximum(np.abs(d) - l1, 0)), 0)

    f, g = total(theta, (yield scale.ask(theta)))
    used, screen = 1, (np.abs(g[:-1]) >= 2 * l1 - before) | (theta[:-1] != 0)
    while used < settings.steps:
        broken = violation(theta, g)
        if max(np.where(screen, broken, 0).max(), abs(g[-1])) <= settings.tolerance:
            if broken.max() <= settings.tolerance:
                break
            screen |= broken > 0  # the strong rule was wrong there
        wanted = np.flatnonzero(screen & ((broken > 0) | (theta[:-1] != 0)))
        if len(wanted) > settings.working:
            wanted = np.sort(wanted[np.argsort(-broken[wanted], kind="stable")[: settings.working]])
        values = yield scale.ask(theta, working=wanted)
        used += 1
        change = descent(theta[np.append(wanted, -1)], g[np.append(wanted, -1)], scale.second(values, wanted), l1, l2)
        step = 1.0
        while True:
            new = theta.copy()
            new[wanted] += step * change[:-1]
            new[-1] += step * change[-1]
            f1, g1 = total(new, (yield scale.ask(new)))
            used += 1
            if f1 <= f or used >= settings.steps or step < 1e-6:
                break
            step /= 4
        if f1 > f:
            break
        stuck = f - f1 <= 1e-13 * max(abs(f), 1e-3)
        theta, f, g = new, f1, g1
        if stuck:
            break
    return theta, max(violation(theta, g).max(), abs(g[-1])), used


def descent(at: np.ndarray, g: np.ndarray, second: np.ndarray, l1: float, l2: float, sweeps: int = 200) -> np.ndarray:
    """Coordinate descent on ``g . d + d . second . d / 2`` plus the penalties
    of ``at + d``; the last coordinate is free and ``g`` has the ``l2`` part."""
    n = len(at)
    second = second.copy()
    second[np.arange(n - 1), np.arange(n - 1)] += l2
    diagonal = np.maximum(np.diag(second), 1e-12)
    penalty = np.append(np.full(n - 1, l1), 0.0)
    d, slope = np.zeros(n), g.copy()
    active = np.arange(n)
    for sweep in range(sweeps):
        largest = 0.0
        for j in active:
            u = at[j] + d[j] - slope[j] / diagonal[j]
            shrunk = np.sign(u) * max(abs(u) - penalty[j] / diagonal[j], 0.0) - at[j]
            move = shrunk - d[j]
            if move:
                d[j] = shrunk
                slope += move * second[j]
                largest = max(largest, abs(move) * diagonal[j])
        if largest < 1e-7:
            if len(active) == n:
                break
            active = np.arange(n)  # a last look at all of them
        else:
            active = np.flatnonzero((at + d != 0) | (np.arange(n) == n - 1))
    return d


def ridge_path(points, size, scale, settings) -> Search:
    """Grid points of one mixing value, from the strongest penalty down, each
    from the solution before."""
    theta = np.zeros(size + 1)
    for index, penalty in points:
        theta, off, used = yield from ridge(theta, penalty, scale, settings)
        yield index, theta, off, used


def hinge_path(points, size, scale, settings) -> Search:
    """Grid points one after the other, each less and less smooth."""
    theta = np.zeros(size + 1)
    for index, penalty in points:
        total = 0
        for width in settings.smooth:
            theta, off, used = yield from ridge(theta, penalty, scale, replace(settings, tolerance=settings.loose), width)
            total += used
        yield index, theta, off, total


def net_path(points, share, size, scale, settings) -> Search:
    """As ``ridge_path`` with an L1 share: between grid points the penalty
    falls in even steps, so that the strong rule can screen."""
    theta, total = np.zeros(size + 1), 0
    values = yield scale.ask(theta)
    top = np.abs(scale.mean(values)[1][:-1]).max() / share
    wanted = {penalty: index for index, penalty in points}
    path, at = [], max(top, max(wanted))
    for target in sorted(wanted, reverse=True):
        while at * settings.ratio > target:
            at *= settings.ratio
            path.append(at)
        path.append(target)
        at = target
    before = top * share
    for penalty in path:
        theta, off, used = yield from elastic_net(theta, penalty * share, penalty * (1 - share), before, scale, settings)
        before, total = penalty * share, total + used
        if penalty in wanted:
            yield wanted[penalty], theta, off, total


# --- the search ------------------------------------------------------------------------------------

def _paths(model: str, grid: list[dict]) -> list:
    """The searches of a linear model's grid: a function of (size, scale,
    settings) for each, and whether it is about centred features.  Second-order
    statistics are those of the features as they are."""
    def down(points):
        return sorted(points, key=lambda p: -p[1])

    if model == "LinearSVC":
        return [(lambda size, scale, settings, i=i, p=p: hinge_path([(i, p["regParam"])], size, scale, settings), True) for i, p in enumerate(grid)]
    out = []
    for share in sorted({p["elasticNetParam"] for p in grid}):
        points = down([(i, p["regParam"]) for i, p in enumerate(grid) if p["elasticNetParam"] == share])
        if share:
            out.append((lambda size, scale, settings, points=points, share=share: net_path(points, share, size, scale, settings), False))
        else:
            out.append((lambda size, scale, settings, points=points: ridge_path(points, size, scale, settings), True))
    return out


def fit_linear(blocks: DataFrame, size: int, grids: dict[str, list[dict]], folds: list[int], found: Moments,
               settings: Settings = Settings()) -> tuple[list[Fitted], int]:
    """All grid points of all models for every fold, and the number of passes
    over the blocks."""
    live, out, passes = [], [], 0
    for (model, grid), fold in itertools.product(grids.items(), folds):
        rows, sums, _ = found.of(fold)
        deviation = found.deviation(fold)
        plain = Scale(max(rows.sum(), 1.0), np.divide(1.0, deviation, out=np.zeros(size), where=deviation > 0))
        centred = replace(plain, center=sums.sum(0) / plain.rows * plain.inverse)
        for path, about_means in _paths(model, grid):
            scale = centred if about_means else plain
            live.append([model, fold, scale, path(size, scale, settings), None])

    def advance(entry, values):
        """The next question of a search; finished grid points go to ``out``."""
        model, fold, scale, search, _ = entry
        try:
            said = search.send(values)
            while not isinstance(said, Ask):
                index, theta, off, used = said
                at = scale.ask(theta)
                out.append(Fitted(Point(model, index, fold), at.weights, float(at.intercept), float(off), used))
                said = next(search)
            entry[4] = said
        except StopIteration:
            entry[4] = None
        return entry[4] is not None

    live = [e for e in live if advance(e, None)]
    while live:
        answers = _answers(blocks, [(e[1], e[4]) for e in live], size)
        passes += 1
        live = [e for e, v in zip(live, answers) if advance(e, v)]
    return out, passes


def fit_naive_bayes(size: int, grid: list[dict], folds: list[int], found: Moments, name: str = "NaiveBayes") -> list[Fitted]:
    """Multinomial naive Bayes as a margin between class 1 and class 0."""
    out = []
    for fold, (index, point) in itertools.product(folds, enumerate(grid)):
        rows, sums, _ = found.of(fold)
        smoothing = point["smoothing"]
        prior = np.log(rows + smoothing) - np.log(rows.sum() + 2 * smoothing)
        terms = np.log(sums + smoothing) - np.log(sums.sum(1) + size * smoothing)[:, None]
        out.append(Fitted(Point(name, index, fold), terms[1] - terms[0], float(prior[1] - prior[0]), raw=(terms[1], float(prior[1]))))
    return out


def held_out_scores(blocks: DataFrame, fitted: list[Fitted]) -> DataFrame:
    """``(model, grid_index, fold, label, score)``: raw scores of every fold's
    models on the rows that they have not seen, in one pass."""
    models = [f for f in fitted if f.point.fold != ALL_ROWS]
    raw = [f.raw or (f.weights, f.intercept) for f in models]
    sent = blocks.sparkSession.sparkContext.broadcast((
        np.stack([w for w, _ in raw]), np.array([b for _, b in raw]), [f.point for f in models]))

    def run(batches):
        weights, intercepts, points = sent.value
        for batch in batches:
            for r in range(batch.num_rows):
                b = Block(batch, r)
                for k, p in enumerate(points):
                    own = b.f == p.fold
                    if own.any():
                        z = b.margins(weights[k : k + 1], intercepts[k : k + 1])[own, 0]
                        n = len(z)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([p.model] * n), pa.array([p.grid_index] * n, pa.int32()), pa.array([p.fold] * n, pa.int32()),
                            pa.array((b.y[own] > 0.5).astype(np.int32)), pa.array(z)], ["model", "grid_index", "fold", "label", "score"])

    return blocks.mapInArrow(run, "model string, grid_index int, fold int, label int, score double")


def gathered(blocks: DataFrame) -> DataFrame:
    """Blocks in two partitions a core, or an eighth of their own number where
    that is more.  Every task of a pass returns a whole vector, so what a pass
    shuffles should follow the cores and not the files of the table."""
    n = blocks.rdd.getNumPartitions()
    return blocks.coalesce(min(n, max(2 * blocks.sparkSession.sparkContext.defaultParallelism, -(-n // 8))))


def held(blocks: DataFrame) -> DataFrame:
    """Blocks kept by the executors over the passes of a search; a lost one is
    read again."""
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)
