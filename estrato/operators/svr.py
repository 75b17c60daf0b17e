"""Support-vector regression with a Gaussian kernel, for any number of rows.

The kernel is replaced by random Fourier features (Rahimi and Recht, "Random features
for large-scale kernel machines"): ``width`` cosines of seeded random projections, whose
inner products approximate exp(-gamma * |a - b|²) to about 1/sqrt(width). What is left is
a linear machine: half the square of its weights plus C times the sum of what errors
exceed ``EPSILON`` by. It has no sums of products to solve from, so it is descended:
every scan gives the loss and its slope at two steps of every problem at once, so all
folds and settings of a search share their scans. Tasks send sums of the size of the
weights; neither features nor rows are stored. The kink of the loss is rounded off, less
in each stage; steps are those of limited-memory BFGS, scaled by the products of the
features, which one scan collects and which also give the first weights (ridge).
Once the rows whose error is near a kink are few, they are brought to the driver and all
others, whose loss is a straight line in the weights, to one sum; what is left of the
descent takes no scans, and one more scan proves that no other row has come to a kink.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato import config

#: Random features, and errors that cost nothing.
WIDTH, EPSILON = 256, 0.1
#: Rows whose features are held at once.
CHUNK = 1024
#: Vectors of more slots are projected slot by slot.
DENSE_SLOTS = 2048
#: Least rounding of the kink, by the label's deviation, and what each stage has of the last.
ROUNDING, SHRINK = 5e-3, 0.2
#: The relative gain below which a stage ends, and its steps at most.
GAIN, STEPS = 1e-5, 40
#: Times this in the stages before the last.
EARLY = 100
_MEMORY = 12
#: Numbers that the rows near a kink may have for them to be brought to the driver.
CELLS = 1 << 20


def _uniform(seed: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the seed and two indices alone."""
    with np.errstate(over="ignore"):
        h = (np.asarray(a, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, dtype=np.uint64)[None, :]
             * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed + 1) * np.uint64(0x8CB92BA72F3D8DD7))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def normals(slots: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Standard normal numbers of some vector slots, one for each random feature; any
    task finds the same ones without being sent them."""
    u = _uniform(seed, 2 * slots, np.arange(width))
    v = _uniform(seed, 2 * slots + 1, np.arange(width))
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of a column of vectors, dense or sparse."""
    values = column.field("values")
    size = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), size)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    if sparse.any():
        slot[sparse[row]] = column.field("indices").filter(pa.array(sparse)).flatten().to_numpy()
    return row, slot, values.flatten().to_numpy()


def packed(vectors) -> Column:
    """A column of vectors in fields without NULL lists: the ``indices`` of dense vectors are
    NULL, and Arrow's writer takes a time that grows with the square of a batch's NULL lists."""
    v = F.unwrap_udt(vectors)
    return F.struct(v.getField("type").alias("type"), F.coalesce(v.getField("indices"), F.array().cast("array<int>")).alias("indices"),
                    v.getField("values").alias("values"))


class Lift:
    """Vectors to projections, once, and projections to features for any gamma."""

    def __init__(self, kernel: str, slots: int, width: int, seed: int):
        self.kernel, self.slots, self.width, self.seed = kernel, slots, slots if kernel == "linear" else width, seed
        self.known = normals(np.arange(slots), width, seed).astype(np.float32) if kernel == "rbf" and slots <= DENSE_SLOTS else None
        self.phase = 2 * np.pi * _uniform(seed + 1, np.array([1 << 40]), np.arange(width))[0].astype(np.float32)

    def project(self, column: pa.Array) -> np.ndarray:
        row, slot, value = entries(column)
        if self.kernel == "linear" or self.known is not None:
            x = np.zeros((len(column), self.slots), dtype=float if self.kernel == "linear" else np.float32)
            x[row, slot] = value
            return x if self.kernel == "linear" else x @ self.known
        own, where = np.unique(slot, return_inverse=True)
        known = normals(own, self.width, self.seed)
        out = np.zeros((len(column), self.width))
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else []
        for a in range(0, len(first), 256):  # some rows at a time: their entries are as wide as the features
            lo, hi = first[a], first[a + 256] if a + 256 < len(first) else len(row)
            cuts = first[a:a + 256] - lo
            out[row[first[a:a + 256]]] = np.add.reduceat(known[where[lo:hi]] * value[lo:hi, None], cuts, axis=0)
        return out

    def features(self, projected: np.ndarray, gamma: float, intercept: bool) -> np.ndarray:
        """In single precision: the cosines only approximate the kernel, and take most of the time."""
        if self.kernel == "linear":
            return np.column_stack([projected, np.ones(len(projected))]) if intercept else projected
        z = np.empty((len(projected), self.width + intercept), dtype=np.float32)
        z[:, self.width:] = 1
        own = (projected * np.float32(np.sqrt(2 * gamma)) + self.phase).astype(np.float32, copy=False)
        np.cos(own, out=own)
        np.multiply(own, np.float32(np.sqrt(2 / self.width)), out=z[:, :self.width])
        return z


def chunks(batches):
    """(fold, label, vectors) of some rows at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.slice(a, CHUNK)
            yield part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), part.column(2)


def _columns(df: DataFrame, fold: str | None, features: str, label: str) -> DataFrame:
    number = F.lit(-1) if fold is None else F.col(fold)
    return df.select(number.cast("int").alias("fold"), F.col(label).cast("double").alias("y"), packed(features).alias("x"))


def _summed(rows: DataFrame, add, size: int) -> dict[int, np.ndarray]:
    """Sums over all chunks of rows of what ``add`` gives, by key: arrays of one size. Tasks
    add up what they read; the cluster adds up tasks, in two levels; the driver gets the sums."""
    def partials(batches):
        sums: dict[int, np.ndarray] = {}
        for fold, y, column in chunks(batches):
            for key, value in add(fold, y, column):
                sums[key] = sums.get(key, 0.0) + value
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.asarray(s, float).tobytes() for s in sums.values()], pa.binary())],
                                         names=["key", "cells"])

    def up(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=float) for c in frame["cells"])
        return pd.DataFrame({"key": frame["key"].iloc[:1], "cells": [total.tobytes()]})

    schema = "key int, cells binary"
    some = rows.mapInArrow(partials, schema)
    if size > 1 << 14:  # large sums are added in lots first
        lot = F.pmod(F.monotonically_increasing_id(), F.lit(16)).alias("lot")
        some = some.select("*", lot).groupBy("key", "lot").applyInPandas(lambda f: up(f), schema)
    found = some.groupBy("key").applyInPandas(up, schema).toArrow()
    return {k: np.frombuffer(c, dtype=float) for k, c in zip(found.column(0).to_pylist(), found.column(1).to_pylist())}


@dataclass
class Problem:
    """One setting, fitted on all rows but those of the fold ``out``."""

    c: float
    gamma: float
    out: int | None
    n: float = 0.0
    weights: np.ndarray | None = None
    rounding: float = 0.0
    least: float = 0.0
    value: float = np.inf
    slope: np.ndarray | None = None
    step: np.ndarray | None = None
    length: float = 1.0
    steps: int = 0
    gain: float = GAIN
    done: bool = False
    spread: tuple | None = None
    zone: float = 1.0
    pairs: list = field(default_factory=list)

    @property
    def penalty(self) -> float:
        return 1.0 / (self.c * self.n)

    @property
    def enough(self) -> float:
        """The gain that ends this stage: others than the last only lead to it."""
        return self.gain if self.rounding <= self.least else EARLY * self.gain

    def points(self) -> list[np.ndarray]:
        """The weights whose loss is to be found next."""
        if self.step is None:
            return [self.weights]
        return [self.weights + self.length * t * self.step for t in (1.0, 0.3)]

    def direction(self) -> np.ndarray:
        q, kept = self.slope.copy(), []
        for s, y in reversed(self.pairs):
            a = s @ q / (y @ s)
            kept.append(a)
            q -= a * y
        vectors, values = self.spread
        q = vectors @ ((vectors.T @ q) / (self.penalty + max(self.zone, 0.02) / self.rounding * values))
        for (s, y), a in zip(self.pairs, reversed(kept)):
            q += s * (a - y @ q / (y @ s))
        return -q

    def learn(self, found: list[tuple[float, float, np.ndarray]], points: list[np.ndarray]) -> None:
        """Take the better of the two steps, shorten them, or go on to less rounding."""
        if self.step is not None:
            k = int(np.argmin([f for f, _, _ in found]))
            value, zone, slope = found[k]
            gain = self.value - value
            if not gain > 0:
                self.length *= 0.1
                self.steps += 1
                if self.length < 1e-4 or self.steps >= STEPS:
                    self.next_stage()
                return
            s, y = points[k] - self.weights, slope - self.slope
            if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs[-_MEMORY + 1:], (s, y)]
            self.weights, self.value, self.zone, self.slope = points[k], value, zone, slope
            self.steps += 1
            if gain <= self.enough * abs(value) or self.steps >= STEPS:
                self.next_stage()
                return
        else:
            (self.value, self.zone, self.slope), self.pairs = found[0], []
        self.length, self.step = 1.0, self.direction()
        if -(self.slope @ self.step) <= self.enough * max(abs(self.value), 1e-300):
            self.next_stage()

    def next_stage(self) -> None:
        self.done = self.rounding <= self.least
        self.rounding, self.step, self.steps, self.length = max(self.rounding * SHRINK, self.least), None, 0, 1.0


class Near:
    """The loss of a problem where only some rows come near a kink, and its least weights."""

    def __init__(self, p: Problem, epsilon: float, inner: np.ndarray, z: np.ndarray, y: np.ndarray, over: float, beyond: float, slope: np.ndarray):
        self.p, self.epsilon, self.z, self.y, self.over, self.beyond, self.slope = p, epsilon, z, y, over, beyond, slope
        self.inner = p.penalty * inner
        vectors, values = p.spread
        self.products = (vectors * values) @ vectors.T
        self.products += 1e-12 * np.trace(self.products) * np.eye(len(inner))

    def share(self, error: np.ndarray, rounding: float) -> np.ndarray:
        return np.clip((np.abs(error) - self.epsilon) / rounding, 0, 1) * np.sign(error)

    def value(self, w: np.ndarray) -> float:
        """Of the last rounding."""
        least = self.p.least
        more = np.abs(self.y - self.z @ w) - self.epsilon
        rows = least * np.clip(more / least, 0, 1) ** 2 / 2 + np.maximum(more - least, 0)
        return (self.over - self.beyond * least / 2 + self.slope @ (w - self.p.weights) + rows.sum()) / self.p.n + (self.inner * w) @ w / 2

    def least(self) -> np.ndarray:
        """Newton's steps, each as long as the slope along it falls."""
        w, rounding = self.p.weights, self.p.rounding
        floor = 1e-13 * np.sqrt(np.diag(self.products))
        while True:
            for _ in range(STEPS):
                error = self.y - self.z @ w
                share = self.share(error, rounding)
                slope = (self.slope - share @ self.z) / self.p.n + self.inner * w
                if (np.abs(slope) <= floor).all():
                    break
                zone = self.z[(np.abs(share) > 0) & (np.abs(share) < 1)]
                bent = zone.T @ zone + 1e-3 * max(len(zone), 1) * self.products
                step = -np.linalg.solve(bent / (self.p.n * rounding) + np.diag(self.inner), slope)
                length = self._length(w, error, step, rounding)
                if not length or (rounding > self.p.least and -(slope @ step) <= 1e-3 * self.p.gain):
                    break
                w = w + length * step
            if rounding <= self.p.least:
                return w
            rounding = max(rounding * SHRINK ** 3, self.p.least)

    def _length(self, w: np.ndarray, error: np.ndarray, step: np.ndarray, rounding: float) -> float:
        """Where the slope along a step is a tenth of that at its beginning, or turns."""
        along, fixed = self.z @ step, self.slope @ step

        def slope(t: float) -> float:
            return (fixed - self.share(error - t * along, rounding) @ along) / self.p.n + (self.inner * (w + t * step)) @ step

        first = low = slope(0.0)
        if not first < 0:
            return 0.0
        a, b = 0.0, 1.0
        while (high := slope(b)) < 0 and b < 1e12:
            if high >= 0.1 * first:
                return b
            a, low, b = b, high, 4 * b
        for k in range(60):
            t = a - low * (b - a) / (high - low) if k % 3 < 2 and high > low else (a + b) / 2
            now = slope(t)
            if abs(now) <= -0.1 * first or not a < t < b:
                return t
            a, low, b, high = (t, now, b, high) if now < 0 else (a, low, t, now)
        return a or b


class Solver:
    """Fits problems on the rows of a written table."""

    def __init__(self, df: DataFrame, fold: str | None, features: str = "features", label: str = "label", kernel: str = "rbf",
                 width: int = WIDTH, epsilon: float = EPSILON, intercept: bool = True, seed: int = config.SEED):
        if kernel not in ("rbf", "linear"):
            raise ValueError(f"no such kernel: {kernel}")
        one = df.select(features).first()
        if one is None:
            raise ValueError("no rows to fit")
        self.rows, self.slots = _columns(df, fold, features, label), int(one[0].size)
        if kernel == "linear" and self.slots > DENSE_SLOTS:
            raise ValueError(f"{self.slots} slots: a linear machine of so many has no products to start from")
        self.lift = dict(kernel=kernel, slots=self.slots, width=width, seed=seed)
        self.width, self.epsilon, self.intercept = (self.slots if kernel == "linear" else width), epsilon, intercept
        self.moments = self._moments()

    def _moments(self) -> dict[int, np.ndarray]:
        """By fold: rows, sum and sum of squares of all vector entries and of the label."""
        def add(fold, y, column):
            row, _, value = entries(column)
            for k in np.unique(fold):
                own, mine = value[fold[row] == k], y[fold == k]
                yield int(k), np.array([len(mine), own.sum(), own @ own, mine.sum(), mine @ mine])
        return _summed(self.rows, add, 5)

    def without(self, out: int | None) -> np.ndarray:
        return sum(m for k, m in self.moments.items() if k != out)

    def gamma(self, kind, out: int | None = None) -> float:
        """A number; or ``auto``, one over the slots; or ``scale``, that over the variance of all entries too."""
        if kind == "auto":
            return 1.0 / self.slots
        if kind != "scale":
            return float(kind)
        n, total, squares = self.without(out)[:3]
        entries_ = n * self.slots
        variance = squares / entries_ - (total / entries_) ** 2
        return 1.0 / (self.slots * variance) if variance > 0 else 1.0

    def _products(self, wanted: list[tuple[float, int | None]]) -> dict[tuple[float, int | None], np.ndarray]:
        """The products of (features, label) for each gamma and fold left out."""
        size = self.width + self.intercept + 1
        by: dict[float, list[int | None]] = {}
        for gamma, out in wanted:
            by.setdefault(gamma, []).append(out)
        folds = sorted(self.moments)
        # Of a gamma with one fold left out a single sum; else one for each fold, to be subtracted.
        parts = [(g, None if len(outs) > 1 else outs[0], k) for g, outs in by.items() for k in (folds if len(outs) > 1 else [None])]
        lift, intercept = self.lift, self.intercept

        def add(fold, y, column, made={}):
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            projected, last = own.project(column), None
            for i, (g, out, k) in enumerate(parts):
                if g != last:
                    z, last = np.column_stack([own.features(projected, g, intercept), y]), g
                mine = z[fold == k] if k is not None else z if out is None else z[fold != out]
                if len(mine):
                    yield i, (mine.T @ mine).ravel()

        sums = {i: m.reshape(size, size) for i, m in _summed(self.rows, add, size * size).items()}
        out = {}
        for g, outs in by.items():
            for o in outs:
                out[g, o] = sum(sums[i] for i, (h, _, k) in enumerate(parts) if h == g and i in sums and (k is None or k != o))
        return out

    def _losses(self, points: list[tuple[float, int | None, float, np.ndarray]]) -> list[tuple[float, float, np.ndarray]]:
        """(mean loss, share of rows on the rounded kink, slope) at weights, each with its gamma, fold left out and rounding."""
        lift, intercept, epsilon = self.lift, self.intercept, self.epsilon
        by: dict[float, list[int]] = {}
        for i, (gamma, *_) in enumerate(points):
            by.setdefault(gamma, []).append(i)
        groups = [(g, own, np.array([-2 if points[i][1] is None else points[i][1] for i in own]), np.array([points[i][2] for i in own]),
                   np.stack([points[i][3] for i in own], axis=1)) for g, own in by.items()]

        def add(fold, y, column, made={}):
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            projected = own.project(column)
            for g, where, out, rounding, weights in groups:
                z = own.features(projected, g, intercept)
                error = y[:, None] - z @ weights.astype(z.dtype)
                over = np.abs(error) - epsilon
                there = fold[:, None] != out[None, :]
                share = np.clip(over / rounding, 0, 1) * there
                loss = rounding * share * share / 2 + np.maximum(over - rounding, 0) * there
                zone = (over > 0) & (over < rounding) & there
                slope = -(share * np.sign(error)).astype(z.dtype).T @ z
                for j, i in enumerate(where):
                    yield i, np.concatenate([[loss[:, j].sum(), zone[:, j].sum()], slope[j]])

        sums = _summed(self.rows, add, self.width + 3)
        out = []
        for i, (_, left, _, _) in enumerate(points):
            n = self.without(left)[0]
            out.append((sums[i][0] / n, sums[i][1] / n, sums[i][2:] / n))
        return out

    def fit(self, problems: list[Problem], rounding: float = ROUNDING, gain: float = GAIN) -> list[Problem]:
        """All problems, in shared scans; those with weights go on from there."""
        products = self._products(sorted({(p.gamma, p.out) for p in problems}, key=str))
        inner = np.r_[np.ones(self.width), np.zeros(int(self.intercept))]
        spreads = {}
        for p in problems:
            p.n, _, _, total, squares = self.without(p.out)
            if not p.n:
                raise ValueError("no rows to fit")
            deviation = np.sqrt(max(squares / p.n - (total / p.n) ** 2, 0.0))
            p.gain, p.least = gain, max(rounding * deviation, 1e-9 * max(abs(total / p.n), 1.0), 1e-9)
            g = products[p.gamma, p.out] / p.n
            if (p.gamma, p.out) not in spreads:
                values, vectors = np.linalg.eigh(g[:-1, :-1])
                spreads[p.gamma, p.out] = vectors, np.maximum(values, 0)
            p.spread = spreads[p.gamma, p.out]
            p.rounding = max(deviation * (1.0 if p.weights is None else SHRINK ** 2), p.least)
            if p.weights is not None:
                continue
            # The first weights are those of a ridge: the loss with every error on the rounded kink.
            p.weights = np.linalg.solve(g[:-1, :-1] / p.rounding + np.diag(p.penalty * inner + 1e-12 * np.trace(g[:-1, :-1]) / p.rounding),
                                        g[:-1, -1] / p.rounding)
        while any(not p.done for p in problems):
            active = [p for p in problems if not p.done]
            asked = [p.points() for p in active]
            found = iter(self._losses([(p.gamma, p.out, p.rounding, w) for p, own in zip(active, asked) for w in own]))
            before = [p.rounding for p in active]
            for p, own in zip(active, asked):
                p.learn([self._penalised(p, inner, w, *next(found)) for w in own], own)
            self._finish([(p, b) for p, b in zip(active, before) if not p.done and p.rounding < b
                          and 2 * p.zone * p.n * (len(inner) + 1) <= CELLS], inner)
        return problems

    def _far(self, asked: list[tuple[Problem, float]]) -> list[tuple[float, float, float, np.ndarray]]:
        """Of problems and how near a kink is near: (rows near one, rows beyond, what these exceed the tube by, slope)."""
        lift, intercept, epsilon = self.lift, self.intercept, self.epsilon
        told = [(p.gamma, p.out, p.weights, margin) for p, margin in asked]

        def add(fold, y, column, made={}):
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            projected = own.project(column)
            for i, (gamma, out, w, margin) in enumerate(told):
                z = own.features(projected, gamma, intercept)
                error = y - z @ w
                over = np.where(fold != (-2 if out is None else out), np.abs(error) - epsilon, -np.inf)
                far = over > margin
                yield i, np.concatenate([[(np.abs(over) <= margin).sum(), far.sum(), over[far].sum()], -np.sign(error[far]) @ z[far]])

        sums = _summed(self.rows, add, len(told[0][2]) + 3)
        return [(sums[i][0], sums[i][1], sums[i][2], sums[i][3:]) for i in range(len(told))]

    def _near(self, asked: list[tuple[Problem, float]]) -> list[np.ndarray]:
        """(features, label) of the rows near a kink."""
        lift, intercept, epsilon = self.lift, self.intercept, self.epsilon
        told = [(p.gamma, p.out, p.weights, margin) for p, margin in asked]

        def rows(batches):
            own = Lift(**lift)
            for fold, y, column in chunks(batches):
                projected = own.project(column)
                for i, (gamma, out, w, margin) in enumerate(told):
                    z = own.features(projected, gamma, intercept)
                    near = (np.abs(np.abs(y - z @ w) - epsilon) <= margin) & (fold != (-2 if out is None else out))
                    if near.any():
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array(
                            [np.column_stack([z[near], y[near]]).astype(float).tobytes()], pa.binary())], names=["key", "cells"])

        found, parts = self.rows.mapInArrow(rows, "key int, cells binary").toArrow(), [[] for _ in told]
        for k, c in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
            parts[k].append(np.frombuffer(c, dtype=float))
        return [np.concatenate([np.zeros(0), *own]).reshape(-1, len(told[0][2]) + 1) for own in parts]

    def _finish(self, asked: list[tuple[Problem, float]], inner: np.ndarray) -> None:
        """Descend on the rows near a kink alone, where they are few; others change nothing but a
        straight line. A problem is done if a scan shows that this holds at the weights found."""
        far = self._far(asked) if asked else []
        told = [(a, f) for a, f in zip(asked, far) if f[0] * (len(inner) + 1) <= CELLS]
        if not told:
            return
        tried = []
        for (p, margin), (_, beyond, over, slope), rows in zip((a for a, _ in told), (f for _, f in told), self._near([a for a, _ in told])):
            near = Near(p, self.epsilon, inner, rows[:, :-1], rows[:, -1], over, beyond, slope)
            tried.append((p, margin, near.least(), near.value(p.weights)))
        crossed = self._crossed([(p, margin, w) for p, margin, w, _ in tried])
        values = self._losses([(p.gamma, p.out, p.least, w) for (p, _, w, _), n in zip(tried, crossed) if n]) if any(crossed) else []
        for (p, _, w, least), n in zip(tried, crossed):
            if not n:
                p.weights, p.done = w, True
            elif self._penalised(p, inner, w, *values.pop(0))[0] < least:
                p.weights = w

    def _crossed(self, tried: list[tuple[Problem, float, np.ndarray]]) -> list[float]:
        """How many rows that were far from a kink at a problem's weights have come to one at others."""
        lift, intercept, epsilon = self.lift, self.intercept, self.epsilon
        told = [(p.gamma, p.out, p.weights, margin, w, p.least) for p, margin, w in tried]

        def add(fold, y, column, made={}):
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            projected = own.project(column)
            for i, (gamma, out, old, margin, new, rounding) in enumerate(told):
                z = own.features(projected, gamma, intercept)
                was, now = y - z @ old, y - z @ new
                over = np.abs(was) - epsilon
                left = (over > margin) & ~((np.abs(now) - epsilon >= rounding) & (was * now > 0))
                entered = (over < -margin) & (np.abs(now) > epsilon)
                yield i, np.array([((left | entered) & (fold != (-2 if out is None else out))).sum()], dtype=float)

        sums = _summed(self.rows, add, 1)
        return [float(sums[i][0]) for i in range(len(told))]

    @staticmethod
    def _penalised(p: Problem, inner, w, loss, zone, slope):
        return loss + p.penalty * (inner * w) @ w / 2, zone, slope + p.penalty * inner * w

    def held_out(self, problems: list[Problem]) -> list[float]:
        """The mean squared error of each problem on the fold it left out."""
        lift, intercept = self.lift, self.intercept
        told = [(p.gamma, p.out, p.weights) for p in problems]

        def add(fold, y, column, made={}):
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            projected = own.project(column)
            z = {}
            for i, (g, out, w) in enumerate(told):
                if g not in z:
                    z = {g: own.features(projected, g, intercept)}
                error = (y - z[g] @ w)[fold == out]
                if len(error):
                    yield i, np.array([error @ error])

        sums = _summed(self.rows, add, 1)
        return [float(sums[i][0] / self.moments[p.out][0]) for i, p in enumerate(problems)]

    def model(self, p: Problem, prediction: str = "prediction", features: str = "features") -> "SvrModel":
        return SvrModel(weights=p.weights.tolist(), gamma=p.gamma, slots=self.slots, intercept=self.intercept,
                        kernel=self.lift["kernel"], width=self.lift["width"], seed=self.lift["seed"], featuresCol=features, predictionCol=prediction)


def search(df: DataFrame, grid: list[dict], fold: str = "fold", features: str = "features", label: str = "label",
           prediction: str = "prediction", refit: bool = True, **how) -> tuple[list[dict], list["SvrModel"]]:
    """(family, grid_idx, params, fold, mse) for every setting (C, gamma) and fold, and, if ``refit``, the model of
    every setting on all rows, all of them at once. A gamma of ``scale`` is that of all rows, so that the folds share their features."""
    solver = Solver(df, fold, features, label, **how)
    keys = [(i, k) for i in range(len(grid)) for k in [*sorted(solver.moments), *[None] * refit]]
    problems = solver.fit([Problem(float(grid[i].get("C", 1.0)), solver.gamma(grid[i].get("gamma", "scale")), k) for i, k in keys])
    folds = sorted((j for j, (_, k) in enumerate(keys) if k is not None), key=lambda j: problems[j].gamma)
    errors = dict(zip(folds, solver.held_out([problems[j] for j in folds])))
    rows = [{"family": "SVR", "grid_idx": i, "params": grid[i], "fold": k, "mse": errors[j]}
            for j, (i, k) in enumerate(keys) if k is not None]
    return rows, [solver.model(p, prediction, features) for p, (_, k) in zip(problems, keys) if k is None]


def cross_validate(df: DataFrame, grid: list[dict], fold: str = "fold", features: str = "features", label: str = "label",
                   **how) -> list[dict]:
    """The errors of :func:`search` alone."""
    return search(df, grid, fold, features, label, refit=False, **how)[0]


def fit(df: DataFrame, params: dict, features: str = "features", label: str = "label", prediction: str = "prediction",
        start: np.ndarray | None = None, rounding: float = ROUNDING, gain: float = GAIN, **how) -> "SvrModel":
    """A model of one setting (C, gamma) on all rows; ``start`` has weights near its own."""
    solver = Solver(df, None, features, label, **how)
    problem = Problem(float(params.get("C", 1.0)), solver.gamma(params.get("gamma", "scale")), None, weights=start)
    return solver.model(solver.fit([problem], rounding, gain)[0], prediction, features)


class SvrModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted machine. It is stored as its parameters and random numbers' seed; loading needs this package."""

    weights = Param(Params._dummy(), "weights", "weight of each feature, the intercept last", TypeConverters.toListFloat)
    gamma = Param(Params._dummy(), "gamma", "of the kernel", TypeConverters.toFloat)
    slots = Param(Params._dummy(), "slots", "of the vectors", TypeConverters.toInt)
    kernel = Param(Params._dummy(), "kernel", "rbf or linear", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of random features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the random features", TypeConverters.toInt)
    intercept = Param(Params._dummy(), "intercept", "whether there is one", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, weights=None, gamma=1.0, slots=0, kernel="rbf", width=WIDTH, seed=config.SEED, intercept=True,
                 featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setPredictionCol(self, value: str) -> "SvrModel":
        return self._set(predictionCol=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        lift = {k: self.getOrDefault(getattr(self, k)) for k in ("kernel", "slots", "width", "seed")}
        weights, gamma, intercept = np.array(self.getOrDefault(self.weights)), self.getOrDefault(self.gamma), self.getOrDefault(self.intercept)
        made = {}

        @F.arrow_udf("double")
        def predict(column: pa.Array) -> pa.Array:
            own = made.setdefault(0, Lift(**lift)) if not made else made[0]
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            parts = [own.features(own.project(column.slice(a, CHUNK)), gamma, intercept) @ weights for a in range(0, len(column), CHUNK)]
            return pa.array(np.concatenate([np.zeros(0), *parts]))

        return df.withColumn(self.getPredictionCol(), predict(packed(self.getFeaturesCol())))
