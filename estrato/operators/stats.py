"""Exact statistics that keep every task and the driver small.

Spark's exact ``median`` and ``mode`` keep all distinct values of a column in
one aggregation buffer, so at scale a single task holds the column. Here order
statistics are found by narrowing a value range with samples and exact counts,
and category counts are spread over the cluster before the winner is taken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import sqrt
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions import columns as C

# Whole-stage code stops at 100 fields (spark.sql.codegen.maxFields), and an
# aggregation beyond it is about ten times slower: wide ones are split.
FIELDS = 96
SAMPLE = 4_000_000     # most rows sampled per narrowing pass
GATHER = 200_000       # values that may come together to be sorted
WIDTH = 4              # standard errors on each side of a sampled quantile
ACCURACY = 10_000      # of the quantiles taken from a sample


def aggregate_row(df: DataFrame, parts: Sequence[tuple[int, Sequence[Column]]]) -> dict:
    """All aggregates as one dict. ``parts`` are (buffer fields, columns) that
    belong together; as many as fit share a scan."""
    out: dict = {}
    batch: list[Column] = []
    used = 0
    for fields, exprs in [*parts, (FIELDS + 1, [])]:
        if batch and used + fields > FIELDS:
            out.update(df.agg(*batch).first().asDict())
            batch, used = [], 0
        batch += exprs
        used += fields
    return out


@dataclass
class _Target:
    """One wanted order statistic: the ``rank``-th smallest value (from 1)."""

    column: str
    rank: int
    inside: int                  # values in the open range that holds the value
    low: float | None = None     # None = unbounded
    high: float | None = None
    upto: int = 0                # values at or below ``low``
    value: float | None = None

    @property
    def x(self) -> Column:
        return C.col(self.column).try_cast("double")

    def held(self, low: float | None, high: float | None) -> Column:
        keep = self.x.isNotNull()
        if low is not None:
            keep = keep & (self.x > F.lit(low))
        if high is not None:
            keep = keep & (self.x < F.lit(high))
        return keep


def order_statistics(df: DataFrame, wanted: dict[str, Sequence[int]],
                     counts: dict[str, int] | None = None) -> dict[str, list[float]]:
    """Exact ``rank``-th smallest values of numeric columns.

    While more than ``GATHER`` values are left, a sample proposes a range
    around the rank and one counting scan proves where the rank is; a proposal
    that missed only costs a pass. The last values are sorted. Scans are plain
    filters and counters for all targets at once; memory is bounded by the
    sample and ``GATHER``. 10^13 rows take three rounds.
    """
    if counts is None:
        counts = value_counts(df, list(wanted))
    targets = {(c, r): _Target(c, r, counts[c]) for c, ranks in wanted.items() for r in ranks}
    for t in targets.values():
        if not 1 <= t.rank <= t.inside:
            raise ValueError(f"rank {t.rank} outside 1..{t.inside} of {t.column}")
    seed = 0
    while True:
        open_ = [t for t in targets.values() if t.value is None]
        wide = [t for t in open_ if t.inside > GATHER]
        if not wide:
            break
        seed += 1
        groups = list(_by_range(wide).values())
        _count(df, list(zip(groups, _propose(df, groups, seed))))
    _gather(df, list(_by_range(open_).values()))
    return {c: [targets[c, r].value for r in ranks] for c, ranks in wanted.items()}


def value_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    row = aggregate_row(df, [(1, [F.count(C.col(c).try_cast("double")).alias(f"n{i}")])
                             for i, c in enumerate(columns)])
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def _by_range(targets: list[_Target]) -> dict[tuple, list[_Target]]:
    """Targets that look into the same range, such as a middle pair."""
    out: dict[tuple, list[_Target]] = {}
    for t in targets:
        out.setdefault((t.column, t.low, t.high), []).append(t)
    return out


def _any_present(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()


def _propose(df: DataFrame, groups: list[list[_Target]], seed: int):
    """Per group a range that most likely holds its ranks, from a sample just
    large enough to leave an eighth of ``GATHER``."""
    drawn, quantiles = [], []
    for i, group in enumerate(groups):
        t, n = group[0], group[0].inside
        size = min(SAMPLE, max(10_000, (32 * n / GATHER) ** 2))
        chosen = t.held(t.low, t.high) & (F.rand(seed) < F.lit(size / n))
        drawn.append(F.when(chosen, t.x).alias(f"x{i}"))
        edges = []
        for rank, side in ((min(g.rank for g in group), -1), (max(g.rank for g in group), 1)):
            p = (rank - t.upto) / n
            error = WIDTH * max(sqrt(p * (1 - p) / size), 1 / size) + 1 / ACCURACY
            edges.append(min(1.0, max(0.0, p + side * error)))
        quantiles.append(F.percentile_approx(f"x{i}", edges, ACCURACY).alias(f"q{i}"))
    names = [f"x{i}" for i in range(len(groups))]
    row = df.select(*drawn).filter(_any_present(names)).agg(*quantiles).first()
    return [tuple(row[f"q{i}"] or (None, None)) for i in range(len(groups))]


def _count(df: DataFrame, proposals) -> None:
    """Count around each proposed range and move the range of its targets.

    A proposal without a sample counts nothing; its targets are drawn again.
    """
    known = [(i, group, low, high) for i, (group, (low, high)) in enumerate(proposals)
             if low is not None]
    row = aggregate_row(df, [
        (4, [F.count_if(group[0].x < F.lit(low)).alias(f"below{i}"),
             F.count_if(group[0].x == F.lit(low)).alias(f"low{i}"),
             F.count_if(group[0].held(low, high)).alias(f"inside{i}"),
             F.count_if(group[0].x == F.lit(high)).alias(f"high{i}")])
        for i, group, low, high in known])
    for i, group, low, high in known:
        below = row[f"below{i}"]
        at_low = below + row[f"low{i}"]
        inside = at_low + row[f"inside{i}"]
        at_high = inside + (row[f"high{i}"] if high != low else 0)  # NaN is the largest
        for t in group:
            if t.rank <= below:
                t.high, t.inside = low, below - t.upto
            elif t.rank <= at_low:
                t.value = low
            elif t.rank <= inside:
                t.low, t.high, t.upto, t.inside = low, high, at_low, row[f"inside{i}"]
            elif t.rank <= at_high:
                t.value = high
            else:
                t.inside = t.upto + t.inside - at_high
                t.low, t.upto = high, at_high


def _gather(df: DataFrame, groups: list[list[_Target]]) -> None:
    """Sort the few values left per range and pick the wanted ones."""
    if not groups:
        return
    left = [F.when(g[0].held(g[0].low, g[0].high), g[0].x).alias(f"x{i}")
            for i, g in enumerate(groups)]
    few = df.select(*left).filter(_any_present([f"x{i}" for i in range(len(groups))]))
    # Equal lists are collected once; only the wanted values reach the driver.
    row = few.agg(*[
        F.sort_array(F.collect_list(f"x{i}"))[t.rank - t.upto - 1].alias(f"v{i}_{j}")
        for i, group in enumerate(groups) for j, t in enumerate(group)]).first()
    for i, group in enumerate(groups):
        for j, t in enumerate(group):
            t.value = row[f"v{i}_{j}"]


def exact_medians(df: DataFrame, columns: Sequence[str],
                  counts: dict[str, int] | None = None) -> dict[str, float | None]:
    """Median per column, NULLs ignored; the middle pair is averaged. A column
    without values has no median."""
    counts = value_counts(df, columns) if counts is None else counts
    wanted = {c: [(counts[c] + 1) // 2, counts[c] // 2 + 1] for c in columns if counts[c] > 0}
    found = order_statistics(df, wanted, counts) if wanted else {}
    return {c: (found[c][0] + found[c][1]) / 2 if c in found else None for c in columns}


@dataclass(frozen=True)
class Moments:
    n: int
    mean: float | None
    var: float | None    # population variance

    def with_constant(self, value: float, rows: int) -> "Moments":
        """Moments after adding ``rows`` copies of ``value``: imputing a column
        changes its moments in closed form, so no second scan is needed."""
        if rows == 0:
            return self
        if self.n == 0:
            return Moments(rows, value, 0.0)
        n = self.n + rows
        delta = value - self.mean
        mean = self.mean + delta * rows / n
        var = (self.n * self.var + delta * delta * self.n * rows / n) / n
        return Moments(n, mean, var)


@dataclass(frozen=True)
class NumericProfile:
    median: float | None
    observed: Moments
    imputed: Moments | None      # after filling NULLs with the median


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> dict[str, NumericProfile]:
    """Median, mean and population variance per column, before and after
    median imputation. The moments after it need no scan of their own."""
    if not columns:
        return {}
    parts = [(1, [F.count("*").alias("total")])]
    for i, name in enumerate(columns):
        x = C.col(name).try_cast("double")
        parts.append((6, [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                          F.var_pop(x).alias(f"v{i}")]))
    row = aggregate_row(df, parts)
    medians = exact_medians(df, columns, {c: row[f"n{i}"] for i, c in enumerate(columns)})
    out = {}
    for i, name in enumerate(columns):
        seen = Moments(row[f"n{i}"], row[f"m{i}"], row[f"v{i}"])
        filled = None
        if medians[name] is not None:
            filled = seen.with_constant(medians[name], row["total"] - seen.n)
        out[name] = NumericProfile(medians[name], seen, filled)
    return out


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) of all text columns in one shuffle.

    Counting merges map-side, so a value in a third of all rows costs one row
    per task in the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), C.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).filter("value is not null")
            .groupBy("feature", "value").agg(F.count("*").alias("n")))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n): most frequent value, the smallest one on ties."""
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("value")))
    return (category_counts(df, columns).groupBy("feature").agg(best.alias("best"))
            .select("feature", "best.value", (-F.col("best.order")).alias("n")))


# --- correlation ------------------------------------------------------------

def numeric_columns(df: DataFrame) -> list[str]:
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def correlation_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The wanted columns that exist, or every numeric column."""
    if columns:
        found = [c for c in columns if c in df.columns]
        if not found:
            raise ValueError("none of the wanted columns exists")
        return found
    return numeric_columns(df)


def _null_if_absent(batch) -> np.ndarray:
    """Rows by columns, NaN where a value is absent or not finite."""
    x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
    return np.where(np.isfinite(x), x, np.nan)


#: Columns of a block, and bytes of the sums of pairs of blocks that a task holds in one scan.
CORR_BLOCK, CORR_BYTES = 256, 256 << 20


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs over their pairwise-complete rows.

    Long form (idx_a, idx_b, var_a, var_b, corr, n), both triangles and the
    diagonal. A pair with a constant side has no correlation: NULL. Values that are
    not finite are absent. One scan for as many pairs of blocks of columns as a task can
    hold sums of: a task adds up the products of its batches, of values shifted by a
    constant of each column; each pair of blocks is added up across the cluster, and
    finished, by itself.
    """
    names = correlation_columns(df, columns)
    values = df.select(*[C.col(c).try_cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    p = len(names)
    near = values.limit(1000).agg(*[F.avg(f"c{i}") for i in range(p)]).first()   # any constant does
    shift = np.array([0.0 if v is None or not np.isfinite(v) else v for v in near])
    cuts = [(a, min(a + CORR_BLOCK, p)) for a in range(0, p, CORR_BLOCK)]
    pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
    at_once = max(1, CORR_BYTES // (80 * min(CORR_BLOCK, p) ** 2))
    found = []
    for k in range(0, len(pairs), at_once):
        found.append(_pair_sums(values, pairs[k:k + at_once], cuts, shift, names))
    return reduce(DataFrame.union, found)


def _pair_sums(values: DataFrame, pairs: list[tuple[int, int]], cuts: list[tuple[int, int]], shift: np.ndarray, names: list[str]) -> DataFrame:
    used = sorted({i for pair in pairs for i in pair})
    own = [c for i in used for c in range(*cuts[i])]
    place = {i: slice(own.index(cuts[i][0]), own.index(cuts[i][0]) + cuts[i][1] - cuts[i][0]) for i in used}
    moved = shift[own]

    def ranges(x, mask, other):
        """Least and largest of each column over the rows where each column of ``other`` is
        there: once for each set of rows, as most columns have the same ones."""
        if mask.all() and other.all():
            return tuple(np.repeat(f(axis=0, initial=w)[:, None], other.shape[1], axis=1) for f, w in ((x.min, np.inf), (x.max, -np.inf)))
        rows, which = np.unique(other, axis=1, return_inverse=True)
        low, high = np.full((x.shape[1], other.shape[1]), np.inf), np.full((x.shape[1], other.shape[1]), -np.inf)
        for k in range(rows.shape[1]):
            both, to = mask & rows[:, k:k + 1], which.ravel() == k
            low[:, to] = np.where(both, x, np.inf).min(axis=0, initial=np.inf)[:, None]
            high[:, to] = np.where(both, x, -np.inf).max(axis=0, initial=-np.inf)[:, None]
        return low, high

    def partials(batches):
        sums, least, most = {}, {}, {}
        for batch in batches:
            x = _null_if_absent(batch) - moved
            mask = ~np.isnan(x)
            x, m = np.where(mask, x, 0.0), mask.astype(np.float64)
            for k, (i, j) in enumerate(pairs):
                a, b = place[i], place[j]
                u, v, mu, mv = x[:, a], x[:, b], m[:, a], m[:, b]
                part = np.stack([u.T @ v, (u * u).T @ mv, mu.T @ (v * v), u.T @ mv, mu.T @ v, mu.T @ mv])
                low, high = ranges(u, mask[:, a], mask[:, b])
                low2, high2 = ranges(v, mask[:, b], mask[:, a])
                low, high = np.stack([low, low2.T]), np.stack([high, high2.T])
                sums[k] = sums[k] + part if k in sums else part
                least[k] = np.minimum(least[k], low) if k in least else low
                most[k] = np.maximum(most[k], high) if k in most else high
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), *(pa.array([np.ascontiguousarray(x[k]).tobytes() for k in sums], pa.binary()) for x in (sums, least, most))],
            names=["pair", "sums", "least", "most"])

    def add_up(frame):
        arrays = {c: [np.frombuffer(v) for v in frame[c]] for c in ("sums", "least", "most")}
        return pd.DataFrame({"pair": frame["pair"].iloc[:1], "sums": [sum(arrays["sums"]).tobytes()],
                             "least": [np.minimum.reduce(arrays["least"]).tobytes()], "most": [np.maximum.reduce(arrays["most"]).tobytes()]})

    def finish(frame):
        one = add_up(frame).iloc[0]
        i, j = pairs[int(one["pair"])]
        (a0, a1), (b0, b1) = cuts[i], cuts[j]
        shape = a1 - a0, b1 - b0
        cross, uu, vv, u, v, n = np.frombuffer(one["sums"]).reshape(6, *shape)
        varies = (np.frombuffer(one["least"]) < np.frombuffer(one["most"])).reshape(2, *shape).all(axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            corr = np.clip((cross - u * v / n) / np.sqrt((uu - u * u / n) * (vv - v * v / n)), -1, 1)
        a, b = (x.ravel() for x in np.meshgrid(np.arange(a0, a1), np.arange(b0, b1), indexing="ij"))
        corr, n, known = np.where(a == b, 1.0, corr.ravel()), n.ravel().astype(np.int64), (varies & (n > 0)).ravel()
        if i != j:      # the other triangle, too
            a, b, corr, n, known = np.r_[a, b], np.r_[b, a], np.r_[corr, corr], np.r_[n, n], np.r_[known, known]
        return pd.DataFrame({"idx_a": a, "idx_b": b, "var_a": [names[k] for k in a], "var_b": [names[k] for k in b],
                             "corr": [float(c) if k else None for c, k in zip(corr, known)], "n": n})

    schema = "pair int, sums binary, least binary, most binary"
    some = (values.select(*[f"c{c}" for c in own]).mapInArrow(partials, schema)
            .withColumn("lot", F.pmod(F.monotonically_increasing_id(), F.lit(16)).cast("int"))
            .groupBy("pair", "lot").applyInPandas(add_up, schema))
    return some.groupBy("pair").applyInPandas(finish, "idx_a int, idx_b int, var_a string, var_b string, corr double, n long")


def lower_triangle(matrix: DataFrame, digits: int = 2) -> DataFrame:
    """The half of the matrix a heat map shows, rounded for its labels."""
    return (matrix.filter("idx_a > idx_b")
            .select("idx_a", "idx_b", "var_a", "var_b",
                    F.round("corr", digits).alias("corr"), "n"))


def pivot_matrix(matrix: DataFrame) -> DataFrame:
    """Square form of the long matrix, one row per variable. The pivot values
    are the few variable names, given so that no extra job looks for them."""
    names = [r["var_b"] for r in
             matrix.select("idx_b", "var_b").distinct().orderBy("idx_b").collect()]
    return (matrix.groupBy("idx_a", "var_a").pivot("var_b", names)
            .agg(F.first("corr")).orderBy("idx_a").drop("idx_a"))
