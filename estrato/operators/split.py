"""Reproducible train/test split and folds.

Rows are ordered by the md5 of seed and key. A share of that order is a range
of hash values, so a split is a *filter* on a per-row expression: the rows are
never shuffled or sorted. Only the range limits have to be found, by counting
rows per hash prefix; sizes are exact where keys are unique.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from math import ceil
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C

DIGITS = 3             # hash digits resolved per pass: at most 4,096 counters per task
GATHER = 50_000        # hashes a limit's last pass may bring to the driver


def order_hash(keys: Sequence[str], seed: int = config.SEED) -> Column:
    """Position of a row in the shuffled order: md5 of ``seed:key-key-…``.

    Different keys never read alike: ``-`` and ``\\`` within one of several keys
    are escaped, and NULL is ``\\N``.
    """
    parts = [C.col(k).cast("string") for k in keys]
    if len(parts) > 1:
        parts = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit("-"), F.lit("\\-")) for p in parts]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("-", *[F.coalesce(p, F.lit("\\N")) for p in parts])))


@dataclass
class _Limit:
    rank: int                 # rows at or below the limit
    prefix: str = ""          # hash digits known so far
    before: int = 0           # rows with a smaller prefix
    value: str | None = None


def hash_limits(df: DataFrame, hashed: Column,
                ranks: Sequence[int] | Callable[[int], Sequence[int]]) -> list[str | None]:
    """The hash of the row at each rank; rank 0 has none (no row is below).

    ``ranks`` may be a function of the number of rows, which the first pass
    counts anyway. Each pass counts rows per next ``DIGITS`` hash digits within
    the prefixes still open: a filter and a map-side-combined count with a
    bounded number of groups. The last pass reads a few rows. 10^13 rows take
    four passes.

    Rows with equal keys stay together, so equal rows never sit on both sides.
    A limit that falls among them goes to the nearer end of them.
    """
    hashes = df.select(hashed.alias("h"))
    sizes = _prefix_counts(hashes, 0, [])
    if callable(ranks):
        ranks = ranks(sum(n for _, n in sizes))
    limits = [_Limit(r) for r in ranks]
    open_ = [t for t in limits if t.rank > 0]
    while open_:
        last: dict[str, int] = {}
        for t in open_:
            run = t.before
            for p, n in sizes:
                if not p.startswith(t.prefix):
                    continue
                if run + n >= t.rank:
                    t.prefix, t.before = p, run
                    last[p] = n
                    break
                run += n
        wide = [t for t in open_ if last[t.prefix] > GATHER and len(t.prefix) < 32]
        ready = [t for t in open_ if t not in wide]
        if ready:
            _finish(hashes, ready)
        if wide:
            sizes = _prefix_counts(hashes, len(wide[0].prefix), sorted({t.prefix for t in wide}))
        open_ = wide
    return [t.value for t in limits]


def _prefix_counts(hashes: DataFrame, done: int, prefixes: list[str]) -> list[tuple[str, int]]:
    """Rows per hash prefix, ``DIGITS`` longer than the ``done`` known ones."""
    if done:
        hashes = hashes.filter(F.substring("h", 1, done).isin(prefixes))
    counted = (hashes.groupBy(F.substring("h", 1, done + DIGITS).alias("p"))
               .agg(F.count("*").alias("n")).toArrow())
    return sorted(zip(counted["p"].to_pylist(), counted["n"].to_pylist()))


def _finish(hashes: DataFrame, limits: list[_Limit]) -> None:
    done = len(limits[0].prefix)
    prefixes = sorted({t.prefix for t in limits})
    rows = (hashes.filter(F.substring("h", 1, done).isin(prefixes))
            .groupBy("h").agg(F.count("*").alias("n")).toArrow())
    found = sorted(zip(rows["h"].to_pylist(), rows["n"].to_pylist()))
    for t in limits:
        run = t.before
        for h, n in found:
            if not h.startswith(t.prefix):
                continue
            run += n
            if run >= t.rank:
                over, under = run - t.rank, t.rank - (run - n)
                t.value = h if over <= under else f"{max(0, int(h, 16) - 1):032x}"
                break


def fold_sizes(n: int, folds: int) -> list[int]:
    """Sizes of contiguous folds: the first ``n mod folds`` get one row more."""
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def _fold_ends(n: int, folds: int, start: int = 0) -> list[int]:
    """Rank of the last row of each fold but the last."""
    return [start + run for run in itertools.accumulate(fold_sizes(n - start, folds)[:-1])]


def _fold(hashed: Column, limits: Sequence[str | None]) -> Column:
    fold = F.lit(0)
    for h in limits:
        fold = fold + (F.when(hashed > F.lit(h), 1).otherwise(0) if h is not None else F.lit(1))
    return fold.cast("int")


def _at_or_below(hashed: Column, limit: str | None) -> Column:
    return F.lit(False) if limit is None else hashed <= F.lit(limit)


def train_test_split(df: DataFrame, keys: Sequence[str], test_share: float = config.TEST_SHARE,
                     seed: int = config.SEED, out: str = "is_test") -> DataFrame:
    """Add a boolean column that marks exactly ``ceil(share * rows)`` test rows."""
    hashed = order_hash(keys, seed)
    limit, = hash_limits(df, hashed, lambda n: [ceil(test_share * n)])
    return df.withColumn(out, _at_or_below(hashed, limit))


def assign_folds(df: DataFrame, keys: Sequence[str], folds: int = config.FOLDS,
                 seed: int = config.SEED, out: str = "fold") -> DataFrame:
    """Add the fold (0-based) of each row: contiguous parts of the hash order."""
    hashed = order_hash(keys, seed)
    limits = hash_limits(df, hashed, lambda n: _fold_ends(n, folds))
    return df.withColumn(out, _fold(hashed, limits))


def split_and_folds(df: DataFrame, keys: Sequence[str], test_share: float = config.TEST_SHARE,
                    folds: int = config.FOLDS, seed: int = config.SEED) -> DataFrame:
    """Add ``is_test`` and, for training rows, ``fold``. Same rows as splitting
    first and folding the rest, but all limits come from the same passes."""
    hashed = order_hash(keys, seed)

    def ranks(n: int) -> list[int]:
        test = ceil(test_share * n)
        return [test, *_fold_ends(n, folds, test)]

    first, *rest = hash_limits(df, hashed, ranks)
    is_test = _at_or_below(hashed, first)
    if first is None:        # no row at all, or no test rows
        return df.withColumns({"is_test": F.lit(False), "fold": _fold(hashed, rest)})
    return df.withColumns({"is_test": is_test, "fold": F.when(~is_test, _fold(hashed, rest))})
