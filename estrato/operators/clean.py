"""Cleaning: coercion, derived columns, row and column pruning.

Everything but the column pruning is one narrow projection over the input: no
shuffle, and filters and columns reach the scan.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C
from estrato.operators.stats import FIELDS


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose ``subset`` (default: every column) is entirely NULL."""
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def replace_sentinel(df: DataFrame, columns: Sequence[str],
                     sentinel: str = config.SENTINEL) -> DataFrame:
    return df.withColumns({c: C.sentinel_to_null(C.col(c), sentinel) for c in columns})


def coerce_numeric(df: DataFrame, columns: Sequence[str] = config.NUMERIC_COLUMNS,
                   decimal_comma: bool = False) -> DataFrame:
    """Text columns -> DOUBLE; unparsable and non-finite cells become NULL.
    Names that are absent are skipped; columns already numeric are cast."""
    types = dict(df.dtypes)
    found = [c for c in columns if c in types]
    if not found:
        return df
    # Two projections: the parsed number is computed once and looked at twice.
    parsed = df.withColumns({
        c: C.text_to_double(C.col(c), decimal_comma) if types[c] == "string"
        else C.col(c).try_cast("double") for c in found})
    return parsed.withColumns({c: C.finite(C.col(c)) for c in found})


def coercion_report(df: DataFrame, columns: Sequence[str] = config.NUMERIC_COLUMNS,
                    decimal_comma: bool = False) -> DataFrame:
    """Per column: present cells, parsed cells, cells lost to coercion. One pass."""
    types = dict(df.dtypes)
    names = [c for c in columns if types.get(c) == "string"]
    counts = []
    for i, name in enumerate(names):
        number = C.parse_number(C.col(name), decimal_comma)
        counts += [F.count(C.col(name)).alias(f"p{i}"), F.count(number).alias(f"n{i}")]
    rows = F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"p{i}").alias("present"),
                 F.col(f"n{i}").alias("parsed"),
                 (F.col(f"p{i}") - F.col(f"n{i}")).alias("nulled"))
        for i, name in enumerate(names)])
    return df.agg(*counts).select(F.inline(rows))


def add_mid_depth(df: DataFrame, top: str = "de", bottom: str = "hasta",
                  out: str = "profundidad_media") -> DataFrame:
    """Add the interval's mid-depth unless it exists or an input is missing."""
    if out in df.columns or top not in df.columns or bottom not in df.columns:
        return df
    return df.withColumn(out, C.mid_depth(C.col(top), C.col(bottom)))


def add_test_type(df: DataFrame, item: str = "item", out: str = "tipo_ensayo",
                  overwrite: bool = True) -> DataFrame:
    if item not in df.columns or (out in df.columns and not overwrite):
        return df
    return df.withColumn(out, C.test_type(C.col(item)))


def clean_rows(df: DataFrame, numeric: Sequence[str] = config.NUMERIC_COLUMNS,
               top: str = "de", bottom: str = "hasta", item: str = "item",
               depth: str = "profundidad_media", test_type: str = "tipo_ensayo",
               decimal_comma: bool = False) -> DataFrame:
    """Coerce, derive mid-depth and test type, drop rows without a mid-depth."""
    df = coerce_numeric(df, numeric, decimal_comma)
    df = add_mid_depth(df, top, bottom, depth)
    df = add_test_type(df, item, test_type)
    if depth in df.columns:
        df = df.filter(C.col(depth).isNotNull())
    return df


def null_column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, non_null, total): one aggregation over all columns (one per
    95 columns of a wider table, see ``stats.FIELDS``)."""
    names = list(columns or df.columns)
    parts = [names[i:i + FIELDS - 1] for i in range(0, len(names), FIELDS - 1)]
    return reduce(DataFrame.union, [_null_counts(df, part) for part in parts])


def _null_counts(df: DataFrame, names: list[str]) -> DataFrame:
    counts = [F.count(C.col(c)).alias(f"n{i}") for i, c in enumerate(names)]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"),
                 F.col("total").alias("total"))
        for i, c in enumerate(names)])
    return df.agg(*counts, F.count("*").alias("total")).select(F.inline(rows))


def null_columns(df: DataFrame) -> list[str]:
    """Columns without a single value; every column if there is no row.

    The result is a schema decision, so this runs a job. Call it on a written
    table: the scan is columnar there and the raw text is not parsed again.
    """
    return [r["column"] for r in null_column_profile(df).collect() if r["non_null"] == 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*null_columns(df))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all by column name; a column a frame lacks is NULL there."""
    if not frames:
        raise ValueError("no table to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
