"""Directory of site files -> cleaned Parquet table."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C
from estrato.operators import clean
from estrato.session import materialise
from estrato.sources import site_files, tables

ROW_ID = "muestra_id"
LOT = "__lot"
#: Equal rows that one task numbers at most.
LOT_ROWS = 1 << 20


@dataclass
class CleanTable:
    df: DataFrame                 # the written table; it has no all-NULL column
    files: site_files.SiteFiles
    dropped: list[str]            # all-NULL columns that were left out

    def audit(self) -> DataFrame:
        """Cleaned rows per file (or per site, where a site is a folder), for every
        listed one, and a last row, ``total``,
        of all of them (its ``archivo`` is NULL, its ``reason`` the number of
        rejected files)."""
        rows = self.df.groupBy("archivo").agg(F.count("*").alias("n_rows"))
        files = self.files.files.groupBy("archivo").agg(
            F.max("encoding").alias("encoding"), F.sum("data_rows").alias("data_rows"), F.max("reason").alias("reason"))
        each = files.join(rows, "archivo", "left").select(
            F.lit("file").alias("kind"), "archivo", "encoding", "data_rows",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "reason")
        all_ = each.agg(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("archivo"),
                        F.lit(None).cast("string").alias("encoding"), F.sum("data_rows").alias("data_rows"),
                        F.sum("n_rows").alias("n_rows"), F.count("reason").cast("string").alias("reason"))
        return each.union(all_)


def keyed_rows(df: DataFrame, out: str = ROW_ID) -> tuple[DataFrame, dict[str, int]]:
    """The rows, written, with the digest of their file and cells as ``out``, and the
    number of values of each column, counted while they are written."""
    named = F.struct(*[C.col(c) for c in sorted(df.columns)])
    held = Observation()
    counts = [F.count(C.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    keyed = df.withColumns({out: F.md5(F.to_json(named)), LOT: F.pmod(F.monotonically_increasing_id(), F.lit(16))})
    keyed = materialise(keyed.observe(held, *counts), "keyed-rows")
    return keyed, {c: held.get[f"n{i}"] for i, c in enumerate(df.columns)}


def numbered(keyed: DataFrame, out: str = ROW_ID) -> DataFrame:
    """Keyed rows with a running number in the key where rows are equal.

    Which of several equal rows gets which number makes no difference. They are
    numbered in lots: 16, or so many more that the most frequent row has no more than
    ``LOT_ROWS`` in one, and the lots of a row are numbered from their counts.
    """
    again = keyed.groupBy(out).agg(F.count("*").alias("n")).filter("n > 1")
    again = materialise(again, "equal-rows")
    most = again.agg(F.max("n")).first()[0]
    if most is None:
        return keyed.drop(LOT)
    lots = max(16, -(-most // LOT_ROWS))
    equal = keyed.join(again.select(out), out, "left_semi")
    if lots > 16:
        equal = equal.withColumn(LOT, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lots)))
    # Lots are drawn by place in the scan: written, so that both uses see the same ones.
    equal = materialise(equal, "equal-lots")
    sizes = equal.groupBy(out, LOT).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(out).orderBy(LOT)) - F.col("n")
    sizes = sizes.select(out, LOT, before.alias("__before"))
    place = F.row_number().over(Window.partitionBy(out, LOT).orderBy(F.lit(0)))
    equal = equal.withColumn("__place", place).join(sizes, [out, LOT])
    equal = equal.withColumn(out, F.concat(out, F.lit("-"), (F.col("__place") + F.col("__before")).cast("string")))
    single = keyed.join(again.select(out), out, "left_anti")
    return single.drop(LOT).unionByName(equal.drop(LOT, "__place", "__before"))


def add_row_id(df: DataFrame, out: str = ROW_ID) -> DataFrame:
    """A unique key that a row has in every ingest of the same files: the digest of
    its file and cells, and a running number where rows of a file are equal."""
    return numbered(keyed_rows(df, out)[0], out)


def ingest_directory(spark: SparkSession, raw: str, out: str, pattern: str = "*.csv",
                     numeric: Sequence[str] = config.NUMERIC_COLUMNS, mode: str = "error",
                     decimal_comma: bool = False, csv_out: str | None = None,
                     site_from: str | None = None) -> CleanTable:
    """Ingest, clean and write. The raw text is parsed once, into an intermediate
    table; writing it counts the values of each column, and the table that is kept
    is written without all-NULL columns.

    Each row gets a unique ``muestra_id``, the key of splits and folds. It comes
    from the row itself, so another cluster or layout gives the same split.
    """
    files = site_files.read_site_files(spark, raw, pattern, site_from=site_from, with_file=True)
    cleaned = clean.clean_rows(files.table, numeric, decimal_comma=decimal_comma)
    keyed, held = keyed_rows(cleaned)
    dropped = [c for c in cleaned.columns if not held[c] and c != "archivo"]
    tables.write_table(numbered(keyed).drop(*dropped), out, mode)
    result = tables.load_table(spark, out)
    if csv_out is not None:
        tables.write_csv(result.drop("archivo", ROW_ID), csv_out, mode, display=True)
    return CleanTable(result, files, dropped)
