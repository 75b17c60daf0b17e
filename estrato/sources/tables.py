"""The cleaned table, and CSV in and out for those who want it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato import config
from estrato.functions import columns as C


# Cells are written as they are: no trimming, NULL as an empty cell.
CSV = dict(header=True, nullValue="", emptyValue="", escape='"',
           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


class MissingTableError(FileNotFoundError):
    """The table has not been written yet; the message says how to."""


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A written table; CSV needs a schema, so that types are never guessed."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        if fmt == "parquet":
            return reader.parquet(path)
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return reader.csv(path, header=True, escape='"')
    except AnalysisException as e:
        raise MissingTableError(f"no table at {path}: run the ingest first") from e


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", display: bool = False) -> None:
    """Comma-separated with a header, NULL as an empty cell."""
    if display:
        shown = config.display_names()
        df = df.select(*[C.col(c).alias(shown.get(c, c)) for c in df.columns])
    df.write.mode(mode).csv(path, **CSV)


def write_profiles(profiles: DataFrame, path: str, mode: str = "error",
                   location: str = "location", fmt: str = "csv", by_folder: bool = False) -> None:
    """Ordinary files, in which the rows of a location stand together, or
    (``by_folder``) one folder per location, for a few of them. Spaces in a
    location's name are replaced by ``_``.

    Rows are not moved: a location in a third of all rows is written by the
    tasks that hold it.
    """
    out = profiles.withColumn(location, F.replace(C.col(location), F.lit(" "), F.lit("_")))
    writer = (out.write.mode(mode).partitionBy(location) if by_folder
              else out.sortWithinPartitions(location).write.mode(mode))
    if fmt == "csv":
        writer.csv(path, **CSV)
    else:
        writer.format(fmt).save(path)
