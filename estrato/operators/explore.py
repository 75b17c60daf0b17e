"""Value-versus-depth series."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.functions import columns as C
from estrato.operators.clean import add_mid_depth


def depth_profile(df: DataFrame, measure: str, depth: str = "profundidad_media",
                  series: Sequence[str] = ("tipo_ensayo", "item"),
                  top: str = "de", bottom: str = "hasta") -> DataFrame:
    """(series, value, depth) of all rows with a value and a depth.

    The series is the first of ``series`` that exists; without one there is a
    single unnamed series. Rows without a series name belong to none.
    """
    df = add_mid_depth(df, top, bottom, depth)
    absent = [c for c in (depth, measure) if c not in df.columns]
    if absent:
        raise ValueError("a depth profile needs " + ", ".join(absent))
    rows = df.filter(C.col(depth).isNotNull() & C.col(measure).isNotNull())
    found = next((c for c in series if c in df.columns), None)
    if found is None:
        name = F.lit("")
    else:
        name = C.col(found)
        rows = rows.filter(name.isNotNull())
    return rows.select(name.alias("series"), C.col(measure).alias("value"),
                       C.col(depth).alias("depth"))


def profile_summary(profile: DataFrame) -> DataFrame:
    """Points and ranges per series; merges map-side, so a hot series is cheap."""
    return profile.groupBy("series").agg(
        F.count("*").alias("points"),
        F.min("value").alias("value_min"), F.max("value").alias("value_max"),
        F.min("depth").alias("depth_min"), F.max("depth").alias("depth_max"))


def series_count(profile: DataFrame) -> DataFrame:
    """Number of series, and whether a chart needs a legend."""
    return (profile.agg(F.countDistinct("series").alias("n_series"))
            .select("n_series", (F.col("n_series") > 1).alias("legend")))
