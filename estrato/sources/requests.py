"""Profile requests: text input -> typed rows with a location label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C


def parse_requests(df: DataFrame, north: str = "north", east: str = "east",
                   max_depth: str = "max_depth",
                   default_north: float = config.DEFAULT_NORTH,
                   default_east: float = config.DEFAULT_EAST,
                   default_depth: float = config.DEFAULT_MAX_DEPTH,
                   default_location: str = config.DEFAULT_LOCATION) -> DataFrame:
    """Both coordinates or neither; a blank depth is the default depth; text
    that is no depth marks the row as an error. Other columns stay."""
    n = C.parse_number(C.col(north))
    e = C.parse_number(C.col(east))
    given = n.isNotNull() & e.isNotNull()
    text = F.trim(F.coalesce(C.col(max_depth), F.lit("")))
    depth = F.when(text == "", F.lit(default_depth)).otherwise(C.parse_number(text))
    rest = [C.col(c) for c in df.columns if c not in (north, east, max_depth)]
    return df.select(
        *rest,
        F.when(given, n).otherwise(F.lit(default_north)).alias("norte"),
        F.when(given, e).otherwise(F.lit(default_east)).alias("este"),
        depth.alias("max_depth"),
        F.when(given, C.location_label(n, e)).otherwise(F.lit(default_location)).alias("location"),
        F.when(depth.isNull(), F.lit("invalid max_depth")).alias("error"))
