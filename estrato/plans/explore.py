"""Three looks at a cleaned table: correlations and two depth profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from estrato import config
from estrato.operators import explore, stats


@dataclass
class Exploration:
    correlation: DataFrame       # one row per pair
    vs_profile: DataFrame
    nspt_profile: DataFrame


def explore_table(df: DataFrame) -> Exploration:
    """Lazy results; each reads only its own columns of the table."""
    return Exploration(
        stats.correlation_matrix(df, config.CORRELATION_COLUMNS),
        explore.depth_profile(df, "vs_m_s"),
        explore.depth_profile(df, "nspt"))
