"""Model selection from result tables."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato import config

CV_SCHEMA = ("family string, family_order int, grid_idx int, params map<string,string>, "
             "fold int, mse double")
BOARD_SCHEMA = ("family string, family_order int, params map<string,string>, "
                "train_r2 double, cv_mse double, depth int")


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid, names in sorted order, the last one fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def params_text(params: dict) -> dict[str, str]:
    return {k: "None" if v is None else str(v) for k, v in params.items()}


def best_grid_point(cv: DataFrame) -> DataFrame:
    """Per family the grid point of least mean error, the first one on ties:
    (family, grid_idx, cv_mse). Two map-side-combined aggregations, no sort."""
    means = cv.groupBy("family", "grid_idx").agg(F.avg("mse").alias("cv_mse"))
    best = F.min(F.struct("cv_mse", "grid_idx")).alias("best")
    return (means.groupBy("family").agg(best)
            .select("family", "best.grid_idx", "best.cv_mse"))


def best_family(board: DataFrame, by: str = "train_r2", largest: bool = True) -> DataFrame:
    """The winning row: best score, first in declared order on ties."""
    score = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    return board.orderBy(score, F.col("family_order")).limit(1)


def choose_family(board: DataFrame, select_by: str = "train") -> DataFrame:
    """The winning row of a leaderboard: highest training R² (``train``) or least
    cross-validated error (``cv``)."""
    if select_by == "cv":
        return best_family(board, "cv_mse", largest=False)
    return best_family(board, "train_r2")


def family_order(family: str) -> int:
    return config.FAMILIES.index(family)
