"""Saved models: one pipeline (preprocessor + regressor) and one metric file."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

METRIC_SCHEMA = ("mse double, rmse double, mae double, r2 double, features array<string>")


@dataclass
class Artifacts:
    model: PipelineModel
    metrics: dict | None = None
    features: list[str] = field(default_factory=list)


def _model_path(root: str, target: str) -> str:
    return f"{root}/modelo_{target}"


def _metrics_path(root: str, target: str) -> str:
    return f"{root}/metricas_{target}"


def metrics_frame(metrics: DataFrame, features: list[str]) -> DataFrame:
    """A metric row with the feature list, in the stored layout."""
    from pyspark.sql import functions as F

    names = F.lit(list(features)).cast("array<string>") if features else F.array().cast("array<string>")
    return metrics.select("mse", "rmse", "mae", "r2", names.alias("features"))


def write_metrics(frame: DataFrame, root: str, target: str) -> None:
    frame.write.mode("overwrite").json(_metrics_path(root, target))


def read_metrics(spark: SparkSession, root: str, target: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(_metrics_path(root, target))


def save_artifacts(root: str, target: str, model: PipelineModel, metrics: DataFrame,
                   features: list[str]) -> None:
    model.write().overwrite().save(_model_path(root, target))
    write_metrics(metrics_frame(metrics, features), root, target)


def load_artifacts(spark: SparkSession, root: str, target: str) -> Artifacts | None:
    """None without a model; metrics are optional and features default to none."""
    try:
        spark.read.text(_model_path(root, target) + "/metadata").take(1)
    except AnalysisException:
        return None
    found = Artifacts(PipelineModel.load(_model_path(root, target)))
    try:
        row = read_metrics(spark, root, target).first()
    except AnalysisException:
        row = None
    if row is not None:
        found.metrics = {k: row[k] for k in ("mse", "rmse", "mae", "r2")}
        found.features = list(row["features"] or [])
    return found
