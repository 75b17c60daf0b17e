"""Evaluation of predictions: residuals, metrics, bounds, importances."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions import columns as C


def add_residual(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 out: str = "residual") -> DataFrame:
    return df.withColumn(out, C.col(label) - C.col(prediction))


def _parts(label: Column, prediction: Column, tag: str = "") -> list[Column]:
    y = F.when(prediction.isNotNull(), label)
    e = label - prediction
    return [F.count(e).alias(f"n{tag}"), F.avg(e * e).alias(f"mse{tag}"),
            F.avg(F.abs(e)).alias(f"mae{tag}"), F.sum(e * e).alias(f"sse{tag}"),
            F.var_pop(y).alias(f"var{tag}")]


def _metrics(tag: str = "") -> list[Column]:
    """From the aggregated parts: mse, rmse, mae, r2, n.

    r2 of a constant label is 1 for perfect predictions, else 0; of fewer than
    two rows it is undefined (NULL)."""
    n, sse = F.col(f"n{tag}"), F.col(f"sse{tag}")
    total = F.col(f"var{tag}") * n
    r2 = (F.when(n < 2, None)
          .when(total == 0, F.when(sse == 0, 1.0).otherwise(0.0))
          .otherwise(1.0 - F.try_divide(sse, total)))
    return [F.col(f"mse{tag}").alias("mse"), F.sqrt(f"mse{tag}").alias("rmse"),
            F.col(f"mae{tag}").alias("mae"), r2.alias("r2"), n.alias("n")]


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, R² and row count in one aggregation (per group of ``by``)."""
    parts = _parts(C.col(label).try_cast("double"), C.col(prediction).try_cast("double"))
    grouped = df.groupBy(*[C.col(b) for b in by]).agg(*parts) if by else df.agg(*parts)
    return grouped.select(*[C.col(b) for b in by], *_metrics())


def compare_predictions(df: DataFrame, predictions: dict[str, str],
                        label: str = "label") -> DataFrame:
    """Metrics of several prediction columns over the same rows: one scan.

    ``predictions`` maps a name to its column; result (name, mse, …, n)."""
    parts, rows = [], []
    y = C.col(label).try_cast("double")
    for i, (name, column) in enumerate(predictions.items()):
        parts += _parts(y, C.col(column).try_cast("double"), str(i))
        rows.append(F.struct(F.lit(name).alias("name"), *_metrics(str(i))))
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def identity_bounds(df: DataFrame, label: str = "label", prediction: str = "prediction",
                    joint: bool = True) -> DataFrame:
    """End points of the identity line: over labels and predictions, or
    (``joint=False``) over labels only."""
    y, p = C.col(label), C.col(prediction)
    if not joint:
        return df.agg(F.min(y).alias("low"), F.max(y).alias("high"))
    return df.agg(F.least(F.min(y), F.min(p)).alias("low"),
                  F.greatest(F.max(y), F.max(p)).alias("high"))


def feature_importance(spark: SparkSession, model, slots: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, one-hot slots summed by feature.

    ``slots`` names the source feature of each vector slot, so widths agree.
    Models without importances give no rows."""
    total: dict[str, float] = dict.fromkeys(slots, 0.0)
    values = getattr(model, "featureImportances", None)
    if values is None:
        total = {}
    else:
        if values.size != len(slots):
            raise ValueError(f"{values.size} importances for {len(slots)} slots")
        for name, value in zip(slots, values.toArray().tolist()):
            total[name] += value
    return spark.createDataFrame(list(total.items()), "feature string, importance double")
