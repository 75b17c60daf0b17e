"""Request table + saved models -> chained depth profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato import config
from estrato.operators import predict
from estrato.sources import artifacts, tables
from estrato.sources.requests import parse_requests


@dataclass
class Prediction:
    profiles: DataFrame      # request_id, location, depth_idx, profundidad, both predictions
    errors: DataFrame        # requests without a profile: request_id, location, error
    defaults: DataFrame      # target, feature: inputs of a model that were set to 0


def predict_requests(spark: SparkSession, requests: DataFrame, models: str,
                     points: int = config.PROFILE_POINTS) -> Prediction:
    """Profiles of all valid requests, and what was wrong with the others."""
    found = {name: artifacts.load_artifacts(spark, models, name) for name in config.TARGETS}
    usable = {name: (a.features, a.model.transform) for name, a in found.items()
              if a is not None and a.features}
    if not usable:
        raise FileNotFoundError(f"no trained model in {models}: run the training first")
    parsed = parse_requests(requests)
    scored = predict.predict_chain(predict.profile_grid(parsed, points), usable.get("nspt"), usable.get("qadm"))
    notes = [f"{t.prediction}_defaulted" for t in config.TARGETS.values()]
    # The same for every row of a model, so the columns of one depth row tell all.
    listed = F.array(*[F.struct(F.lit(name).alias("target"), F.col(f"{t.prediction}_defaulted").alias("features"))
                       for name, t in config.TARGETS.items()])
    defaults = (scored.select(*notes).limit(1).select(F.inline(listed))
                .select("target", F.explode("features").alias("feature")))
    return Prediction(scored.drop(*notes), parsed.filter("error is not null").select("request_id", "location", "error"), defaults)


def export_requests(spark: SparkSession, requests: DataFrame, models: str, out: str,
                    mode: str = "error", fmt: str = "csv", by_folder: bool = False) -> Prediction:
    """Write profiles to ``out``, errors to ``out-errors``, features that were set
    to 0 to ``out-defaults``."""
    done = predict_requests(spark, requests, models)
    tables.write_profiles(done.profiles, out, mode, fmt=fmt, by_folder=by_folder)
    tables.write_table(done.errors, f"{out}-errors", mode)
    tables.write_table(done.defaults, f"{out}-defaults", mode)
    return done
