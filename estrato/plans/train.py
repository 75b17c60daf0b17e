"""Cleaned table -> evaluated and saved model, per target."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.operators import evaluate, features, linear, select, split, svr, trees
from estrato.session import materialise
from estrato.sources import artifacts

LINEAR = ("Linear", "Ridge", "Lasso")
TREES = ("RandomForest", "GradientBoosting")


@dataclass
class Candidate:
    family: str
    params: dict
    model: object
    cv_mse: float | None = None
    train_r2: float | None = None


@dataclass
class Search:
    candidates: list[Candidate]
    cv: list[dict] = field(default_factory=list)

    def cv_frame(self, spark) -> DataFrame:
        return cv_frame(spark, self.cv)

    def leaderboard(self, spark) -> DataFrame:
        """One row per family, with the depth its trees were fitted with."""
        rows = [(c.family, select.family_order(c.family), select.params_text(c.params), c.train_r2, c.cv_mse,
                 trees.depth_of(c.family, c.params) if c.family in TREES else None) for c in self.candidates]
        return spark.createDataFrame(rows, select.BOARD_SCHEMA)

    def best(self, spark, select_by: str = "train") -> Candidate:
        """The winner by :func:`select.choose_family`; declared order on ties."""
        family = select.choose_family(self.leaderboard(spark), select_by).first()["family"]
        return next(c for c in self.candidates if c.family == family)


def cv_frame(spark, cv: list[dict]) -> DataFrame:
    rows = [(r["family"], select.family_order(r["family"]), r["grid_idx"],
             select.params_text(r["params"]), int(r["fold"]), r["mse"]) for r in cv]
    return spark.createDataFrame(rows, select.CV_SCHEMA)


def search_models(train: DataFrame, families: Sequence[str] = config.FAMILIES,
                  grids: dict | None = None, fold: str = "fold", parallelism: int = 2,
                  seed: int = config.SEED) -> Search:
    """Cross-validation of every family and setting, refit of the best setting,
    training score.

    ``train`` has ``features``, ``label`` and ``fold`` and should be a written
    table. The linear families share one scan for all folds and settings and the
    final models, or, beyond ``linear.MAX_SLOTS`` slots, are fitted by iterations;
    so do all settings of the support vectors share theirs, on the folds and on all
    rows. The training scores of all winners come from one more scan.
    """
    grids = config.PARAM_GRIDS if grids is None else grids
    spark = train.sparkSession
    wide = linear.slot_count(train) > linear.MAX_SLOTS
    some = any(f in LINEAR for f in families)
    grams = linear.grams_by_fold(train, fold) if some and not wide else None
    total = linear.total_gram(grams) if grams else linear.label_spread(train)
    result, points = Search([]), {f: select.grid_points(grids.get(f) or {}) for f in families}
    for family in sorted(families, key=select.family_order):
        if family == "SVR":
            rows, machines = svr.search(train, points[family], fold, prediction="prediction_SVR", seed=seed)
        elif family in TREES:
            rows = trees.cross_validate(train, family, points[family], fold, parallelism=parallelism, seed=seed)
        elif wide:
            rows = linear.cross_validate_wide(train, family, points[family], fold)
        else:
            rows = linear.cross_validate(grams, family, points[family])
        result.cv += rows
    chosen = {r["family"]: r for r in select.best_grid_point(cv_frame(spark, result.cv)).collect()}
    for family in sorted(families, key=select.family_order):
        best, cv_mse = points[family][chosen[family]["grid_idx"]], chosen[family]["cv_mse"]
        column = f"prediction_{family}"
        if family in LINEAR and wide:
            model = linear.estimator(family, total, best.get("alpha", 0.0), prediction=column, solver="l-bfgs").fit(train)
        elif family in LINEAR:
            model = linear.fitted(total, family, best.get("alpha", 0.0), prediction=column)
        elif family == "SVR":
            model = machines[chosen[family]["grid_idx"]]
        else:
            model = trees.estimator(family, best, prediction=column, seed=seed).fit(train)
        result.candidates.append(Candidate(family, best, model, cv_mse))
    scored = train.select("features", "label")
    for c in result.candidates:
        scored = c.model.transform(scored)
    names = {c.family: f"prediction_{c.family}" for c in result.candidates}
    scores = {r["name"]: r["r2"] for r in evaluate.compare_predictions(scored, names).collect()}
    for c in result.candidates:
        c.train_r2 = scores[c.family]
        c.model.setPredictionCol("prediction")
    return result


@dataclass
class Trained:
    target: str
    best: Candidate
    search: Search
    preprocessor: features.Preprocessor
    pipeline: PipelineModel
    features: list[str]
    metrics: DataFrame
    evaluated: DataFrame          # test rows: label, prediction, residual

    def importance(self) -> DataFrame:
        return evaluate.feature_importance(self.evaluated.sparkSession, self.best.model,
                                           self.preprocessor.slots)


def train_target(df: DataFrame, preset: config.TargetPreset, keys: Sequence[str],
                 families: Sequence[str] = config.FAMILIES, grids: dict | None = None,
                 select_by: str = "train", parallelism: int = 2, seed: int = config.SEED,
                 save_to: str | None = None) -> Trained:
    """Features, split, preprocessing, search, evaluation, storage.

    The feature rows are written once, then the vectors of the training rows
    are: every fit reads these tables and not the whole plan before them.
    """
    frame = features.feature_frame(df, preset, keys)
    rows = materialise(frame.df, f"rows-{preset.name}")
    rows = split.split_and_folds(rows, keys, seed=seed)
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    pre = features.fit_preprocessor(train, frame.numeric, frame.categorical)
    vectors = materialise(pre.transform(train).select("features", "label", "fold"),
                          f"vectors-{preset.name}")
    used = pre.numeric + pre.categorical      # features without a training value are not in the model
    search = search_models(vectors, families, grids, parallelism=parallelism, seed=seed)
    best = search.best(df.sparkSession, select_by)
    pipeline = PipelineModel([*pre.model.stages, best.model])
    # The scored test rows serve the metrics and every later look at them.
    scored = pipeline.transform(test).select(*keys, "label", "prediction")
    evaluated = materialise(evaluate.add_residual(scored), f"evaluated-{preset.name}")
    metrics = evaluate.regression_metrics(evaluated)
    if save_to is not None:
        artifacts.save_artifacts(save_to, preset.name, pipeline, metrics, used)
    return Trained(preset.name, best, search, pre, pipeline, used, metrics, evaluated)
