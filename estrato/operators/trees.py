"""Tree families on the built-in distributed learners."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato import config

UNLIMITED_DEPTH = 30       # the learner's limit stands for "no limit"
MAX_BINS = 32              # values of a feature that splits tell apart, unless set otherwise
SHALLOW = 5                # down to this depth, rows are led from the root again faster than their nodes are stored


def depth_of(family: str, params: dict) -> int:
    """The depth a setting is fitted with: "no limit" is the learner's largest."""
    depth = params.get("max_depth", 3 if family == "GradientBoosting" else None)
    if depth is not None and depth > UNLIMITED_DEPTH:
        raise ValueError(f"max_depth {depth}: the learner goes down to {UNLIMITED_DEPTH}")
    return UNLIMITED_DEPTH if depth is None else depth


def estimator(family: str, params: dict, features: str = "features", label: str = "label",
              prediction: str = "prediction", seed: int = config.SEED):
    """A tree learner for one grid point.

    ``min_samples_split`` s becomes a smallest leaf of s // 2 rows, the nearest
    rule the learner has. ``bootstrap`` (default true) and ``max_bins`` may be
    given too. Nodes of trees deeper than ``SHALLOW`` are cached by row and checkpointed,
    so a lost executor does not restart deep trees.
    """
    base = dict(featuresCol=features, labelCol=label, predictionCol=prediction, seed=seed,
                featureSubsetStrategy="all", cacheNodeIds=depth_of(family, params) > SHALLOW, checkpointInterval=10,
                maxMemoryInMB=512, maxDepth=depth_of(family, params),
                maxBins=params.get("max_bins", MAX_BINS))
    if family == "RandomForest":
        leaf = max(1, params.get("min_samples_split", 2) // 2)
        return RandomForestRegressor(numTrees=params.get("n_estimators", 100), subsamplingRate=1.0,
                                     minInstancesPerNode=leaf, bootstrap=params.get("bootstrap", True), **base)
    if family == "GradientBoosting":
        return GBTRegressor(maxIter=params.get("n_estimators", 100), lossType="squared",
                            stepSize=params.get("learning_rate", 0.1), **base)
    raise ValueError(f"not a tree family: {family}")


def mean_of_trees(model: RandomForestRegressionModel, begin: int, end: int, features: str = "features",
                  prediction: str = "prediction") -> GBTRegressionModel:
    """The mean prediction of the trees ``begin`` to ``end`` of a forest, as a weighted sum of these trees."""
    parts = list(model._java_obj.trees())[begin:end], [1.0 / (end - begin)] * (end - begin)
    gateway = SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, gateway.jvm.double
    arrays = [JavaWrapper._new_java_array(x, kind) for x, kind in zip(parts, kinds)]
    made = GBTRegressionModel(JavaWrapper._new_java_obj(
        "org.apache.spark.ml.regression.GBTRegressionModel", f"{model.uid}_{begin}_{end}", *arrays))
    return made.setFeaturesCol(features).setPredictionCol(prediction)


def forest_errors(model: RandomForestRegressionModel, sizes: Sequence[int], held: DataFrame,
                  features: str = "features", label: str = "label") -> list[float]:
    """The mean squared error of the first trees of a forest, for each of the ``sizes``, from one scan.

    Rows go through each tree once: the trees between two sizes predict together, and
    what they predict is added up. NULL for each size where there are no rows.
    """
    if not 1 <= min(sizes) <= max(sizes) <= model.getNumTrees:
        raise ValueError(f"sizes {sizes} of a forest of {model.getNumTrees} trees")
    scored, so_far, begin, errors = held.select(features, label), F.lit(0.0), 0, {}
    for end in sorted(set(sizes)):
        own = f"__until_{end}"
        scored = mean_of_trees(model, begin, end, features, own).transform(scored)
        so_far = so_far + F.col(own) * (end - begin)
        error = F.col(label) - so_far / end
        begin, errors[end] = end, F.avg(error * error).alias(f"e{end}")
    row = scored.agg(*errors.values()).first()
    return [row[f"e{n}"] for n in sizes]


def _fit_and_score(family: str, params: dict, rounds: list[int], rest: DataFrame, held: DataFrame,
                   features: str, label: str, seed: int) -> list[float]:
    """The held-out error after each number of ``rounds``; the model is dropped here."""
    model = estimator(family, params | {"n_estimators": max(rounds)}, features, label, "prediction", seed).fit(rest)
    if family == "RandomForest":
        return forest_errors(model, rounds, held, features, label)
    errors = model.evaluateEachIteration(held.select(features, label), "squared")
    return [errors[n - 1] for n in rounds]


def cross_validate(df: DataFrame, family: str, grid: list[dict], fold: str = "fold",
                   features: str = "features", label: str = "label",
                   parallelism: int = 2, seed: int = config.SEED) -> list[dict]:
    """(family, grid_idx, params, fold, mse) for every setting and fold.

    A fold is a filter on the written feature table: no copies per fold are
    cached. At most ``parallelism`` models exist at a time; each is scored and
    dropped. Boosting with fewer rounds is the beginning of boosting with more, and
    the first trees of a forest are a smaller forest, so settings that the learner only
    tells apart by the number of trees share one fit.
    """
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    fits: dict[tuple, list[int]] = {}
    for i, params in enumerate(grid):
        learner = estimator(family, params, features, label, seed=seed)
        fits.setdefault(frozenset((p.name, value) for p, value in learner.extractParamMap().items()
                                  if p.name not in ("numTrees", "maxIter")), []).append(i)
    tasks = [(k, own) for k in folds for own in fits.values()]

    def run(task):
        k, own = task
        rounds = [grid[i].get("n_estimators", 100) for i in own]
        rest, held = df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)
        return _fit_and_score(family, grid[own[0]], rounds, rest, held, features, label, seed)

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        mse = {(k, i): e for (k, own), errors in zip(tasks, pool.map(run, tasks)) for i, e in zip(own, errors)}
    return [{"family": family, "grid_idx": i, "params": p, "fold": k, "mse": mse[k, i]}
            for k in folds for i, p in enumerate(grid)]
