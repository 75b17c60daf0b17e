"""Depth profiles for any number of locations at once.

A request becomes its depth rows by exploding a sequence; both models score
the same rows one after the other, so there is no join anywhere.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C

Scorer = Callable[[DataFrame], DataFrame]    # adds a prediction column


def depth_grid(df: DataFrame, max_depth: str = "max_depth", points: int = config.PROFILE_POINTS,
               idx: str = "depth_idx", out: str = "profundidad") -> DataFrame:
    """``points`` evenly spaced depths per row, 0 and ``max_depth`` included."""
    steps = F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))
    return (df.withColumn(idx, F.explode(steps))
            .withColumn(out, C.depth_step(C.col(idx), C.col(max_depth), points)))


def profile_grid(requests: DataFrame, points: int = config.PROFILE_POINTS) -> DataFrame:
    """The depth rows of all valid requests.

    Requests are few bytes, their depth rows and scoring are not: requests are
    dealt out evenly before they grow, to the larger of the input's and the
    session's number of tasks: sizes at run time would merge them into one.
    """
    valid = requests.filter("error is null").drop("error")
    tasks = max(valid.rdd.getNumPartitions(), int(valid.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return depth_grid(valid.repartition(tasks), points=points)


def profile_inputs(grid: DataFrame, features: Sequence[str], defaults: dict,
                   given: dict[str, Column] | None = None, keep: Sequence[str] = (),
                   depth_feature: str = "profundidad_media",
                   depth: str = "profundidad") -> DataFrame:
    """Model inputs in the model's feature order.

    A feature comes from the depth, the request's coordinates, ``given``
    columns or the defaults; otherwise it is 0 and listed in
    ``defaulted_features``.
    """
    if depth_feature not in features:
        raise ValueError(f"the model lacks the required feature {depth_feature}")
    source: dict[str, Column] = {depth_feature: C.col(depth)}
    for name in ("norte", "este"):
        if name in grid.columns:
            source[name] = C.col(name).try_cast("double")
    source.update(given or {})
    for name, value in defaults.items():
        source.setdefault(name, F.lit(value))
    absent = [f for f in features if f not in source]
    note = F.array(*[F.lit(f) for f in absent]).cast("array<string>")
    return grid.select(
        *[C.col(k) for k in keep if k not in features],
        *[source.get(f, F.lit(0.0)).alias(f) for f in features],
        note.alias("defaulted_features"))


def predict_profile(grid: DataFrame, features: Sequence[str], defaults: dict, score: Scorer,
                    out: str, given: dict[str, Column] | None = None,
                    keep: Sequence[str] = (), prediction: str = "prediction") -> DataFrame:
    """``grid``'s ``keep`` columns, the prediction named ``out`` and the features
    that were set to 0 for it, ``{out}_defaulted``."""
    held = {k: f"__keep_{i}" for i, k in enumerate(keep)}
    base = grid.withColumns({h: C.col(k) for k, h in held.items()})
    inputs = profile_inputs(base, features, defaults, given, keep=list(held.values()))
    scored = score(inputs)
    return scored.select(*[C.col(h).alias(k) for k, h in held.items()], C.col(prediction).alias(out),
                         C.col("defaulted_features").alias(f"{out}_defaulted"))


KEYS = ("request_id", "location", "depth_idx", "profundidad")


def predict_chain(grid: DataFrame, nspt: tuple[Sequence[str], Scorer] | None,
                  qadm: tuple[Sequence[str], Scorer] | None,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """Blow count, then allowable pressure fed with it, on the same rows.

    Either model may be missing; its column is then NULL, and without the
    first model the second one sees a blow count of 0.
    """
    if nspt is None and qadm is None:
        raise ValueError("no model to predict with")
    coordinates = [c for c in ("norte", "este") if c in grid.columns]
    first, second = config.NSPT.prediction, config.QADM.prediction
    absent = {False: F.lit(None).cast("double"), True: F.lit(None).cast("array<string>")}
    if nspt is not None:
        features, score = nspt
        grid = predict_profile(grid, features, config.NSPT.defaults, score, first, keep=[*keys, *coordinates])
    else:
        grid = grid.withColumns({first: absent[False], f"{first}_defaulted": absent[True]})
    shown = [*keys, first, f"{first}_defaulted"]
    if qadm is None:
        return grid.select(*shown, absent[False].alias(second), absent[True].alias(f"{second}_defaulted"))
    features, score = qadm
    given = {"nspt": C.col(first)} if nspt is not None else None
    return predict_profile(grid, features, config.QADM.defaults, score, second, given=given, keep=shown)
