"""Forests of several sizes from one fit."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from estrato.operators import select, trees


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    made = [(float(a := r.randint(0, 40)), float(b := r.randint(0, 9)), a * 0.5 + b * b + r.random() * 4, k % 3)
            for k in range(300)]
    df = spark.createDataFrame(made, "a double, b double, label double, fold int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).drop("a", "b").cache()


def test_first_trees_of_a_forest(spark, rows):
    model = trees.estimator("RandomForest", {"n_estimators": 7, "max_depth": 4}).fit(rows)
    held = rows.collect()
    plain = [[t.predict(r["features"]) for t in model.trees] for r in held]
    sizes = [5, 1, 7, 5]
    wanted = [sum((r["label"] - sum(p[:n]) / n) ** 2 for r, p in zip(held, plain)) / len(held) for n in sizes]
    assert len(set(wanted)) == 3  # rows are drawn, so that trees differ
    assert trees.forest_errors(model, sizes, rows) == pytest.approx(wanted, rel=1e-12)
    whole = model.transform(rows).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert trees.forest_errors(model, [7], rows)[0] == pytest.approx(whole, rel=1e-12)
    assert trees.forest_errors(model, [1, 7], rows.limit(0)) == [None, None]
    for sizes in ([0, 3], [8]):
        with pytest.raises(ValueError):
            trees.forest_errors(model, sizes, rows)


def test_some_trees_predict_their_mean(rows):
    model = trees.estimator("RandomForest", {"n_estimators": 5, "max_depth": 3}).fit(rows)
    some = trees.mean_of_trees(model, 2, 5, prediction="some").transform(rows)
    for r in some.limit(20).collect():
        assert r["some"] == pytest.approx(sum(t.predict(r["features"]) for t in model.trees[2:5]) / 3, rel=1e-12)


@pytest.mark.parametrize("family", ["RandomForest", "GradientBoosting"])
def test_one_fit_for_all_numbers_of_trees(rows, family, monkeypatch):
    fitted, build = [], trees.estimator

    def counting(family, params, *a, **settings):
        made = build(family, params, *a, **settings)
        made.fit = lambda rows, fit=made.fit: fitted.append(params["n_estimators"]) or fit(rows)
        return made

    monkeypatch.setattr(trees, "estimator", counting)
    grid = select.grid_points({"n_estimators": [2, 6, 4], "max_depth": [2, 3]})
    out = trees.cross_validate(rows, family, grid)
    assert fitted == [6] * 6  # two depths and three folds
    assert [(r["grid_idx"], r["fold"]) for r in out] == [(i, k) for k in range(3) for i in range(6)]
    alone = trees.cross_validate(rows, family, [p for p in grid if p["n_estimators"] == 6])
    assert [r["mse"] for r in alone] == pytest.approx([r["mse"] for r in out if r["params"]["n_estimators"] == 6], rel=1e-12)


def test_settings_the_learner_cannot_tell_apart_share_a_fit(rows, monkeypatch):
    fitted, score = [], trees._fit_and_score
    monkeypatch.setattr(trees, "_fit_and_score", lambda *a: fitted.append(a[1]) or score(*a))
    grid = select.grid_points({"n_estimators": [1, 2], "max_depth": [None, 3, 30], "min_samples_split": [2, 3, 10]})
    out = trees.cross_validate(rows.filter("fold < 2"), "RandomForest", grid)
    assert len(fitted) == 2 * 2 * 2  # depths, leaves, folds
    same = {}
    for r in out:
        p = r["params"]
        same.setdefault((r["fold"], p["n_estimators"], p["max_depth"] == 3, p["min_samples_split"] == 10), []).append(r["mse"])
    assert all(len(set(x)) == 1 for x in same.values())
    assert len({x[0] for key, x in same.items() if not key[2]}) == 8  # the learner tells all others apart


@pytest.mark.parametrize("family", ["RandomForest", "GradientBoosting"])
def test_nodes_of_shallow_trees_are_not_stored(spark, family):
    df = spark.createDataFrame([(Vectors.dense(float(i % 13), float(i % 7)), float(i * 37 % 101)) for i in range(300)], ["features", "label"])
    shallow, deep = (trees.estimator(family, {"n_estimators": 2, "max_depth": d}) for d in (trees.SHALLOW, trees.SHALLOW + 1))
    assert not shallow.getCacheNodeIds() and deep.getCacheNodeIds()
    grown, stored = (x.fit(df).toDebugString.split("\n", 1)[1] for x in (shallow, shallow.copy().setCacheNodeIds(True)))
    assert grown == stored
