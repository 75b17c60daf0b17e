import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from estrato.operators import linear


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    x[:, 3] = x[:, 0] > 0
    y = 1000 + x @ np.array([3.0, -2.0, 0.0, 5.0]) + rng.normal(size=400)
    fold = np.arange(400) % 5
    rows = [(*map(float, x[i]), float(y[i]), int(fold[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, fold int")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df.repartition(6))
    return x, y, fold, df


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def test_grams_give_the_closed_form(data):
    x, y, fold, df = data
    grams = linear.grams_by_fold(df)
    assert sorted(grams) == [0, 1, 2, 3, 4]
    for family, alpha in [("Linear", 0.0), ("Ridge", 10.0)]:
        w, b = linear.solve(linear.total_gram(grams), family, alpha)
        want, wb = ridge(x, y, alpha)
        assert np.allclose(w, want) and b == pytest.approx(wb)
    for row in linear.cross_validate(grams, "Ridge", [{"alpha": 0.1}, {"alpha": 10.0}]):
        rest = fold != row["fold"]
        w, b = ridge(x[rest], y[rest], row["params"]["alpha"])
        e = y[~rest] - x[~rest] @ w - b
        assert row["mse"] == pytest.approx((e ** 2).mean())


@pytest.mark.parametrize("family,alpha", [("Linear", 0.0), ("Ridge", 0.1), ("Ridge", 10.0),
                                          ("Lasso", 0.1), ("Lasso", 1.0)])
def test_built_in_fit_has_the_same_optimum(data, family, alpha):
    x, y, _, df = data
    gram = linear.total_gram(linear.grams_by_fold(df))
    w, b = linear.solve(gram, family, alpha)
    model = linear.estimator(family, gram, alpha).fit(df)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-5)
    assert model.intercept == pytest.approx(b, abs=1e-4)


def test_lasso_meets_its_optimality_conditions(data):
    x, y, _, df = data
    gram = linear.total_gram(linear.grams_by_fold(df))
    w, b = linear.solve(gram, "Lasso", 0.5)
    slope = x.T @ (y - x @ w - b) / len(y)
    for j in range(4):
        if w[j] == 0:
            assert abs(slope[j]) <= 0.5 + 1e-9
        else:
            assert slope[j] == pytest.approx(0.5 * np.sign(w[j]), abs=1e-8)


def test_collinear_levels(spark, data):
    *_, df = data
    both = df.withColumn("e", 1 - F.col("d"))
    both = VectorAssembler(inputCols=["a", "d", "e"], outputCol="f2").transform(both)
    gram = linear.total_gram(linear.grams_by_fold(both, features="f2"))
    w, b = linear.solve(gram, "Linear")
    assert w[1] == pytest.approx(-w[2])          # least-norm solution
    model = linear.estimator("Linear", gram, features="f2").fit(both)
    got = np.array([r[0] for r in model.transform(both).orderBy("a").select("prediction").collect()])
    rows = both.orderBy("a").select("a", "d", "e").collect()
    want = np.array([[*r] for r in rows]) @ w + b
    assert np.allclose(got, want, atol=1e-4)


def wide_rows(spark, n, slots, folds=5):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        own = sorted(set(rng.integers(2, slots, 3).tolist()))
        x = {0: float(i % 7), 1: float(i % 3), **{j: 1.0 for j in own}}
        rows.append((Vectors.sparse(slots, x), 3.0 * x[0] - 2.0 * x[1] + 10, i % folds))
    return spark.createDataFrame(rows, ["features", "label", "fold"])


def test_blocks_cover_the_matrix(spark, data, monkeypatch):
    whole = linear.grams_by_fold(data[3])
    monkeypatch.setattr(linear, "BLOCK", 3)
    for k, g in linear.grams_by_fold(data[3]).items():
        assert np.allclose(g.matrix, whole[k].matrix)


def test_wide_vectors_are_searched_by_iterations(spark):
    from estrato.plans import train
    df = wide_rows(spark, 120, 5000, 2).repartition(2).cache()
    found = train.search_models(df, ["Linear", "Ridge"], {"Ridge": {"alpha": [0.1, 100.0]}})
    assert [c.family for c in found.candidates] == ["Linear", "Ridge"]
    assert found.candidates[1].params == {"alpha": 0.1} and all(c.train_r2 > 0.9 for c in found.candidates)


def test_iterations_agree_with_the_matrices(data):
    *_, df = data
    grams = linear.grams_by_fold(df)
    for family in ("Linear", "Ridge", "Lasso"):
        a = linear.cross_validate(grams, family, [{"alpha": 0.5}])
        b = linear.cross_validate_wide(df, family, [{"alpha": 0.5}])
        assert [r["mse"] for r in a] == pytest.approx([r["mse"] for r in b], rel=1e-4)


def test_lasso_says_when_it_did_not_converge():
    with pytest.warns(UserWarning, match="not converged"):
        linear._lasso(np.array([[1.0, 0.99], [0.99, 1.0]]), np.array([1.0, 0.5]), 0.01, rounds=2)


@pytest.mark.parametrize("family,alpha", [("Linear", 0.0), ("Ridge", 1.0), ("Lasso", 0.1)])
def test_model_from_the_matrix(data, tmp_path, family, alpha):
    """The final model has the solver's coefficients, predicts with them, and comes back from storage."""
    from pyspark.ml import PipelineModel
    x, _, _, df = data
    gram = linear.total_gram(linear.grams_by_fold(df))
    w, b = linear.solve(gram, family, alpha)
    model = linear.fitted(gram, family, alpha, prediction="p")
    model.setPredictionCol("q")
    PipelineModel([model]).write().save(f"file:{tmp_path}/model")
    rows = PipelineModel.load(f"file:{tmp_path}/model").transform(df).select("a", "b", "c", "d", "q").collect()
    assert np.allclose([r["q"] for r in rows], np.array([r[:4] for r in rows]) @ w + b, rtol=0, atol=1e-8)
    assert np.allclose(model.getOrDefault("coefficients"), w, atol=1e-12)
