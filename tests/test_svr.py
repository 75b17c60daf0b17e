"""Support-vector regression against an exact machine on the kernel matrix."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from estrato.operators import svr


def exact(kernel, y, c, epsilon=svr.EPSILON, rounds=60_000):
    """Dual coefficients and intercept by changing two of them at a time."""
    n = len(y)
    b, g = np.zeros(n), y.copy()            # g: y - K b
    for _ in range(rounds):
        up = np.where(b < c, g - np.where(b < 0, -epsilon, epsilon), -np.inf)
        down = np.where(b > -c, g - np.where(b > 0, epsilon, -epsilon), np.inf)
        i, j = int(np.argmax(up)), int(np.argmin(down))
        if up[i] - down[j] < 1e-6:
            break
        step = (up[i] - down[j]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
        step = min(step, (0 if b[i] < 0 else c) - b[i], b[j] - (0 if b[j] > 0 else -c))
        b[i], b[j] = b[i] + step, b[j] - step
        g -= step * (kernel[:, i] - kernel[:, j])
    return b, (up[i] + down[j]) / 2


def frame(spark, x, y, fold=None, sparse=False):
    vector = (lambda a: Vectors.sparse(len(a), {k: float(v) for k, v in enumerate(a) if v})) if sparse else (lambda a: Vectors.dense(a))
    rows = [(k, vector(a), float(b), int(f)) for k, (a, b, f) in enumerate(zip(x, y, np.arange(len(y)) % 3 if fold is None else fold))]
    return spark.createDataFrame(rows, ["id", "features", "label", "fold"]).repartition(4)


def predicted(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(4)
    x = r.normal(size=(150, 3))
    x[:, 2] = x[:, 2] > 0
    return x, 5 * np.sin(1.5 * x[:, 0]) + x[:, 1] + 3 * x[:, 2] + r.normal(size=150) * 0.3 + 20


def test_linear_machine_is_the_exact_one(spark, data):
    x, y = data
    for c in (0.01, 1.0):
        b, at = exact(x @ x.T, y, c)
        model = svr.fit(frame(spark, x, y), {"C": c}, kernel="linear", rounding=1e-6, gain=1e-12)
        assert np.allclose(predicted(model, frame(spark, x, y)), x @ (x.T @ b) + at, atol=0.01)


def test_many_random_features_approach_the_kernel_machine(spark, data):
    x, y = data
    gamma = 1 / (3 * x.var())
    b, at = exact(np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1)), y, 1.0)
    want = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1)) @ b + at
    few, many = (np.abs(predicted(svr.fit(frame(spark, x, y), {"C": 1.0, "gamma": "scale"}, width=w), frame(spark, x, y)) - want).mean() for w in (16, 2000))
    assert many < 0.1 < few


def test_folds_and_settings_at_once(spark, data):
    x, y = data
    df, fold = frame(spark, x, y), np.arange(150) % 3
    grid = [{"C": c, "gamma": g} for c in (0.1, 10) for g in ("scale", "auto")]
    found = svr.cross_validate(df, grid, width=64)
    assert [(r["grid_idx"], r["fold"]) for r in found] == [(i, k) for i in range(4) for k in range(3)]
    for r in found[::5]:
        rest = fold != r["fold"]
        model = svr.fit(frame(spark, x[rest], y[rest]), r["params"], width=64)
        error = predicted(model, frame(spark, x[~rest], y[~rest])) - y[~rest]
        assert r["mse"] == pytest.approx((error ** 2).mean(), rel=0.02)


def test_gamma_of_the_rows_fitted_on(spark, data):
    x, y = data
    solver = svr.Solver(frame(spark, x, y), "fold")
    assert solver.gamma("auto") == pytest.approx(1 / 3)
    assert solver.gamma("scale", 1) == pytest.approx(1 / (3 * x[np.arange(150) % 3 != 1].var()))
    assert svr.Solver(frame(spark, np.ones((9, 2)), np.arange(9.0)), "fold").gamma("scale") == 1.0


def test_stored_and_sparse(spark, data, tmp_path, monkeypatch):
    x, y = data
    x = np.where(np.abs(x) < 0.5, 0, x)
    dense, sparse = frame(spark, x, y), frame(spark, x, y, sparse=True)
    model = svr.fit(dense, {"C": 1.0}, width=32)
    PipelineModel([model]).write().save(f"file:{tmp_path}/model")
    again = PipelineModel.load(f"file:{tmp_path}/model")
    assert np.allclose(predicted(again, sparse), predicted(model, dense))
    monkeypatch.setattr(svr, "DENSE_SLOTS", 2)          # projected slot by slot
    lift = svr.Lift("rbf", 3, 32, 42)
    table = sparse.select("features").toArrow().column(0).combine_chunks()
    assert lift.known is None and np.allclose(lift.project(table), np.array([r[0].toArray() for r in sparse.select("features").collect()]) @ svr.normals(np.arange(3), 32, 42))


def test_odd_rows(spark):
    flat = frame(spark, np.arange(8.0).reshape(4, 2), np.full(4, 7.0))
    with pytest.raises(ValueError, match="no rows"):
        svr.fit(flat.limit(0), {})
    assert predicted(svr.fit(flat, {"C": 1.0}, width=8), flat) == pytest.approx(7.0, abs=0.11)
    one = frame(spark, np.ones((1, 2)), [3.0])
    assert predicted(svr.fit(one, {}, width=8), one) == pytest.approx(3.0, abs=0.11)


def test_random_numbers_are_standard_normal():
    z = svr.normals(np.arange(400), 300, 42)
    assert abs(z.mean()) < 0.01 and abs(z.std() - 1) < 0.01
    assert abs(np.corrcoef(z[0], z[1])[0, 1]) < 0.2 and np.array_equal(z[[5, 9]], svr.normals(np.array([5, 9]), 300, 42))


def test_vectors_go_to_python_without_null_lists(spark, data):
    x, y = data
    for sparse in (False, True):
        sent = svr._columns(frame(spark, x, y, sparse=sparse), "fold", "features", "label").toArrow().column("x").combine_chunks()
        assert sent.field("indices").null_count == 0 and sent.field("values").null_count == 0
        row, slot, value = svr.entries(sent)
        assert len(row) == (np.count_nonzero(x) if sparse else x.size)


def slope(x, y, c, epsilon):
    """The optimum of one weight without an intercept: the loss is a parabola between its kinks."""
    kinks = np.sort(np.concatenate([(y - epsilon) / x, (y + epsilon) / x]))
    loss = lambda w: w * w / 2 + c * np.maximum(np.abs(y - w * x) - epsilon, 0).sum()
    k = int(np.argmin([loss(w) for w in kinks]))
    inside = []
    for a, b in zip(kinks[max(k - 1, 0):k + 1], kinks[k:k + 2]):
        e = y - (a + b) / 2 * x
        inside.append(np.clip(c * (np.sign(e) * x)[np.abs(e) > epsilon].sum(), a, b))
    return min([kinks[k], *inside], key=loss)


@pytest.mark.parametrize("cells", [1 << 20, 300, 0])
def test_a_sharp_fit_takes_few_scans(spark, monkeypatch, cells):
    r = np.random.default_rng(7)
    x, scans = np.concatenate([r.uniform(0.5, 40, 390), r.uniform(400, 4000, 10)]), []      # some rows come to a kink from far away
    y = 2.5 * x + r.normal(size=400) * 30
    monkeypatch.setattr(svr, "CELLS", cells)
    inner = svr._summed
    monkeypatch.setattr(svr, "_summed", lambda *a: scans.append(1) or inner(*a))
    solver = svr.Solver(frame(spark, x[:, None], y).coalesce(1), None, kernel="linear", epsilon=5.0, intercept=False)
    found = solver.fit([svr.Problem(c, 1.0, None) for c in (1e-6, 1e-5, 1.0)], rounding=1e-7, gain=1e-13)
    for p in found:
        assert p.weights[0] == pytest.approx(slope(x, y, p.c, 5.0), abs=1e-5)
    assert len(scans) < (25 if cells > 300 else 400)


def test_many_rows_at_one_kink(spark):
    """The loss hardly falls on the way to it."""
    r = np.random.default_rng(3)
    x = r.integers(1, 80, 4000) / 2.0
    y = np.round(2.6 * x + r.integers(-40, 40, 4000))
    solver = svr.Solver(frame(spark, x[:, None], y).coalesce(1), None, kernel="linear", epsilon=5.0, intercept=False)
    for p in solver.fit([svr.Problem(c, 1.0, None) for c in (1e-4, 1e-2, 1.0)], rounding=1e-7, gain=1e-13):
        assert p.weights[0] == pytest.approx(slope(x, y, p.c, 5.0), abs=1e-6)


def test_rows_that_come_to_a_kink_are_noticed(spark):
    x, y = np.array([[1.0], [2.0], [3.0]]), np.array([1.0, 2.0, 30.0])
    solver = svr.Solver(frame(spark, x, y), None, kernel="linear", epsilon=0.5, intercept=False)
    p = svr.Problem(1.0, 1.0, None, n=3.0, weights=np.array([1.0]), least=1e-6)
    assert solver._crossed([(p, 1.0, np.array([1.1])), (p, 1.0, np.array([9.9])), (p, 0.1, np.array([2.0]))]) == [0, 1, 2]
    assert [n for n, *_ in solver._far([(p, 1.0), (p, 0.1)])] == [2, 0] and solver._far([(p, 1.0)])[0][2] == pytest.approx(26.5)
    near, none = solver._near([(p, 1.0), (p, 0.1)])
    assert sorted(near.tolist()) == [[1.0, 1.0], [2.0, 2.0]] and none.shape == (0, 2)


def test_a_search_fits_once(spark, data, monkeypatch):
    x, y = data
    calls = []
    inner = svr.Solver._products
    monkeypatch.setattr(svr.Solver, "_products", lambda *a: calls.append(1) or inner(*a))
    svr.cross_validate(frame(spark, x, y), [{"C": 0.1}, {"C": 1.0}], width=16)
    assert len(calls) == 1


def test_models_of_all_rows_come_with_the_search(spark, data, monkeypatch):
    x, y = data
    df, grid, scans = frame(spark, x, y).coalesce(1), [{"C": 0.1}, {"C": 1.0}], []
    inner = svr.Solver._losses
    monkeypatch.setattr(svr.Solver, "_losses", lambda *a: scans.append(1) or inner(*a))
    monkeypatch.setattr(svr, "CELLS", 0)
    alone = svr.cross_validate(df, grid, width=64)
    first = len(scans)
    rows, models = svr.search(df, grid, width=64)
    assert len(scans) - first < first + 10      # in the same scans
    assert [r["mse"] for r in rows] == pytest.approx([r["mse"] for r in alone], rel=1e-6) and len(models) == 2
    assert np.abs(predicted(models[1], df) - predicted(svr.fit(df, grid[1], width=64), df)).mean() < 0.02
