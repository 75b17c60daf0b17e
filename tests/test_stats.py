import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.operators import stats


def frame(spark, columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(float(v[i]) if i < len(v) and v[i] is not None else None
                  for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)


CASES = {
    "pair": [1, 2, None],
    "one": [7],
    "constant": [3] * 50,
    "two_values": [0] * 30 + [1] * 30,
    "half_zero": [0] * 500 + [i + 0.5 for i in range(500)],
    "third_hot": [5] * 400 + list(range(-300, 500)),
    "uniform": [random.Random(1).random() for _ in range(3001)],
    "heavy_tail": [random.Random(2).paretovariate(0.3) for _ in range(2000)],
    "negative": [-x for x in range(999)],
}


@pytest.mark.parametrize("gather,sample", [(200_000, 100), (30, 200), (3, 40)])
def test_exact_medians(spark, monkeypatch, gather, sample):
    monkeypatch.setattr(stats, "GATHER", gather)
    monkeypatch.setattr(stats, "SAMPLE", sample)
    df = frame(spark, CASES)
    got = stats.exact_medians(df, list(CASES))
    want = {c: statistics.median([x for x in v if x is not None]) for c, v in CASES.items()}
    assert got == want


def test_every_rank_survives_a_poor_sample(spark, monkeypatch):
    monkeypatch.setattr(stats, "GATHER", 10)
    monkeypatch.setattr(stats, "SAMPLE", 5)
    monkeypatch.setattr(stats, "WIDTH", 0.1)
    monkeypatch.setattr(stats, "ACCURACY", 50)
    values = [5] * 40 + [1, 2, 3] * 5 + list(range(10, 40))
    df = frame(spark, {"x": values})
    ranks = [1, 2, 15, 16, 30, 55, 56, 57, 84, 85]
    got = stats.order_statistics(df, {"x": ranks})["x"]
    assert got == [sorted(values)[r - 1] for r in ranks]


def test_nan_is_the_largest_value(spark, monkeypatch):
    monkeypatch.setattr(stats, "GATHER", 50)
    df = frame(spark, {"x": [float(x) for x in range(400)] + [float("nan")] * 300}).repartition(3)
    got = stats.order_statistics(df, {"x": [1, 350, 400, 401, 700]})["x"]
    assert got[:3] == [0.0, 349.0, 399.0] and all(x != x for x in got[3:])


def test_all_null_column_has_no_median(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert stats.exact_medians(df, ["a", "b"]) == {"a": 1.5, "b": None}


def test_moments_after_imputation(spark):
    values = [1.0, 5.0, None, 9.0, None, 2.5]
    df = frame(spark, {"x": values})
    p = stats.numeric_profile(df, ["x"])["x"]
    filled = [p.median if v is None else v for v in values]
    assert p.median == 3.75
    assert p.imputed.mean == pytest.approx(np.mean(filled))
    assert p.imputed.var == pytest.approx(np.var(filled))


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", None), ("a", None), (None, None)],
                               "k string, only string")
    got = {r["feature"]: (r["value"], r["n"]) for r in stats.most_frequent(df, ["k", "only"]).collect()}
    assert got == {"k": ("a", 2), "only": ("x", 1)}


@pytest.mark.parametrize("block, held", [(256, 1 << 28), (2, 1 << 28), (1, 1)])
def test_correlation_matches_pandas(spark, monkeypatch, block, held):
    """By blocks of columns, in one scan or several."""
    monkeypatch.setattr(stats, "CORR_BLOCK", block)
    monkeypatch.setattr(stats, "CORR_BYTES", held)
    rng = np.random.default_rng(0)
    a = rng.normal(size=200)
    cols = {"a": list(a), "b": list(a * 2 + rng.normal(size=200)), "c": list(rng.normal(size=200)),
            "k": [4.0] * 200}
    for i in range(0, 200, 7):
        cols["b"][i] = None
    df = frame(spark, cols)
    want = df.toPandas().corr()
    for r in stats.correlation_matrix(df).collect():
        w = want.loc[r["var_a"], r["var_b"]]
        if np.isnan(w):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(w, abs=1e-12)
    lower = stats.lower_triangle(stats.correlation_matrix(df, ["a", "b", "nope"]))
    assert [(r["var_a"], r["var_b"]) for r in lower.collect()] == [("b", "a")]
    square = stats.pivot_matrix(stats.correlation_matrix(df, ["a", "b"]))
    assert square.columns == ["var_a", "a", "b"]
    with pytest.raises(ValueError):
        stats.correlation_columns(df, ["nope"])


def test_correlation_ignores_text(spark):
    df = spark.range(5).select("id", F.lit("x").alias("t"))
    assert stats.correlation_columns(df) == ["id"]


def test_wide_matrix_is_split(spark, monkeypatch):
    monkeypatch.setattr(stats, "FIELDS", 12)
    df = spark.range(50).selectExpr("id", "id * id as sq", "-id as neg", "id % 7 as m")
    got = stats.correlation_matrix(df).collect()
    want = df.toPandas().corr()
    assert len(got) == 16
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r["var_a"], r["var_b"]])
    assert stats.value_counts(df, df.columns) == dict.fromkeys(df.columns, 50)


def test_correlation_is_one_scan_for_any_number_of_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 100))
    x[:, 1] = 7.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(100)))
    df = df.withColumn("c2", F.when(F.col("c3") > 0, F.col("c2")))
    m = stats.correlation_matrix(df)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("MapInArrow") == 1
    got = {(r["idx_a"], r["idx_b"]): (r["corr"], r["n"]) for r in m.collect()}
    assert len(got) == 10_000 and got[0, 1] == (None, 50) and got[5, 5] == (1.0, 50)
    assert got[0, 9][0] == pytest.approx(np.corrcoef(x[:, 0], x[:, 9])[0, 1])
    own = x[:, 3] > 0
    assert got[2, 3] == (pytest.approx(np.corrcoef(x[own, 2], x[own, 3])[0, 1]), own.sum())


def test_correlation_of_odd_values(spark):
    """Values that are not finite, pairs constant over their rows, columns and tables without any."""
    rows = [(1.0, float("nan"), 0.1, None), (2.0, 5.0, 0.1, None), (4.0, float("inf"), 0.1, None), (3.0, 5.0, 0.1, None), (None, 7.0, 0.1, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["var_a"], r["var_b"]): (r["corr"], r["n"]) for r in stats.correlation_matrix(df).collect()}
    assert got["a", "a"] == (1.0, 4) and got["a", "b"] == (None, 2) and got["b", "b"] == (1.0, 3) and got["a", "c"] == (None, 4)
    assert got["c", "c"] == (None, 5) and got["d", "d"] == (None, 0) and got["b", "d"] == got["d", "a"] == (None, 0) and len(got) == 16
    assert all(r["corr"] is None and r["n"] == 0 for r in stats.correlation_matrix(df.limit(0)).collect())


def test_text_cells_do_not_stop_a_statistic(spark):
    df = spark.createDataFrame([("1,5", 1.0), ("2", 2.0), ("4", 3.0)], "a string, b double")
    assert stats.exact_medians(df, ["a"])["a"] == 3.0
    assert {r["n"] for r in stats.correlation_matrix(df, ["a", "b"]).collect()} == {2, 3}
