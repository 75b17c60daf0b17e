import hashlib
import math

import pytest

from estrato.operators import split


def expected_order(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


@pytest.mark.parametrize("gather", [50_000, 1])
@pytest.mark.parametrize("n", [1, 7, 1003])
def test_split_is_exact(spark, monkeypatch, n, gather):
    monkeypatch.setattr(split, "GATHER", gather)
    monkeypatch.setattr(split, "DIGITS", 1)
    df = spark.range(n).repartition(3)
    got = split.train_test_split(df, ["id"])
    test = {r["id"] for r in got.filter("is_test").collect()}
    assert test == set(expected_order(range(n))[:math.ceil(0.25 * n)])


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = split.train_test_split(df.repartition(7), ["id"]).orderBy("id").collect()
    b = split.train_test_split(df.repartition(1), ["id"]).orderBy("id").collect()
    assert a == b


@pytest.mark.parametrize("n", [3, 1003])
def test_folds(spark, n):
    got = split.assign_folds(spark.range(n), ["id"]).collect()
    order = expected_order(range(n))
    ends, run, want = split.fold_sizes(n, 5), 0, {}
    for fold, size in enumerate(ends):
        for k in order[run:run + size]:
            want[k] = fold
        run += size
    assert {r["id"]: r["fold"] for r in got} == want


def test_split_adds_no_shuffle(spark):
    df = split.train_test_split(spark.range(100), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_equal_keys_stay_together(spark):
    def test_rows(keys):
        df = spark.createDataFrame([(k,) for k in keys], "k int")
        return [r["k"] for r in split.train_test_split(df, ["k"]).filter("is_test").collect()]

    assert test_rows([1] * 4) == []                 # the nearer end leaves all of them for training
    for keys in ([1] * 5 + [2] * 3 + list(range(3, 12)), [7] * 30 + list(range(10)), [1, 1], []):
        got = test_rows(keys)
        assert all(got.count(k) == keys.count(k) for k in got)
        assert abs(len(got) - math.ceil(len(keys) / 4)) <= max(map(keys.count, keys), default=0) / 2 + 1
    both = split.split_and_folds(spark.createDataFrame([(k % 7,) for k in range(70)], "k int"), ["k"]).collect()
    assert len(both) == 70 and len({(r["k"], r["is_test"], r["fold"]) for r in both}) == 7


def test_composite_keys_do_not_read_alike(spark):
    rows = [("a", None), (None, "a"), ("a-b", "c"), ("a", "b-c"), ("", "a"), ("a", ""), ("\\N", "a"), ("a\\", "b"), ("a\\-b", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(split.order_hash(["x", "y"])).distinct().count() == len(rows)


def test_hot_prefix(spark):
    # Many rows of one key away from the limits do no harm: counting is map-side.
    order = expected_order(range(100))
    df = spark.range(100)
    limits = split.hash_limits(df, split.order_hash(["id"]), [0, 1, 50, 100])
    assert limits[0] is None
    digest = [hashlib.md5(f"42:{k}".encode()).hexdigest() for k in order]
    assert limits[1:] == [digest[0], digest[49], digest[99]]


@pytest.mark.parametrize("n", [1, 2, 1003])
def test_split_and_folds_together(spark, n):
    both = split.split_and_folds(spark.range(n), ["id"]).collect()
    rows = split.train_test_split(spark.range(n), ["id"])
    rest = {r["id"]: r["fold"] for r in split.assign_folds(rows.filter("not is_test"), ["id"]).collect()}
    assert {r["id"]: r["fold"] for r in both if not r["is_test"]} == rest
    assert all(r["fold"] is None for r in both if r["is_test"])
    assert sum(r["is_test"] for r in both) == math.ceil(n / 4)
