"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from estrato.llm import vectors


def plain(rows, at_least):
    unit = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None)
    n = len(rows)
    link = [[i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
             and float(unit[i] @ unit[j]) >= at_least for j in range(n)] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in range(n) if link[i][j])]) for i in range(n)]
        if new == label:
            break
        label = new
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[label[k]] = min(r[0], least.get(label[k], 1 << 62))
    out = []
    for k, r in enumerate(rows):
        c = least.get(label[k]) if any(link[k]) else r[0]
        out.append((r[0], sum(link[k]), c, sum(link[k]) == 0 if r[0] is None else r[0] == c))
    return sorted(out, key=str)


def make():
    r = np.random.default_rng(0)
    rows, k = [], 100
    for label in (0, 1, None):
        for _ in range(60):
            rows.append((k := k + 1, r.normal(size=16).tolist(), label))
        base = r.normal(size=16)
        for _ in range(40):
            rows.append((k := k + 1, (base + 0.12 * r.normal(size=16)).tolist(), label))
        for _ in range(12):
            rows.append((k := k + 1, (base * 2).tolist(), label))
            rows.append((k := k + 1, (base * -1).tolist(), label))
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [None] + [1.0] * 15, 0), (5, [float("nan")] * 16, 0), (6, [float("inf")] + [1.0] * 15, 0),
             (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0), (None, rows[65][1], 0), (None, r.normal(size=16).tolist(), 0), rows[70], rows[70]]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"CELL": 32, "PART": 16, "CHILDREN": 4}])
def test_matches_brute_force(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(vectors, k, v)
    rows = make()
    out = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)).collect()
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out), key=str)
    want = plain(rows, 0.93)
    assert all(r["recall"] >= 0.95 for r in out)
    # Cells cut this small may miss a link, but never report one that is not there.
    assert [g[0] for g in got] == [w[0] for w in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.95 * true and (sizes or got == want)


def test_pruned_graph_reaches_every_near_vector():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(size=(300, 24)), r.normal(size=24) + 0.1 * r.normal(size=(200, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = vectors.pruned(x, 3, 24)
    got = {(i, j) for a, b in vectors.search(x, graph, 0.93, 16) for i, j in zip(a.tolist(), b.tolist())}
    cos = x @ x.T
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(cos >= 0.93)) if i != j}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(none).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 0.0], 1, 9), (2, [1.0, 0.01], 1, 9)], "vec_id long, embedding array<float>, label int, rep long")
    assert [(r["n_links"], r["component_id"]) for r in vectors.near_duplicates(odd).orderBy("vec_id").collect()] == [(1, 1), (1, 1)]


def test_signed_zeros_are_one_value(spark):
    """-0.0 in any place, alone, in copies and next to near vectors."""
    rows = [(k, [1.0, z, 0.5], "a") for k, z in enumerate([-0.0, 0.0, 0.01, -0.0])]
    rows += [(10 + k, v, "b") for k, v in enumerate([[-0.0, 1.0, 2.0], [0.0, 1.0, 2.0], [1.0, -0.0, -0.0], [1.0, 0.0, 0.0], [-0.0, -0.0, -0.0], [-1.0, -0.0, 0.0]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    out = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(frame).collect())
    assert out == sorted(plain(rows, 0.93))
