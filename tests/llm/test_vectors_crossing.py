"""Links between vectors that share no shard, and an audit that sees what is lost."""

import numpy as np
from pyspark.sql import functions as F

from estrato.llm import vectors


def test_search_leaves_its_shard(spark, monkeypatch):
    """Two cells that share only the middle of a chain: its ends are linked all the same."""
    angle = {k: 0.1 * k for k in range(5)}
    reps = spark.createDataFrame([(k, "x", np.array([np.cos(a), np.sin(a)]).astype("<f8").tobytes(), 1 + k) for k, a in angle.items()],
                                 "rep long, label string, vec binary, copies long")
    cells = [(1, 0), (1, 1), (1, 2), (2, 2), (2, 3), (2, 4)]
    members = spark.createDataFrame(cells, "cell long, rep long").join(reps.select("rep", "vec"), "rep").select("cell", "rep", "vec")
    monkeypatch.setattr(vectors, "split", lambda frame, overlap: members)
    found = vectors.linked(reps, np.cos(0.305), 1, 1).groupBy("rep").agg(F.sum("n_links").alias("n")).collect()
    want = {a: sum(1 + b for b in angle if b != a and abs(a - b) <= 3) for a in angle}
    assert {r["rep"]: r["n"] for r in found} == want


def test_audit_sees_lost_sparse_links(spark):
    """One dense group whose links are all found does not hide that every pair is lost."""
    r = np.random.default_rng(3)
    base = r.normal(size=32)
    many = [base + 0.02 * r.normal(size=32) for _ in range(120)]
    pairs = [x for _ in range(40) for v in [r.normal(size=32)] for x in (v, v + 0.02 * r.normal(size=32))]
    reps = spark.createDataFrame([(k, "x", x.astype("<f8").tobytes(), 50 if k < 120 else 1) for k, x in enumerate(many + pairs)],
                                 "rep long, label string, vec binary, copies long")
    found = spark.createDataFrame([(k, 119) for k in range(120)], "rep long, n_reps long")
    recall, short = vectors.audit(reps, found, 0.93)
    assert recall == 0 and short == ["x"]


def test_what_stays_below_target_is_compared_exactly(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(k, (v + 0.05 * r.normal(size=16)).tolist(), k % 2) for k, v in enumerate(np.repeat(r.normal(size=(60, 16)), 4, axis=0))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = sorted(map(str, vectors.near_duplicates(frame).collect()))
    monkeypatch.setattr(vectors, "search", lambda x, *_: iter(()))
    monkeypatch.setattr(vectors, "PART", 16)
    monkeypatch.setattr(vectors, "CELL", 16)
    assert sorted(map(str, vectors.near_duplicates(frame).collect())) == whole
