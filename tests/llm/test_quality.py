"""The byte network: gradient, odd texts, held-out accuracy."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.llm import quality

SF = "/root/testdata/sf0.01"


def texts_of(n, seed=0):
    r = np.random.default_rng(seed)
    return [bytes(r.integers(97, 123, r.integers(0, 1500)).astype(np.uint8)) for _ in range(n)]


def laid(texts):
    return quality.padded(np.frombuffer(b"".join(texts), dtype=np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])])


def test_gradient_matches_differences():
    model = {k: v.astype(np.float64) for k, v in quality.fresh().items()}
    x, halves = laid(texts_of(5) + [b""])
    delta = np.array([0.3, -0.2, 0.5, 0.1, -0.4, 0.2])
    _, cache = quality.forward(model, x, halves)
    grad = quality.gradient(model, x, halves, cache, delta)
    r = np.random.default_rng(2)
    for name in model:
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in model[name].shape)
            if name == "emb":
                at = (int(r.integers(97, 123)), at[1])
            near = []
            for step in (1e-6, -1e-6):
                moved = {**model, name: model[name].copy()}
                moved[name][at] += step
                near.append(float(quality.forward(moved, x, halves)[0] @ delta))
            assert abs((near[0] - near[1]) / 2e-6 - grad[name][at]) < 1e-3, (name, at)


def test_a_text_scores_alike_alone_and_among_others():
    model = quality.fresh()
    texts = texts_of(8, 3) + [b"", b"x", b"y" * 256, b"z" * 257, b"w" * 512, b"v" * 100_000]
    together = quality.forward(model, *laid(texts))[0]
    alone = np.array([quality.forward(model, *laid([t]))[0][0] for t in texts])
    assert np.allclose(together, alone, atol=1e-4)


def test_every_byte_counts():
    model, base = quality.fresh(), b"a" * 50_000
    scores = [quality.forward(model, *laid([base[:k] + b"Q#!8" * 8 + base[k:]]))[0][0] for k in (0, 25_000, 49_990)]
    assert all(abs(s - quality.forward(model, *laid([base]))[0][0]) > 1e-6 for s in scores)


def test_nothing_labelled_and_odd_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels, F.lit(True)) is None
    out = quality.score(docs, None).collect()
    assert len(out) == len(rows) and {r["score"] for r in out} == {0.5}
    assert quality.score(no_docs, quality.fresh()).count() == 0
    odd = spark.createDataFrame([(1, None, 0.1, 7), (2, "", 0.2, 8)], "doc_id long, text string, score double, row int")
    assert len({r["score"] for r in quality.score(odd, quality.fresh()).collect()}) == 1


def test_the_sample_is_bounded_and_obeys_the_condition(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "VISITS", 16)
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    labels = labels.union(spark.createDataFrame([(None, 1), (1000, None), (1001, 7)], "doc_id long, quality int"))
    model = quality.train(docs, labels, ~quality.held_out(), rows=10)
    assert model is not None and set(model) == set(quality.fresh())
    assert quality.train(docs, labels.where(quality.held_out()), ~quality.held_out()) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    model = quality.train(read("documents"), read("labels"), ~quality.held_out())
    scored = quality.score(read("documents"), model).select("row.doc_id", "score").join(read("labels"), "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean(np.array(good) >= quality.THRESHOLD) > 0.93 and np.mean(np.array(bad) >= quality.THRESHOLD) < 0.35
