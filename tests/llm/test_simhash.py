"""SimHash near-duplicates against a plain version over all pairs."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from estrato.llm import simhash


def plain_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(n)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > n)


def plain_components(fps, budget):
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            low = min(label[b] for b in fps if (a ^ b).bit_count() <= budget)
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_matches_all_pairs(docs, rows):
    got = sorted(((r["id"], r["fp"] % 2 ** 64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    fps = [plain_fingerprint(r[1]) for r in rows]
    label = plain_components(set(fps), 2)
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[label[f]] = min(r[0], least.get(label[f], 1 << 62))
    assert got == sorted(((r[0], f, least.get(label[f])) for r, f in zip(rows, fps)), key=str)


def test_joins_planted_neighbours_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)  # a deeper split among tasks
    r = np.random.default_rng(3)
    base = r.integers(-2 ** 63, 2 ** 63 - 1, 300, dtype=np.int64)
    near = [int(x) ^ (1 << int(a)) ^ (1 << int(b)) for x in base[:100].astype(np.uint64) for a, b in [r.choice(64, 2, replace=False)]]
    far = [int(x) ^ 0b111 << int(s) for x, s in zip(base[100:200].astype(np.uint64), r.integers(0, 61, 100))]
    fps = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64).astype(np.int64), np.array(far, dtype=np.uint64).astype(np.int64)]))
    frame = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    got = {frozenset((x["a"], x["b"])) for x in simhash.links(frame, 2).collect()}
    u = fps.view(np.uint64)
    want = {frozenset((int(fps[i]), int(fps[j]))) for i in range(len(u)) for j in range(i) if (int(u[i]) ^ int(u[j])).bit_count() <= 2}
    assert len(want) >= 100 and got == want


def test_walk_meets_every_pair_in_small_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << 9, 200).astype(np.uint64))
    got = [frozenset((int(a), int(b))) for i, j in simhash.walk(keys, keys, True, 0, 0, 2) for a, b in zip(i, j)]
    want = {frozenset((i, j)) for i in range(len(keys)) for j in range(i) if (int(keys[i]) ^ int(keys[j])).bit_count() <= 2}
    assert set(got) == want and len(got) == len(want)


def test_empty_table_and_clashing_columns(spark, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    odd = spark.createDataFrame([(1, "a b c d", 5, 6), (2, "a b c d", 7, 8)], "doc_id long, text string, fp long, component_id long")
    assert [tuple(r)[0::2] for r in simhash.near_duplicates(odd).orderBy("id").collect()] == [(1, 1), (2, 1)]
    assert simhash.near_duplicates(odd.withColumn("doc_id", F.lit(None).cast("long"))).where("component_id is null").count() == 2
