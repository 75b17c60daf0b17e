"""Repeated substrings against a plain version."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from estrato.llm import repeats


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans, k = [], 0
        while k < len(raw):
            if gone[k]:
                e = k
                while e < len(raw) and gone[e]:
                    e += 1
                spans.append((k, e))
                k = e
            else:
                k += 1
        out.append((len(raw), bytes(b for b, g in zip(raw, gone) if not g), spans))
    return out


def got(frame, length):
    return sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in repeats.remove_repeats(frame, length=length).collect()), key=str)


@pytest.mark.parametrize("length", [40, 113])
def test_matches_plain(docs, rows, length):
    some = [r for r in rows if r[0] != 4000]
    want = sorted(((r[0], *w) for r, w in zip(some, plain([r[1] for r in some], length))), key=str)
    assert got(docs.where("doc_id is null or doc_id <> 4000"), length) == want


def odd_texts():
    r = random.Random(5)
    a = "".join(r.choice("abc") for _ in range(300))
    return ["a" * 500, "ab" * 200 + a, a[30:250] + "x" + a[60:290], a, "é" * 120, "zz" + a[:150] + "qq", "b" * 39, "", None, a * 3]


@pytest.mark.parametrize("classes", [repeats.CLASSES, 1])
def test_periodic_and_crowded(spark, monkeypatch, classes):
    monkeypatch.setattr(repeats, "CLASSES", classes)
    texts = odd_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert got(frame, 40) == sorted(((k, *w) for k, w in enumerate(plain(texts, 40))), key=str)


def test_maximal_repeats_have_all_occurrences():
    texts = [t.encode() for t in ["xxabcdefghyy", "1abcdefgh2", "33abcdefzz", "qbcdefq"]]
    found = {texts[p[0][0]][p[0][1]:p[0][1] + n]: sorted(p) for n, p in repeats.maximal_repeats(texts, 4)}
    assert found == {b"abcdefgh": [(0, 2), (1, 1)], b"abcdef": [(0, 2), (1, 1), (2, 2)],
                     b"bcdef": [(0, 3), (1, 2), (2, 3), (3, 1)]}


def test_intervals_nest():
    assert sorted(repeats.intervals([2, 5, 5, 1])) == [(1, 0, 4), (2, 0, 3), (5, 1, 3)]


def test_empty_table(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_is_bounded_by_the_piece():
    r = np.random.default_rng(3)
    texts = [bytes(r.integers(97, 123, n, dtype=np.uint8)) for n in (4_000_000, *[2_000] * 500)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"k"] * len(texts)), pa.array([t.decode() for t in texts])], names=["key", "text"])
    assert peak_mb(lambda: [None for _ in repeats.cut([batch], 400, 32)]) < 80
    assert peak_mb(lambda: repeats.maximal_repeats([texts[0][k:k + 590] for k in range(0, 4_000_000, 590)], 400)) < 130


def test_tiles_hold_each_string_once(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 150)
    texts = [t or "" for t in odd_texts()]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % k for k in range(len(texts))]), pa.array(texts)], names=["key", "text"])
    found = [(r["key"], k) for b in repeats.cut([batch], 40, 10) for r in b.to_pylist() for k in range(r["start"], r["start"] + r["strings"])]
    assert sorted(found) == sorted((b"%d" % i, k) for i, t in enumerate(texts) for k in range(len(t.encode()) - 39))
    listed = {}
    for b in repeats.cut([batch], 40, 10):
        for r in b.to_pylist():
            listed.setdefault(int(r["key"]), []).append({"start": r["start"], "strings": r["strings"], "anchor": r["anchor"], "class": r["text"], "n": 1, "classes": 2})
    rows = pa.RecordBatch.from_pylist([{"text": texts[k], "runs": v} for k, v in listed.items()])
    bodies = [r["body"] for b in repeats.fetch([rows], 40) for r in b.to_pylist()]
    assert bodies == [texts[k].encode()[r["start"]:r["start"] + r["strings"] + 39] for k, v in listed.items() for r in v]
    tails = sorted(b[k:k + 40] for b in bodies for k in range(len(b) - 39))
    ends = np.cumsum([len(b) for b in bodies])
    places, first = repeats.equal_starts(np.frombuffer(b"".join(bodies), dtype=np.uint8), ends, 40)
    whole = b"".join(bodies)
    assert sorted(whole[p:p + 40] for p in places.tolist()) == tails and len(first) == len(set(tails))


def test_passage_over_the_border_of_tiles(spark):
    r = random.Random(8)
    border = repeats.PIECE_BYTES
    long = "".join(r.choices("abcdefgh", k=2 * border + 1000))
    texts = [long, "1" * 10 + long[border - 200:border + 300] + "2" * 10, "3" + long[2 * border - 450:2 * border + 20] + "4"]
    rows = got(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 400)
    assert [row[3] for row in rows] == [[(border - 200, border + 300), (2 * border - 450, 2 * border + 20)], [(10, 510)], [(1, 471)]]
