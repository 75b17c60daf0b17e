"""Line dedup against a plain version."""

import numpy as np
import pytest

from estrato.llm import linedup

SEPARATORS = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=10):
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SEPARATORS))
        return k if len(k) >= min_chars else None
    where = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            where.setdefault(key(line), set()).add((1 << 63) - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = (1 << 63) - 1 if doc is None else doc
        kept = [x for x in lines if key(x) is None or own == min(where[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["rest"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in linedup.drop_repeated_lines(frame).collect()), key=str)


def test_matches_plain(docs, rows):
    assert got(docs) == plain([r[:2] for r in rows])


@pytest.mark.parametrize("name", ["SEGMENT_KEYS", "BLOCK_KEYS"])
def test_many_segments_and_blocks(docs, rows, monkeypatch, name):
    monkeypatch.setattr(linedup, name, 64)
    assert got(docs) == plain([r[:2] for r in rows])


def test_tiny_filters_only_raise_suspects(docs, rows, monkeypatch):
    monkeypatch.setattr(linedup, "FILTER_BITS", 64)  # nearly all keys are suspected
    assert got(docs) == plain([r[:2] for r in rows])


def test_filters_find_every_repeat():
    import pandas as pd
    r = np.random.default_rng(0)
    blocks = [np.unique(r.integers(0, 5000, 400).astype(np.uint32)) for _ in range(6)]
    frame = pd.DataFrame({"segment": 0, "block": range(6), "probes": [b.tobytes() for b in blocks],
                          "many": [np.zeros(len(b), dtype=bool).tobytes() for b in blocks]})
    hits = {x.block: set(np.frombuffer(x.hits, np.uint32).tolist()) for x in linedup.suspects_of(frame).itertuples()}
    for k, own in enumerate(blocks):
        again = {int(x) for x in own if sum(x in b for b in blocks) > 1}
        assert again <= hits.get(k, set())


def test_empty_and_clashing_columns(spark, no_docs):
    assert linedup.drop_repeated_lines(no_docs).count() == 0
    odd = spark.createDataFrame([(1, "the same long line", 1, 2), (2, "the same long line", 3, 4)], "doc_id long, text string, n_lines int, kept int")
    out = {r["rest"]["doc_id"]: (r["kept"], r["rest"]["n_lines"], r["rest"]["kept"]) for r in linedup.drop_repeated_lines(odd).collect()}
    assert out == {1: ("the same long line", 1, 2), 2: ("", 3, 4)}


def test_answers_are_looked_up_at_once():
    r = np.random.default_rng(1)
    h1 = r.integers(-(1 << 63), 1 << 63, 5000)
    for segments in (10, 100_000):
        seg, probe = linedup.segment_of(h1, segments), h1.astype(np.uint32)
        some = np.unique(r.integers(0, 5000, 700))
        hits = [{"segment": int(s), "hits": probe[some[seg[some] == s]].tobytes()} for s in np.unique(seg[some])]
        assert np.array_equal(np.flatnonzero(linedup.matched(seg, probe, hits)), some)
