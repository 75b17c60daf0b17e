"""Periodic runs against a plain search over all starts and periods."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.llm import periods


def plain_runs(w, least=12):
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(least, 2 * q) and not any(q % d == 0 and all(w[k] == w[k + d] for k in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(text, least=12):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    found = plain_runs(w, least)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return len(w), found, " ".join(x for k, x in enumerate(w) if k not in gone)


def thue_morse(n):
    return " ".join("ab"[k.bit_count() % 2] for k in range(n))


def texts():
    r = random.Random(3)
    out = ["", None, " \n\t", "one", "a " * 11, "a " * 12, "a " * 500, "a b " * 6, "a b " * 5 + "a", "x " + "a b c d e f g " * 2,
           "a b c " * 3 + "a b c", ("a b a b a c " * 7).strip(), thue_morse(2100), "é 日 " * 40, " ".join("ab") + " " + "q r " * 13]
    for k in range(60):
        words = [r.choice("ab" if k % 2 else "abcdefgh") for _ in range(r.randint(1, 250))]
        for _ in range(r.randint(0, 3)):
            p, at = r.randint(1, 40), r.randint(0, len(words))
            words[at:at] = ([f"w{r.randint(0, 9)}" for _ in range(p)] * 9)[:r.randint(1, 5 * p)]
        out.append(r.choice([" ", "\n", " \t"]).join(words))
    return out


@pytest.mark.parametrize("tile", [4096, 16])
def test_matches_plain(spark, monkeypatch, tile):
    monkeypatch.setattr(periods, "TILE", tile)
    monkeypatch.setattr(periods, "CHUNK", 300)
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in periods.runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        n, found, kept = plain(text)
        assert (got[k]["n_words"], [tuple(r) for r in got[k]["runs"]], got[k]["kept"]) == (n, found, kept), text


def test_long_text_is_stitched_from_tiles():
    r = np.random.default_rng(1)
    block = r.integers(0, 1 << 60, 700)
    words = np.concatenate([r.integers(0, 1 << 60, 5000), np.tile(block, 30)[:19_999], r.integers(0, 1 << 60, 3000), np.full(9000, 7)]).astype(np.uint64)
    text, period, start, end = periods.fragments(words, np.array([0]), np.array([len(words)]), 12)
    assert set(period.tolist()) == {700, 1} and len(period) > 4
    for p, s, e in ((700, 5000, 24_999), (1, 27_999, 36_999)):
        own = sorted(zip(start[period == p].tolist(), end[period == p].tolist()))
        assert own[0][0] == s and max(b for _, b in own) == e
        assert all(b[0] <= a[1] - p for a, b in zip(own, own[1:]))


def test_factors():
    f = periods.least_factors(200)
    assert all(f[n] == next(d for d in range(2, n + 1) if n % d == 0) for n in range(2, 201))


def test_odd_tables(spark, docs, no_docs):
    assert periods.runs(no_docs).count() == 0
    assert periods.runs(docs).count() == docs.count()
    line = "go on now " * 8
    odd = spark.createDataFrame([(None, line, 1, "x"), (1, line, 2, None), (1, line, 2, None), (1, None, None, "")],
                                "doc_id long, text string, runs int, kept string")
    got = [(r["doc_id"], r["n_words"], len(r["runs"]), r["kept"]) for r in periods.runs(odd).collect()]
    assert sorted(got, key=str) == sorted([(None, 24, 1, "go on now"), (1, 24, 1, "go on now"), (1, 24, 1, "go on now"), (1, 0, 0, "")], key=str)


def test_planted_words_follow_the_contract(spark):
    import zlib

    from estrato.llm.queries import looped
    rows = [(k, " ".join(f"w{(k * j * j) % 97}" for j in range(k % 50))) for k in range(300)] + [(None, "a b"), (7, None), (8, "")]
    got = [(r["doc_id"], r["text"]) for r in looped(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = []
    for k, text in rows:
        w, n, h = (text or "").split(), len((text or "").split()), None if k is None else zlib.crc32(str(k).encode())
        if n and k is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want.append((k, w))
    assert [(k, (t or "").split()) for k, t in got] == want
