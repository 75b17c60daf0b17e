"""The suffix tree of the whole corpus against plain counts."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.llm import grams, textbytes


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + ["<end>"]


def plain(rows, depth, p_min, eps, divergence):
    """(learn, text) to (n_tokens, n_known, N, base, score), by dictionaries."""
    counts, n = {}, 0
    for learn, text in rows:
        if learn:
            for w in words(text):
                counts[w] = counts.get(w, 0) + 1
                n += 1
    v = len(counts)

    def root(w):
        return (counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))

    kept = {w for w, c in counts.items() if c >= max(2, eps * n)}
    levels = []
    contexts = {(w,): c for w, c in counts.items() if c >= max(2, p_min * n)}

    def prob(w, ctx, k):
        """After the longest state of at most k words."""
        for j in range(min(k, len(ctx)), 0, -1):
            own = ctx[len(ctx) - j:]
            if own in levels[j - 1] and levels[j - 1][own]["state"]:
                s = levels[j - 1][own]
                below = prob(w, ctx, j - 1)
                if w in s["next"]:
                    return (s["next"][w] + s["rest"] * below) / s["whole"]
                return s["rest"] / s["whole"] * below
        return root(w)

    for k in range(1, depth + 1):
        pairs = {}
        for learn, text in rows:
            if learn:
                seq = ["<end>", *words(text)]
                for i in range(1, len(seq)):
                    ctx = tuple(seq[max(0, i - k):i])
                    if len(ctx) == k and ctx in contexts and seq[i] in kept:
                        pairs[ctx, seq[i]] = pairs.get((ctx, seq[i]), 0) + 1
        level = {c: {"next": {}, "total": t} for c, t in contexts.items()}
        for (c, w), m in pairs.items():
            if m >= max(2, eps * n):
                level[c]["next"][w] = m
        for c, s in level.items():
            explicit = sum(s["next"].values())
            left = max(s["total"] - explicit, 0)
            s["rest"], s["whole"] = left + len(s["next"]), explicit + left + len(s["next"])
            far, covered = 0.0, 0.0
            for w, m in s["next"].items():
                q, p = m / (explicit + left), prob(w, c, k - 1)
                far += q * math.log(q / p)
                covered += p
            if left:
                q = left / (explicit + left)
                far += q * math.log(q / max(1 - covered, 1e-12))
            s["state"] = bool(s["next"]) and far >= divergence
        levels.append(level)
        contexts = {(*c, w): m for c, s in level.items() for w, m in s["next"].items() if m >= max(2, p_min * n)}
    out = []
    for learn, text in rows:
        seq = ["<end>", *words(text)]
        score = sum(math.log10(prob(seq[i], tuple(seq[max(0, i - depth):i]), depth)) for i in range(1, len(seq)))
        out.append((len(seq) - 1, sum(w in counts for w in seq[1:]), n, sum(math.log10(root(w)) for w in seq[1:]), score))
    return out


@pytest.mark.parametrize("depth, split", [(1, 1 << 20), (3, 1 << 20), (1, 3000), (3, 3000), (3, 40), (2, 0)])
def test_matches_plain_without_shares(docs, rows, depth, split, monkeypatch):
    """However many contexts are hot: none, one, some of each length, all."""
    monkeypatch.setattr(textbytes, "SLICE_BYTES", 20000)
    monkeypatch.setattr(grams, "ASK_BYTES", 9000)
    got = grams.score(docs, F.col("doc_id") % 5 != 0, depth=depth, split_rows=split).collect()
    some = rows
    learn = [r[0] is not None and r[0] % 5 != 0 for r in some]
    want = sorted((str(r[0]), *w) for r, w in zip(some, plain([(a, r[1]) for a, r in zip(learn, some)], depth, 0, 0, 0.02)))
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)


def test_rare_evidence_counts_in_a_large_corpus(spark):
    """A continuation far below the shares p_min and eps of the corpus is learned."""
    filler = [(k, " ".join(f"w{(k * 7919 + j * j) % 900}" for j in range(300))) for k in range(200)]
    known = [(1000 + k, "quartz lattice hums softly") for k in range(4)]
    asked = [(5000, "quartz lattice hums softly"), (5001, "softly hums lattice quartz")]
    frame = spark.createDataFrame(filler + known + asked, "doc_id long, text string")
    out = {r["doc_id"]: r["score"] - r["base_score"] for r in grams.score(frame, F.col("doc_id") < 5000).where("doc_id >= 5000").collect()}
    assert out[5000] > 8 and out[5000] > out[5001] + 8


def test_nothing_to_learn_from(docs, no_docs):
    out = grams.score(docs, F.lit(False)).collect()
    assert len(out) == docs.count() and all(r["train_tokens"] == r["n_known"] == 0 and abs(r["score"]) < 1e-9 for r in out)
    assert grams.score(no_docs, F.lit(True)).count() == 0


def test_clashing_columns(spark):
    odd = spark.createDataFrame([(1, "a b a b", 1, "x"), (None, None, 2, None), (1, "a b a b", 3, "y")], "doc_id long, text string, learn int, rows string")
    out = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in grams.score(odd, F.lit(True)).collect()), key=str)
    assert out == [(1, 5, 5, 11), (1, 5, 5, 11), (None, 1, 1, 11)]


def test_packed_columns_come_back():
    r = np.random.default_rng(3)
    for n in (0, 1, 1000):
        columns = [np.zeros(n, dtype=np.int64), r.integers(0, 1 << 40, n), r.integers(0, 300, n)]
        assert all((a == b).all() and len(a) == n for a, b in zip(grams.unpack(grams.pack(*columns)), columns))
        x = np.sort(r.integers(-(1 << 63), 1 << 62, n))
        assert (grams.unpack_sorted(grams.pack_sorted(x)) == x).all()
        x = -r.exponential(size=n).round(1)
        assert np.allclose(grams.unpack_logs(*grams.pack_logs(x)), x, rtol=0, atol=1.2e-10)
