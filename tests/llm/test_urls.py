"""URL verdicts: rules and models against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from estrato.llm import urls


def split(url):
    rest = (url or "").partition("://")[2]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))] if tail[:1] == "/" else ""


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def rows():
    r = random.Random(5)
    out = ["", None, "no scheme/en/", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y#z", "https://example.net/en", "https://example.net?/en/",
           "x://example.com/de/é日", "http://notexample.com/de/1", "http://a.org/fr/\nx", "http://a.org#/fr/", "ftp://b.net://c.org/fr/", "://org/fr/", "http://example.com//de/",
           "http://u@net:80/", "http://x.net:80/en/"]
    for k in range(400):
        out.append(f"http{'s' * (k % 2)}://{r.choice(['www.', 'm.', ''])}{r.choice(['casino', 'poems', 'stone', 'pills'])}{r.choice('abc')}.example.{r.choice(['net', 'com', 'org'])}"
                   f"/{r.choice(['en', 'de', 'fr', 'es'])}/{r.randint(1, 999)}{r.choice(['', '?q=1', '#top'])}")
    return [(k, u) for k, u in enumerate(out)]


def plain_model(texts):
    n = {}
    for t in texts:
        s = [urls.START, *t.encode(), urls.END]
        for i in range(1, len(s)):
            for j in range(min(i, urls.ORDER) + 1):
                n.setdefault(tuple(s[i - j:i]), {}).setdefault(s[i], 0)
                n[tuple(s[i - j:i])][s[i]] += 1

    def logp(t):
        s, total = [urls.START, *t.encode(), urls.END], 0.0
        for i in range(1, len(s)):
            p = 1 / 258
            for j in range(min(i, urls.ORDER) + 1):
                own = n.get(tuple(s[i - j:i]))
                if own:
                    p = (own.get(s[i], 0) + len(own) * p) / (sum(own.values()) + len(own))
            total += math.log(p)
        return total / (len(s) - 1)
    return logp


def test_parts_and_rules(spark):
    frame = spark.createDataFrame(rows(), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.ruled(urls.parts(frame)).collect()}
    for k, u in rows():
        assert (got[k]["host"], got[k]["path"]) == split(u), u
        assert (got[k]["rule"], got[k]["verdict"]) == rule_of(*split(u)), u


@pytest.mark.parametrize("size", [1 << 19, 600])
def test_scores_and_verdicts_match_plain(spark, monkeypatch, size):
    monkeypatch.setattr(urls, "BLOCK_BYTES", size)
    monkeypatch.setattr(urls, "SHARD_BYTES", size)
    frame = spark.createDataFrame(rows(), "page_id long, url string").repartition(3)
    held = {r["page_id"]: r["h"] for r in frame.select("page_id", (F.pmod(F.xxhash64("url"), F.lit(urls.CALIBRATION)) == 0).alias("h")).collect()}
    judged = [(k, u, rule_of(*split(u))[1]) for k, u in rows()]
    accepted = plain_model([u for k, u, v in judged if v == "allow" and not held[k]])
    rejected = plain_model([u for k, u, v in judged if v == "block" and not held[k]])
    got = {r["page_id"]: r for r in urls.judge(frame).collect()}
    assert len(got) == len(judged)
    known = [(accepted(u) - rejected(u), v) for k, u, v in judged if v and held[k]]

    def right(cut):
        return sum(sum((s >= cut) == (v == "allow") for s, v in known if v == c) / sum(v == c for _, v in known) for c in ("allow", "block"))

    scores = sorted({s for s, _ in known})
    least = [got[k]["score"] for k, u, v in judged if not v and got[k]["verdict"] == "allow"]
    most = [got[k]["score"] for k, u, v in judged if not v and got[k]["verdict"] == "block"]
    assert not least or not most or min(least) > max(most)
    for k, u, v in judged:
        assert got[k]["score"] == pytest.approx(accepted(u or "") - rejected(u or ""), abs=1e-9)
        assert v is None or got[k]["verdict"] == v
    if least and most:
        assert right((min(least) + max(most)) / 2) >= max(right(c) for c in scores) - 0.1


def test_odd_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none).count() == 0
    odd = spark.createDataFrame([(None, "http://a.com/x", 1, "q"), (1, "http://a.com/x", 2, None), (1, "http://a.com/x", 2, None), (2, None, None, None)],
                                "page_id int, url string, score int, host string")
    got = sorted(((r["page_id"], r["host"], r["verdict"], r["score"]) for r in urls.judge(odd).collect()), key=str)
    assert got == [(1, "a.com", "allow", 0.0)] * 2 + [(2, "", "allow", 0.0), (None, "a.com", "allow", 0.0)]


def test_very_long_url(spark):
    frame = spark.createDataFrame([(1, "http://a.net/" + "x" * 2_000_000), (2, "http://b.org/fr/1"), (3, "http://b.com/")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in urls.judge(frame).where("page_id < 3").collect()} == {1: "block", 2: "allow"}
