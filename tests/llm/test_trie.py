"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib

import pytest

from estrato.llm import trie


def key(x):
    return (x is not None, x if x is not None else 0)


def plain(rows, group=20, most=4):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv in turns:
        turns[conv] = [t[1:] for t in sorted(turns[conv], key=lambda t: (key(t[0]), t[1:]))]
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = tuple(turns.get(c - c % group, [])[:h] + turns[c][h:])
    nodes = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)

    def below(k):
        return [x for x in nodes if x[:len(k)] == k]

    def words(k):
        return len([w for w in re.split(r"[\x20\x09-\x0D]+", k[-1][1]) if w]) if k else 0

    out = []
    for k, members in nodes.items():
        kids = sum(len(x) == len(k) + 1 for x in below(k))
        leaves = sum(not any(len(y) == len(x) + 1 for y in below(x)) for x in below(k))
        saved = sum((len(nodes[x]) - 1) * words(x) for x in below(k))
        ends = ",".join(str(c) for c in sorted(members) if whole[c] == k)
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n=150):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * r.choice([1, 1, 3])
        for t in range(r.choice([0, 1, 1, 2, 3, 4, 7])):
            rows.append((c, r.choice([t, t, t, None, 1]), r.choice(["user", "assistant", None, ""]) if r.random() < 0.3 else "user",
                         r.choice(["hello there", "a b  c\n", "", None, "x"]) if r.random() < 0.9 else f"own words {c}"))
    rows += [(900 + k, t, "u", f"same turn {t}") for k in range(40) for t in range(6)]
    rows += [(2000, t, "u", f"deep {t} of many") for t in range(300)] + [(2001 + k, t, "u", f"deep {t} of many") for k in range(3) for t in range(280 + k)]
    return rows + [(None, 0, "user", "belongs to none"), (5, None, None, None)]


SCHEMA = "conv_id long, turn long, role string, text string"


def got(frame):
    return sorted((tuple(r) for r in trie.forest(trie.rebuilt(trie.sequenced(frame))).collect()), key=str)


@pytest.mark.parametrize("seed,batch,fan", [(1, 10000, 64), (2, 3, 2)])
def test_matches_plain(spark, monkeypatch, seed, batch, fan):
    """With small batches and fans forests are contracted and merged many times."""
    monkeypatch.setattr(trie, "FAN", fan)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        rows = conversations(seed)
        assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("seed", range(30))
def test_contraction_at_any_place(seed):
    """Forests of any parts of the order, merged in any grouping, have the same nodes."""
    r = random.Random(seed)
    turns = [bytes([k]) * trie.TURN for k in range(3)]
    convs = sorted((b"".join(r.choice(turns) for _ in range(r.randint(0, 5))), c) for c in range(r.randint(1, 40)))
    words = [[s[k] + 1 for k in range(0, len(s), trie.TURN)] for s, _ in convs]

    def nodes(forests):
        out = [dict(zip(f, row)) for f in forests for row in zip(*f.values())]
        opened = {n["key"]: n["conv_id"] for n in out if n["open"]}
        return sorted(((n["conv_id"], n["depth"], opened[n["parent_key"]] if n["parent_key"] else n["parent_conv_id"], n["n_convs"],
                        n["n_children"], n["n_leaves"], n["saved_tokens"]) for n in out), key=str)

    whole = trie.of_rows([c for _, c in convs], [s for s, _ in convs], words)
    whole.merge(True)
    cuts = sorted({0, len(convs), *(r.randint(0, len(convs)) for _ in range(5))})
    parts, done = [], []
    for a, b in zip(cuts, cuts[1:]):
        own = trie.of_rows([c for _, c in convs[a:b]], [s for s, _ in convs[a:b]], words[a:b])
        parts.append(own.merge(False) | {"part": a, "first": convs[a][0], "last": convs[b - 1][0], "first_words": words[a], "last_words": words[b - 1]})
        done.append(own.nodes)
    while len(parts) > 2:
        at = r.randrange(len(parts) - 1)
        left, more = trie.contracted(parts[at:at + 2])
        assert len(left["depth"]) <= len(left["first"]) // trie.TURN + len(left["last"]) // trie.TURN + 2
        parts[at:at + 2] = [left]
        done.append(more)
    last = trie.of_parts(parts)
    last.merge(True)
    assert nodes(done + [last.nodes]) == nodes([whole.nodes])


def test_odd_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
    odd = spark.createDataFrame([(21, 0, "a", "b", 1, "z"), (7, 0, None, None, 2, "z"), (7, 0, None, None, 2, "z")], SCHEMA + ", depth int, key string")
    assert got(odd) == plain([tuple(r)[:4] for r in odd.collect()])
