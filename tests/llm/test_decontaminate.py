"""Benchmark search against the plain edit-distance table."""

import random

from estrato.llm import decontaminate as d


def plain(item, text):
    """Fewest edits of the item in any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(r, text, n):
    for _ in range(n):
        k = r.randrange(len(text))
        text = text[:k] + r.choice(["", "q", text[k] + "z"]) + text[k + 1:]
    return text


def test_bit_vectors_match_the_table():
    r = random.Random(2)
    for _ in range(60):
        item = "".join(r.choice("abé ") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("abé ") for _ in range(r.randint(0, 120)))
        assert d.Item(1, item, 0.0).best(text)[0] == plain(item, text)


def test_finds_all_within_the_budget(spark):
    r = random.Random(4)
    words = "alpha beta gamma delta épsilon zeta eta theta iota kappa".split()
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(3, 30)))) for k in range(12)] + [(50, None), (51, " "), (52, "Alpha"), (None, "kappa kappa kappa kappa beta")]
    docs = []
    for k in range(60):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 60)))
        if k % 3 == 0:
            text += " " + edited(r, items[k % 12][1], k % 7).upper().replace(" ", " \n ") + " tail"
        docs.append((k, text))
    docs += [(100, None), (None, "x alpha y"), (7, docs[7][1])]
    out = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), rate=0.08)
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in out.collect()), key=str)
    want = []
    for doc, text in docs:
        for item, body in items:
            if d.normal(body) and d.normal(text):
                n = plain(d.normal(body), d.normal(text))
                if n <= int(len(d.normal(body)) * 0.08):
                    want.append((doc, item, n))
    assert got == sorted(want, key=str) and any(w[2] for w in want)
    for r in out.collect():
        if r["distance"] == 0 and r["doc_id"] is not None:
            text = d.normal(dict(docs)[r["doc_id"]]).split()
            assert d.normal(dict(items)[r["item_id"]]) in " ".join(text[r["start_word"]:r["end_word"]])


def test_items_in_blocks_and_empty_tables(spark, docs, no_docs, monkeypatch):
    items = spark.createDataFrame([(k, f"light over under table {k} green walks") for k in range(9)], "item_id long, text string")
    whole = d.contaminated(docs, items, rate=0.2).collect()
    monkeypatch.setattr(d, "ITEM_BYTES", 60)
    assert sorted(map(str, d.contaminated(docs, items, rate=0.2).collect())) == sorted(map(str, whole))
    assert d.contaminated(no_docs, items).count() == 0 and d.contaminated(docs, items.limit(0)).count() == 0
