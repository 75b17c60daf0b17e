"""The pipeline against a plain version of each stage on small tables."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from estrato.llm import decontaminate, packing, quality
from estrato.llm.queries import tokenizer_files

from .test_decontaminate import plain as fewest_edits
from .test_linedup import plain as plain_lines
from .test_simhash import plain_components, plain_fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make():
    r = random.Random(11)
    words = "river stone light under table green walks over naïve été window garden summer letter".split()

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."
    rows, labels, shared, items = [], [], prose(9), [(k, prose(25)) for k in range(4)]
    for k in range(160):
        if k % 5 == 0:
            text, good = " ".join(r.choice(["$$$", "###", "%%%"]) for _ in range(60)), 0
        else:
            text, good = "\n".join(prose(r.randint(8, 30)) for _ in range(r.randint(2, 5))), 1
            if k % 4 == 0:
                text += "\n" + shared
            if k % 13 == 0:
                text += "\n" + items[k % 4][1].upper()[:-1]
        rows.append((k, text, "en", "hot" if k % 3 else "s", len(text)))
        labels.append((k, good, 0))
    clean = [x for x in rows if x[0] % 5]
    rows += [(500 + k, clean[3][1].replace("\n", " ") + " " + clean[7][1].replace("\n", " "), "en", "copy", 1) for k in range(5)]
    rows += [(600, None, None, None, None), (None, prose(20), "en", "s", 3), (None, None, None, None, None), (601, "", "en", "s", 0), rows[6], rows[6]]
    return rows, labels, items


def write(spark, folder, rows, labels, items):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_matches_plain_stages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "VISITS", 1500)
    rows, labels, items = make()
    folder = write(spark, tmp_path, rows, labels, items)
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")

    model = quality.train(read("documents"), read("labels"), ~quality.held_out())
    good = []
    for x in rows:
        raw = np.frombuffer((x[1] or "").encode(), dtype=np.uint8)
        logit = quality.forward(model, *quality.padded(raw, np.array([0, len(raw)])))[0][0]
        if 1 / (1 + np.exp(-float(logit))) >= 0.7:
            good.append(x[:2])
    assert not any(k is not None and k < 160 and k % 5 == 0 for k, _ in good) and sum(k is not None and k < 160 for k, _ in good) > 115
    lines = [(k, text) for k, _, _, text in plain_lines(good)]
    fps = {plain_fingerprint(t) for _, t in lines}
    label = plain_components(fps, 2)
    rank = lambda x: (x[0] is None, x[0] or 0, hashlib.md5((x[1] or "").encode()).hexdigest())
    first = {}
    for x in lines:
        c = label[plain_fingerprint(x[1])]
        first[c] = min(x, first.get(c, x), key=rank)
    apart = list(first.values())
    clean = []
    for k, t in apart:
        norm = decontaminate.normal(t)
        hit = any(fewest_edits(decontaminate.normal(i), norm) <= int(len(decontaminate.normal(i)) * decontaminate.RATE) for _, i in items)
        if not hit:
            clean.append((k, t))
    assert len(good) > len({k for k, _ in apart}) > len({k for k, _ in clean}) > 50
    encode = packing.encoder(tokenizer_files()["tokenizer"], None)
    want = sorted(((k, len(encode(t)) + 1) for k, t in clean), key=str)

    out = corpus_pipeline.run(spark, folder).collect()
    got = sorted(((r["doc_id"], r["doc_tokens"]) for r in out if r["start"] == 0), key=str)
    assert got == want
    whole = {}
    for r in sorted(out, key=lambda r: r["start"]):
        if r["doc_id"] is not None:
            whole[r["doc_id"]] = whole.get(r["doc_id"], []) + np.frombuffer(r["ids"], "<u4").tolist()
    assert whole == {k: [*encode(t).tolist(), packing.END_ID] for k, t in clean if k is not None}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables_and_keep_columns(spark, tmp_path, name, stage):
    folder = write(spark, tmp_path, [], [], [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(spark, docs, folder)
    assert out.count() == 0
    assert name == "packing" or out.columns == docs.columns


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    """Copies go and passages are found whatever the ids; of each group the smallest id stays."""
    r = random.Random(2)
    a, b, c, item = (" ".join(r.choice("abcdefghijklmnop") * 3 + str(r.randint(0, 99)) for _ in range(60)) for _ in range(4))
    rows = [(1, a, "x", "s", 1), (5, a, "x", "s", 1), (5, b, "x", "s", 1), (5, b, "x", "r", 1), (None, b, None, None, None), (None, c, "x", "s", 1),
            (None, f"before {item} after", "x", "s", 1), (7, f"more {item}", "x", "s", 2)]
    folder = write(spark, tmp_path, rows, [], [(1, item)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    apart = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert sorted((tuple(x) for x in apart.collect() if x["text"] in (a, b, c)), key=str) == sorted([rows[0], rows[3], rows[5]], key=str)
    left = corpus_pipeline.drop_benchmark(spark, docs, folder)
    assert sorted((tuple(x) for x in left.collect()), key=str) == sorted(rows[:6], key=str)
