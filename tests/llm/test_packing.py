"""Packing: exact round trip, limits, padding."""

import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from estrato.llm import packing
from estrato.llm.queries import tokenizer_files

FILES = tokenizer_files()


def check(frame, rows, max_tokens=2048, max_segments=256, max_loss=2048, free=1, **more):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(frame, **FILES, max_tokens=max_tokens, max_segments=max_segments, max_loss=max_loss, **more).collect()
    wanted = sorted(((doc, exact.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]) for doc, text in rows), key=str)
    texts, sequences = {}, {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], free))
        texts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
        sequences.setdefault(r["sequence_id"], []).append(r)
    got = []
    for (doc, size), parts in texts.items():
        copies = sum(start == 0 for start, _ in parts)
        ordered = sorted(parts, key=lambda p: (p[0], len(p[1])))
        if copies == 1:
            whole = []
            for start, ids in ordered:
                assert start == len(whole)
                whole += ids
            got.append((doc, whole))
            assert len(whole) == size
        else:
            assert sum(len(ids) for _, ids in parts) == size * copies
            got += [w for w in wanted if w[0] == doc and len(w[1]) == size]
    assert sorted(got, key=str) == wanted
    for own in sequences.values():
        own.sort(key=lambda r: r["segment"])
        total = 0
        for k, r in enumerate(own):
            assert (r["segment"], r["offset"]) == (k, total)
            total += r["length"]
        assert total <= max_tokens and len(own) <= max_segments and sum(r["loss_tokens"] for r in own) <= max_loss
        assert total == max_tokens or total & (total - 1) == 0  # no padding
    return out


def test_round_trip(docs, rows):
    check(docs, [r[:2] for r in rows])


@pytest.mark.parametrize("limits", [dict(max_tokens=64, max_segments=2), dict(max_tokens=128, max_loss=100), dict(max_tokens=1), dict(pool_tokens=300)])
def test_limits(spark, limits):
    rows = [(k, "word " * (k % 37)) for k in range(150)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), rows, **limits)


def test_prompts_bear_no_loss(spark):
    rows = [(k, "a prompt and then an answer " * 3) for k in range(20)]
    frame = spark.createDataFrame([(*r, 6, "x") for r in rows], "doc_id long, text string, prompt int, ids string")
    check(frame, rows, max_tokens=64, max_loss=40, free=6, free_col="prompt")


def test_empty_table(no_docs):
    assert packing.pack(no_docs, **FILES).count() == 0


def test_fast_encoder_agrees_on_all_it_takes():
    exact, fast = (packing.encoder(FILES["tokenizer"], x) for x in (None, FILES["ranks"]))
    taken = [chr(c) for c in range(0x2100) if packing.PLAIN.fullmatch(chr(c)) and unicodedata.category(chr(c)) != "Cs"]
    assert len(taken) > 500
    texts = [f"{c}" for c in taken] + [f"a{c}b {c} {c}{c}1{c}\n{c} '{c}s" for c in taken] + ["".join(taken), "<|endoftext|> and <|x|>", "日本   text"]
    for text in texts:
        assert exact(text).tolist() == fast(text).tolist(), text


def test_digest_is_of_the_ids(spark):
    from pyspark.sql import functions as F
    r = packing.pack(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), **FILES).withColumn("c", F.crc32("ids")).collect()
    assert all(x["c"] == zlib.crc32(x["ids"]) for x in r)
