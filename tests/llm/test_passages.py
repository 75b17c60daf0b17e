"""Passages of sentences that are too short to be compared one by one."""

import pytest

from estrato.llm import units


def removed(frame, **how):
    return {r["doc_id"]: r for r in units.remove_repeated_units(frame, **how).collect()}


def test_lines_and_paragraphs_of_short_sentences_go_whole(spark):
    line = " ".join(f"Go {w}. Do it now." for w in "on up in off out by at to over under".split())
    block = "\n".join(f"Take {w}." for w in "one two three four five six seven".split())
    frame = spark.createDataFrame([(1, f"Own words.\n{line}\n\n{block}"), (2, f"Not the same.\n{line}\nNo."), (3, f"{block}\n\nYes.")], "doc_id long, text string")
    out = removed(frame, unit="passage")
    assert not out[1]["removed"]
    assert out[2]["kept"] == "Not the same.\n\nNo." and out[3]["kept"] == "\n\nYes."


def test_short_sentences_stay_where_no_passage_repeats(spark):
    frame = spark.createDataFrame([(1, "He nodded. The rest of this line is its own."), (2, "Why not? He nodded. Another one follows here with words."),
                                   (3, "Ha. Ha. Ha. Ha. Ha. Ha. Ha. Ha.")], "doc_id long, text string")
    assert not any(r["removed"] for r in removed(frame, unit="passage").values())


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_nothing_that_another_unit_removes_is_left(docs, unit):
    one = units.remove_repeated_units(docs, unit=unit, min_words=4).collect()
    every = {}
    for r in units.remove_repeated_units(docs, unit="passage", min_words=4).collect():
        every.setdefault(r["doc_id"], []).append({k for s in r["removed"] for k in range(s["begin"], s["end"])})
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], (r["text"] or "").encode())
    assert any(r["removed"] for r in one)
    for r in one:
        solid = {k for s in r["removed"] for k in range(s["begin"], s["end"]) if not texts[r["doc_id"]][k:k + 1].isspace()}
        assert all(solid <= e for e in every[r["doc_id"]])
