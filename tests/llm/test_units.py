"""Unit dedup against a plain version."""

import re

import pytest

from estrato.llm import units


def cut(text, unit):
    if unit == "line":
        return [(m.start(), m.end()) for m in re.finditer(rb"[^\n]+", text)]
    if unit == "paragraph":
        out, k = [], 0
        for block in re.split(rb"(\n[ \t\r\x0b\x0c]*(?=\n))", text):
            out.append((k, k + len(block)))
            k += len(block)
        return out
    return [(m.start(1), m.end(1)) for m in re.finditer(rb"([^\n]+?(?:[.!?](?=[\x20\t\r\x0b\x0c])|(?=\n)|$))", text)]


def plain(rows, unit, min_words):
    first, every = {}, []
    for doc, text in rows:
        raw, own = (text or "").encode(), (1 << 63) - 1 if doc is None else doc
        found = []
        for a, b in cut(raw, unit):
            words = re.findall(rb"[^\x20\x09-\x0D]+", raw[a:b])
            if len(words) >= min_words:
                a += len(raw[a:b]) - len(raw[a:b].lstrip(b" \t\n\r\x0b\x0c"))
                end = a + len(raw[a:b].rstrip(b" \t\n\r\x0b\x0c"))
                key = b" ".join(re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words)
                found.append((key, a, end))
                first[key] = min(first.get(key, (1 << 63, 0)), (own, a))
        every.append((doc, own, raw, found))
    out = []
    for doc, own, raw, found in every:
        spans = [(a, b) for key, a, b in found if first[key] < (own, a)]
        kept, k = b"", 0
        for a, b in spans:
            kept, k = kept + raw[k:a], b
        out.append((doc, (kept + raw[k:]).decode(), spans))
    return sorted(out, key=str)


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_matches_plain(docs, rows, unit):
    got = units.remove_repeated_units(docs, unit=unit, min_words=4).collect()
    got = sorted(((r["doc_id"], r["kept"], [tuple(s) for s in r["removed"]]) for r in got), key=str)
    assert got == plain([r[:2] for r in rows], unit, 4)


def test_passage_inside_a_line(spark):
    passage = " ".join(f"This is the sentence of number {k} in a passage." for k in range(7))
    frame = spark.createDataFrame([(1, "Own start here. " + passage + " And an end of the first."), (2, "Other begin words " + passage + " Different tail")],
                                  "doc_id long, text string")
    out = {r["doc_id"]: r for r in units.remove_repeated_units(frame).collect()}
    assert not out[1]["removed"] and len(out[2]["removed"]) == 6


def test_empty_table_and_bad_unit(no_docs):
    assert units.remove_repeated_units(no_docs).count() == 0
    with pytest.raises(ValueError):
        units.remove_repeated_units(no_docs, unit="word")


def plain_passages(rows, min_words):
    """The passages to remove by their texts, all of them held in one dictionary."""
    import re
    def sentences(text):
        data, out, at = (text or "").encode(), [], 0
        for line in data.split(b"\n"):
            begin = at
            for m in [*re.finditer(rb"[.!?](?=[\x20\x09-\x0D])", line), None]:
                end = at + (m.end() if m else len(line))
                piece = data[begin:end]
                words = re.findall(rb"[^\x20\x09-\x0D]+", piece)
                if words:
                    lead = len(piece) - len(piece.lstrip(b" \t\n\x0b\x0c\r"))
                    out.append((begin + lead, begin + len(piece.rstrip(b" \t\n\x0b\x0c\r")), [bytes(w).lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]))
                begin = end
            at += len(line) + 1
        return out
    found, where = [], {}
    for k, (doc, text) in enumerate(rows):
        own, cut = sentences(text), set()
        for i in range(len(own)):
            for way in (1, -1):
                j, n = i, len(own[i][2])
                while n < min_words and 0 <= j + way < len(own):
                    j += way
                    n += len(own[j][2])
                if n >= min_words:
                    cut.add((min(i, j), max(i, j)))
        rank = (1 << 63) - 1 if doc is None else doc
        for i, j in cut:
            key = tuple(w for s in own[i:j + 1] for w in s[2])
            found.append((k, rank, own[i][0], own[j][1], key))
            where[key] = min(where.get(key, (rank, own[i][0], own[j][1])), (rank, own[i][0], own[j][1]))
    gone = [set() for _ in rows]
    for k, rank, begin, end, key in found:
        first = where[key]
        if rank > first[0] or begin >= first[2]:
            gone[k] |= set(range(begin, end))
    out = []
    for (doc, text), drop in zip(rows, gone):
        data = (text or "").encode()
        out.append((doc, bytes(c for i, c in enumerate(data) if i not in drop).decode(), len(drop)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_words", [6, 20])
def test_passages_match_a_plain_version(docs, rows, min_words):
    """The unit of the registered query, over all odd rows and the very long one."""
    got = units.remove_repeated_units(docs, unit="passage", min_words=min_words).collect()
    got = sorted(((r["doc_id"], r["kept"], sum(s["end"] - s["begin"] for s in r["removed"])) for r in got), key=str)
    assert got == plain_passages([r[:2] for r in rows], min_words)


def test_clashing_columns(spark):
    odd = spark.createDataFrame([(1, "one two three four five six.", 1, "x"), (2, "One two  three four five six.", 2, None), (None, None, 3, "y")],
                                "doc_id long, text string, doc int, gone string")
    assert sorted(((r["doc_id"], r["kept"]) for r in units.remove_repeated_units(odd, unit="passage").collect()), key=str) == [
        (1, "one two three four five six."), (2, ""), (None, "")]
