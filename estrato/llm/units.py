"""Repeated lines, paragraphs, sentences or passages, by the digests of normalised units.

A passage is as many adjacent sentences of a text, over line ends too, as it takes to
have ``min_words`` words: from each sentence onwards and from each one back. Any
sequence of whole sentences with that many words is made of passages, so a repeated
line or paragraph goes whole, however short its sentences are.

Units are normalised (A-Z lower-cased, white space as single spaces) and hashed
to 128 bits, once; places and digests are a written table. Digests are grouped over
the whole corpus; the occurrence that ranks first, by document id and then by place,
stays and the others go. Only the ranges to remove go back to the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from estrato.llm import textbytes
from estrato.session import materialise


def cut(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row): lines; or paragraphs, which blank lines part; or the
    sentences of lines, which end with ``.``, ``!`` or ``?`` before white space."""
    starts, ends, row = textbytes.lines(data, offsets)
    if unit == "line":
        return starts, ends, row
    if unit == "paragraph":
        a, b = textbytes.stripped(data, starts, ends)
        new = (a == b) | np.r_[True, row[1:] != row[:-1]]
        new |= np.r_[True, (a == b)[:-1]]
        first = np.flatnonzero(new)
        return starts[first], ends[np.r_[first[1:], len(starts)] - 1], row[first]
    stop = np.isin(data, np.frombuffer(b".!?", dtype=np.uint8))
    inner = np.flatnonzero(stop[:-1] & textbytes.SPACES[data[1:]]) + 1 if len(data) else np.zeros(0, dtype=np.int64)
    line = np.searchsorted(starts, inner, side="right") - 1
    ok = inner < ends[line]
    inner, line = inner[ok], line[ok]
    order = np.lexsort((np.r_[starts, inner], np.r_[np.arange(len(starts)), line]))
    s, owner = np.r_[starts, inner][order], np.r_[np.arange(len(starts)), line][order]
    e = ends[owner].copy()
    same = np.flatnonzero(owner[1:] == owner[:-1])
    e[same] = s[same + 1]
    return s, e, row[owner]


def passages(first: np.ndarray, last: np.ndarray, row: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to): places of the first and last unit of each passage, in order. Units
    have the words [first, last) of all texts, which follow one another."""
    n = len(first)
    every = np.arange(n)
    to = np.searchsorted(last, first + min_words)
    onward = (to < n) & (row[np.minimum(to, n - 1)] == row)
    back = np.searchsorted(first, last - min_words, side="right") - 1
    before = (back >= 0) & (row[back] == row)
    pair = np.unique(np.r_[every[onward] * n + to[onward], back[before] * n + every[before]])
    return pair // max(n, 1), pair % max(n, 1)


def digests(data: np.ndarray, offsets: np.ndarray, unit: str, min_words: int):
    """(starts, ends, row, h1, h2) of the units of ``min_words`` words or more, without
    the white space around them, and the number of units or sentences of each text."""
    starts, ends, row = cut(data, offsets, unit)
    total = np.bincount(row, minlength=len(offsets) - 1)
    starts, ends = textbytes.stripped(data, starts, ends)
    small = textbytes.lower(data)
    word_start, word_end, _ = textbytes.words(small, offsets)
    text, new_start, new_end = textbytes.spaced(small, word_start, word_end)
    first, last = np.searchsorted(word_start, starts), np.searchsorted(word_start, ends)
    some = (ends > starts) & (last > first)
    starts, ends, row, first, last = (x[some] for x in (starts, ends, row, first, last))
    if unit == "passage":
        begin, end = passages(first, last, row, min_words)
        starts, ends, row, first, last = starts[begin], ends[end], row[begin], first[begin], last[end]
    else:
        some = last - first >= min_words
        starts, ends, row, first, last = (x[some] for x in (starts, ends, row, first, last))
    a, b = new_start[first], new_end[last - 1]
    return starts, ends, row, textbytes.Rolling(text).spans(a, b), textbytes.Rolling(text, 1).spans(a, b), total


def remove_repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = 6) -> DataFrame:
    """One row per input row: ``doc_id, kept, n_units, removed``; ``removed`` lists the
    [begin, end) byte ranges of the original text that went, in order.

    Units of fewer than ``min_words`` words always stay; a passage has no fewer, but
    its sentences may. A passage that overlaps its own first occurrence stays.
    White space around a removed unit stays. ``n_units`` counts units of any
    length, sentences for passages. NULL and empty texts have no such unit; ``kept`` is
    empty. Rows with one id are one document; rows with a NULL id are one that
    ranks after all others. An empty table gives no rows; other columns are ignored.
    """
    if unit not in ("line", "paragraph", "sentence", "passage"):
        raise ValueError(f"no such unit: {unit}")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # Rows with one id and text have the same ranges; so many rows without an id share no list.
    keyed = source.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("of"), "text")

    def find(batches):
        for part, data, offsets in textbytes.slices(batches):
            starts, ends, row, h1, h2, _ = digests(data, offsets, unit, min_words)
            base, owner = offsets[row], pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column(0).take(owner), part.column(1).take(owner), *map(pa.array, (starts - base, ends - base, h1, h2))],
                                             names=["doc", "of", "at", "past", "h1", "h2"])

    units = keyed.select("doc", "of", "text").mapInArrow(find, "doc long, of long, at long, past long, h1 long, h2 long")
    units = materialise(units, "units")
    place = F.struct("doc", "at", "past")
    first = units.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = materialise(first.where("first < last").select("h1", "h2", "first"), "unit-first")
    gone = units.join(first, ["h1", "h2"]).where("doc > first.doc or doc = first.doc and at >= first.past")
    gone = gone.groupBy("doc", "of").agg(F.sort_array(F.collect_set(F.struct("at", "past"))).alias("gone"))

    def strip(batches):
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for part, data, offsets in textbytes.slices(batches):
            _, _, row = cut(data, offsets, unit)
            total = np.bincount(row, minlength=part.num_rows)
            listed = part.column(part.schema.names.index("gone"))
            at, past = (listed.flatten().field(c).to_numpy() for c in ("at", "past"))
            size = listed.value_lengths().fill_null(0).to_numpy()
            upto = np.cumsum(size)
            kept, begins, ends, count = [], [], [], np.zeros(part.num_rows, dtype=np.int64)
            for i in range(part.num_rows):
                raw = data[offsets[i]:offsets[i + 1]].tobytes()
                if size[i]:
                    a, b = at[upto[i] - size[i]:upto[i]], np.maximum.accumulate(past[upto[i] - size[i]:upto[i]])
                    new = np.flatnonzero(np.r_[True, a[1:] >= b[:-1]])  # where no range before reaches to
                    begin, end = a[new], b[np.r_[new[1:], len(b)] - 1]
                    cuts = [0, *np.column_stack([begin, end]).ravel().tolist(), len(raw)]
                    raw = b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2]))
                    begins.append(begin)
                    ends.append(end)
                    count[i] = len(begin)
                kept.append(raw)
            spans = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *x])) for x in (begins, ends)], names=["begin", "end"])
            removed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), spans).cast(kind)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), removed],
                                             names=["doc_id", "kept", "n_units", "removed"])

    joined = keyed.join(gone, ["doc", "of"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(strip, "doc_id long, kept string, n_units long, removed array<struct<begin: long, end: long>>")
