"""Periodic runs of words: stretches that repeat themselves back to back.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that is long enough and that no neighbouring word extends. Every text is
laid out in overlapping tiles, anew for each octave of periods [P, 2P): a tile is as
long as it takes to hold any run of that octave in pieces that overlap by 4P words.
Tiles are solved by themselves. A run of period p spans p words from some boundary,
a multiple of P, so it is enough to know for each boundary how far its words agree
with those p words on, forwards and backwards: the two Z-functions of the boundary,
taken for all boundaries of all tiles at once. What comes out are interval fragments.
These are shuffled by text and period and stitched where they overlap by a period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from estrato.llm import textbytes
from estrato.session import materialise

#: Words from one tile to the next, where the octave does not ask for more.
TILE = 4096
#: Words of the tiles solved at once.
CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def names(codes: np.ndarray, longest: int) -> np.ndarray:
    """names[k][i] stands for the 2^k words from i on, up to 2^k <= ``longest``; those
    that would pass the end are not to be asked for."""
    out = [codes]
    while 2 << len(out) - 1 <= longest:
        step, last = 1 << len(out) - 1, out[-1]
        whole = last.copy()
        whole[:-step] = textbytes.mix(last[:-step] * _ODD + last[step:])
        out.append(whole)
    return np.stack(out)


def agree(name: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from ``x`` on are those from ``y`` on (``back``: up to there), ``room`` at most."""
    got = np.zeros(len(x), dtype=np.int64)
    for k in range(len(name) - 1, -1, -1):
        size = 1 << k
        some = np.flatnonzero(got + size <= room)
        if len(some):
            shift = -(got[some] + size) if back else got[some]
            same = name[k][x[some] + shift] == name[k][y[some] + shift]
            got[some[same]] += size
    return got


def least_factors(n: int) -> np.ndarray:
    """The smallest prime factor of each number up to n."""
    out = np.arange(n + 1)
    for f in range(2, int(n ** 0.5) + 1):
        if out[f] == f:
            part = out[f * f::f]
            part[part == np.arange(f * f, n + 1, f)] = f
    return out


def primitive(name: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no divisor of the period is a period of the stretch, too."""
    ok, rest = np.ones(len(period), dtype=bool), period.copy()
    factor = least_factors(int(period.max(initial=1)))
    while True:
        i = np.flatnonzero((rest > 1) & ok)
        if not len(i):
            return ok
        f = factor[rest[i]]
        q = period[i] // f
        size = end[i] - start[i] - q
        k = np.minimum(np.frexp(size.astype(float))[1] - 1, len(name) - 1)
        a, b = start[i], end[i] - q - (1 << k)  # two blocks that cover it, as 2^k > size / 2
        ok[i] = (name[k, a] != name[k, a + q]) | (name[k, b] != name[k, b + q])
        rest[i] //= f


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all intervals one after the other, and the interval of each."""
    size = np.maximum(ends - starts, 0)
    owner = np.repeat(np.arange(len(starts)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + starts[owner], owner


def solve(name: np.ndarray, at: np.ndarray, end: np.ndarray, octave: int, least: int):
    """(tile, period, start, end) of the maximal stretches of each tile [at, end) with a
    smallest period of the octave and of ``least`` words and two periods at least."""
    y, t = ranges(at + octave, end)
    x = y - octave - ((y - at[t]) & (octave - 1))  # each place has one boundary an octave's period before it
    every = np.arange(octave, min(2 * octave, max(least, octave + 1)))
    half = (np.maximum(least, 2 * every) - every + 1) // 2  # so long is one of the two agreements at least
    k = min(int(half.min()).bit_length() - 1, len(name) - 1)
    size = 1 << k
    on = np.flatnonzero(y + size <= end[t])
    on = on[name[k][x[on]] == name[k][y[on]]]
    back = np.flatnonzero(x - size >= at[t])
    back = back[name[k][x[back] - size] == name[k][y[back] - size]]
    i = np.union1d(on, back)
    x, y, t = x[i], y[i], t[i]
    period = y - x
    forward, backward = agree(name, x, y, end[t] - y), agree(name, x, y, x - at[t], back=True)
    start, stop = x - backward, y + forward
    ok = stop - start >= np.maximum(least, 2 * period)
    found = np.unique(np.column_stack([t[ok], period[ok], start[ok], stop[ok]]), axis=0)
    t, period, start, stop = found.T
    ok = primitive(name, start, stop, period)
    return t[ok], period[ok], start[ok], stop[ok]


def fragments(codes: np.ndarray, first: np.ndarray, count: np.ndarray, least: int):
    """(text, period, start, end) of the pieces of runs that the tiles of all octaves show,
    in words of their text; text i has ``count[i]`` words from ``first[i]`` on."""
    out = [np.zeros((4, 0), dtype=np.int64)]
    longest = int(count.max(initial=0))
    name = names(codes, longest) if longest >= least else None
    octave = 1
    while max(2 * octave, least) <= longest:
        own = np.flatnonzero(count >= max(2 * octave, least))
        step, lap = max(TILE, 4 * octave), max(4 * octave, least + 4)
        tiles = np.maximum(1, -(-(count[own] - lap) // step))
        k, owner = ranges(np.zeros(len(own), dtype=np.int64), tiles)
        owner = own[owner]
        at = first[owner] + k * step
        end = np.minimum(at + step + lap, first[owner] + count[owner])
        cuts = np.searchsorted(np.cumsum(end - at), np.arange(0, (end - at).sum(), CHUNK))
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(at)]):
            if hi > lo:
                t, period, start, stop = solve(name, at[lo:hi], end[lo:hi], octave, least)
                text = owner[lo:hi][t]
                out.append(np.stack([text, period, start - first[text], stop - first[text]]))
        octave *= 2
    return np.concatenate(out, axis=1)


def stitched(pieces: DataFrame) -> DataFrame:
    """(key, start, length, period) of whole runs from (key, period, start, end): pieces of
    a text and period that overlap by a period are one run; two runs overlap by less."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") > before - F.col("period")).cast("int"), F.lit(1))
    run = pieces.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("key", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(
        "key", "start", (F.col("end") - F.col("start")).alias("length"), "period")


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """One row per input row: ``doc_id`` (of its own type), ``n_words, runs, kept``.

    ``runs``: every run of ``least`` words and two periods or more as (start, length,
    period), ordered by start, then period. ``kept``: the words, joined by one space,
    without those that some run holds after its first period. NULL and empty texts
    have no words, no run and an empty ``kept``. NULL, repeated and equal ids are rows
    of their own; an empty table gives none. Other columns are ignored. A text is cut
    into tiles where it is read, so its words (about 150 bytes each) fit into a task.
    """
    id_type = dict(docs.select(F.col(f"`{id_col}`").alias("i")).dtypes)["i"]
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    piece = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def lay_out(batches):
        key = TaskContext.get().partitionId() << 40
        for part, data, offsets in textbytes.slices(batches):
            start, end, row = textbytes.words(data, offsets)
            codes = textbytes.Rolling(data).spans(start, end).view(np.uint64)
            first = np.searchsorted(row, np.arange(part.num_rows + 1))
            text, period, begin, stop = fragments(codes, first[:-1], np.diff(first), least)
            order = np.argsort(text, kind="stable")
            found = pa.StructArray.from_arrays([pa.array(x[order]) for x in (period, begin, stop)], names=["period", "start", "end"])
            cuts = pa.array(np.searchsorted(text[order], np.arange(part.num_rows + 1)).astype(np.int32))
            joined, new_start, new_end = textbytes.spaced(data, start, end)
            at = np.r_[new_start, len(joined)][first]  # a space ends each word, the last of a text too
            raw = joined.tobytes()
            plain = [raw[a:b - 1] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.arange(key, key + part.num_rows)), pa.array(np.diff(first), pa.int64()),
                 pa.array(plain, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(cuts, found).cast(piece)],
                names=["doc_id", "key", "n_words", "kept", "pieces"])
            key += part.num_rows

    laid = materialise(source.mapInArrow(
        lay_out, f"doc_id {id_type}, key long, n_words long, kept string, pieces array<struct<period: long, start: long, end: long>>"), "period-tiles")
    whole = stitched(laid.select("key", F.explode("pieces").alias("p")).select("key", "p.*"))
    listed = whole.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))

    def collapse(batches):
        for batch in batches:
            texts = []
            for text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split(" ")
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for r in own:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                texts.append(" ".join(w for w, gone in zip(words, np.cumsum(edge).tolist()) if not gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "runs", "kept"])

    kind = "array<struct<start: long, length: long, period: long>>"
    some = F.size("pieces") > 0
    held = laid.where(some).join(listed, "key").select("doc_id", "n_words", "kept", "runs")
    held = held.mapInArrow(collapse, f"doc_id {id_type}, n_words long, runs {kind}, kept string")
    return laid.where(~some).select("doc_id", "n_words", F.array().cast(kind).alias("runs"), "kept").union(held)
