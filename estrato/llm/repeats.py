"""Repeated substrings of a corpus, from sharded suffix arrays.

Two strings of ``length`` bytes that are equal have their smallest k-gram hash
at the same place, their anchor. Every document is cut into runs: the strings
that share one anchor. A run is its text; equal runs are a class, counted before
they are shuffled. All of a run's strings repeat if its class has two members.
Otherwise a string of it can repeat only in another class with the same anchor,
so the texts of such classes, one of each, go to the shard of their anchor.

A shard groups the suffixes of its texts by a hash of their first ``length``
bytes: each group is a subtree of the tree of common-prefix intervals. One whose
occurrences all have the same byte before them could be extended to the left at
once, and so could all below it. The others are sorted into a suffix array with
its common prefixes (where a chance meeting of hashes shows), and a scan with a
stack walks their intervals, keeps those of at least ``length`` bytes with
different bytes before them, and gives each such maximal repeat with all of its
occurrences. An anchor with very many classes is not put into
one shard: its strings are hashed one by one and counted by their hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from estrato.llm import textbytes
from estrato.session import materialise

GRAM = 32
#: Text of a shard on average, and classes of one anchor in it at most.
SHARD_BYTES, CLASSES = 2 << 20, 8192
#: Text that a task works on at once, a longer one by tiles; the arrays made from it take about 100 times as much.
PIECE_BYTES = 1 << 19
#: Runs whose texts are sent on at once.
FETCH_RUNS = 1 << 12


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, start, strings, anchor hash, text hash) of the runs of all texts."""
    none = np.zeros(0, dtype=np.int64)
    width = length - gram + 1
    n = len(data) - length + 1
    if n <= 0:
        return (none,) * 5
    rolling = textbytes.Rolling(data)
    h = rolling.windows(gram)
    # Ties and near ties go to the leftmost gram, which equal strings agree on: as many bits count in pieces of any size.
    bits = np.uint64(max(24, int(len(h)).bit_length()))
    key = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    real = key[:len(h)]
    np.left_shift(np.right_shift(h, bits, out=real), bits, out=real)
    real |= np.arange(len(h), dtype=np.uint64)
    blocks = key.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    np.minimum.accumulate(blocks[:, ::-1], axis=1, out=blocks[:, ::-1])
    anchor = np.minimum(key[:n], ahead[width - 1:width - 1 + n], out=key[:n])
    anchor &= (np.uint64(1) << bits) - np.uint64(1)
    anchor = anchor.view(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.flatnonzero(np.arange(length, n + length) <= offsets[1:][row])
    if not len(inside):
        return (none,) * 5
    new = np.r_[True, (np.diff(anchor[inside]) != 0) | (np.diff(row[inside]) != 0) | (np.diff(inside) != 1)]
    first = np.flatnonzero(new)
    start, strings = inside[first], np.diff(np.r_[first, len(inside)])
    return row[start], start - offsets[row[start]], strings, h[anchor[start]].view(np.int64), rolling.spans(start, start + strings - 1 + length)


def cut(batches, length: int, gram: int):
    """The runs of all rows (key, text) as rows of (key, start, strings, anchor, text).

    A text beyond ``PIECE_BYTES`` is cut by tiles that share ``length - 1`` bytes, so each
    string is in one of them; a run over their border becomes two of the same anchor."""
    for part, data, offsets in textbytes.slices(batches, limit=PIECE_BYTES):
        for begin in range(0, max(1, len(data) - length + 1), PIECE_BYTES):
            tile = data[begin:begin + PIECE_BYTES + length - 1]
            row, start, *rest = runs(tile, np.minimum(offsets, len(tile)), length, gram)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *(pa.array(x) for x in (start + begin, *rest))],
                                             names=["key", "start", "strings", "anchor", "text"])


def fetch(batches, length: int):
    """The texts of the runs that are listed beside each text."""
    for part, data, offsets in textbytes.slices(batches, limit=PIECE_BYTES):
        own = part.column(1)
        row = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy(zero_copy_only=False))
        own = own.flatten()
        begin = offsets[row] + own.field("start").to_numpy()
        end = begin + own.field("strings").to_numpy() - 1 + length
        for a in range(0, len(own), FETCH_RUNS):
            some = own.slice(a, FETCH_RUNS).flatten()
            bodies = pa.array([data[x:y].tobytes() for x, y in zip(begin[a:a + FETCH_RUNS], end[a:a + FETCH_RUNS])], pa.binary())
            yield pa.RecordBatch.from_arrays([*some[2:], bodies], names=["anchor", "class", "n", "classes", "body"])


def equal_starts(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, first) of all suffixes with ``length`` bytes at least, those with a
    common hash of so many bytes together; ``first`` begins each such group."""
    begin = np.r_[0, ends[:-1]]
    count = np.maximum(ends - begin - length + 1, 0)
    places, hashes, i = [], [], 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, begin[i] + PIECE_BYTES, side="right")))
        n = count[i:j]
        at = np.repeat(begin[i:j] - begin[i] - np.cumsum(n) + n, n) + np.arange(n.sum())
        hashes.append(textbytes.Rolling(text[begin[i]:ends[j - 1]]).spans(at, at + length))
        places.append(at + begin[i])
        i = j
    h, places = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(h, kind="stable")
    places, h = places[order], h[order]
    return places, np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, dtype=np.int64)


def intervals(prefix: list[int]) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of a suffix array with the
    common prefixes ``prefix`` of neighbours: the nodes of its interval tree."""
    out, stack = [], []
    for i, lcp in enumerate([*prefix, -1]):
        first = i
        while stack and stack[-1][0] > lcp:
            depth, first = stack.pop()
            out.append((depth, first, i))
        if lcp >= 0 and (not stack or stack[-1][0] < lcp):
            stack.append((lcp, first))
    return out


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def maximal_repeats(texts: list[bytes], length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bytes, [(text, start), ...]) of every repeat of at least ``length`` bytes that
    cannot be extended to the left or right in all of its occurrences."""
    if not texts:
        return []
    ends = np.cumsum([len(t) for t in texts])
    begin = np.r_[0, ends[:-1]]
    whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
    places, first = equal_starts(whole, ends, length)
    stop = np.r_[first[1:], len(places)]
    owner = np.searchsorted(ends, places, side="right")
    # The byte before each string; the start of a text differs from all.
    before = np.where(places == begin[owner], 256 + np.arange(len(places)), whole[np.maximum(places - 1, 0)].astype(np.int64))
    out = []
    if len(first):
        many = stop - first > 1
        diverse = np.minimum.reduceat(before, first) != np.maximum.reduceat(before, first)
        for a, b in zip(first[many & diverse].tolist(), stop[many & diverse].tolist()):
            # Sorted suffixes and their common prefixes: the enhanced suffix array of one
            # subtree of the interval tree, or of several if hashes met by chance.
            tails = sorted((texts[o][p - begin[o]:], k) for k, (o, p) in enumerate(zip(owner[a:b].tolist(), places[a:b].tolist()), a))
            prefix = [common(x[0], y[0]) for x, y in zip(tails, tails[1:])]
            for depth, lo, hi in intervals(prefix):
                here = [tails[k][1] for k in range(lo, hi + 1)]
                if depth >= length and len({int(before[k]) for k in here}) > 1:
                    out.append((depth, [(int(owner[k]), int(places[k] - begin[owner[k]])) for k in here]))
    return out


def covered(texts: list[bytes], length: int) -> list[tuple[int, int]]:
    """The part of each run's text that repeats elsewhere, (0, 0) for none. All
    strings of a run hold its anchor, so what repeats of it is one piece."""
    lo, hi = [1 << 62] * len(texts), [0] * len(texts)
    for size, places in maximal_repeats(texts, length):
        for text, start in places:
            lo[text], hi[text] = min(lo[text], start), max(hi[text], start + size)
    return [(a, b) if b else (0, 0) for a, b in zip(lo, hi)]


def strip(batches):
    """The texts without the spans listed beside them, as (doc_id, n_bytes, kept, spans)."""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for part, data, offsets in textbytes.slices(batches, limit=PIECE_BYTES):
        kept, merged = [], []
        for a, z, own in zip(offsets, offsets[1:], part.column(2).to_pylist()):
            raw, out = data[a:z].tobytes(), []
            for b, e in sorted((s["begin"], s["end"]) for s in own or ()):
                if out and b <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], e)
                else:
                    out.append({"begin": b, "end": e})
            cuts = [0, *(x for s in out for x in (s["begin"], s["end"])), len(raw)]
            kept.append(b"".join(raw[b:e] for b, e in zip(cuts[::2], cuts[1::2])))
            merged.append(out)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()), pa.array(merged, kind)],
                                         names=["doc_id", "n_bytes", "kept", "spans"])


def repeat_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, begin, end): bytes of documents that repeat elsewhere; spans may overlap."""
    cuts = materialise(docs.select("key", "text").mapInArrow(lambda batches: cut(batches, length, gram), "key binary, start long, strings long, anchor long, text long"), "repeat-runs")
    classes = materialise(cuts.groupBy("anchor", "text").agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "strings")).alias("at")), "repeat-classes")
    shared = materialise(classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("n").alias("least"))
                         .where("classes > 1 and least = 1"), "repeat-anchors")
    wanted = classes.join(shared, "anchor").select("anchor", "text", "n", "classes", "at.*")
    held = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "strings", "anchor", F.col("text").alias("class"), "n", "classes")).alias("runs"))

    # Repeated rows of the input give a class's text several times.
    bodies = docs.join(held, "key").select("text", "runs").mapInArrow(lambda batches: fetch(batches, length), "anchor long, class long, n long, classes long, body binary")
    bodies = materialise(bodies, "repeat-bodies")
    size = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = max(1, -(-size // SHARD_BYTES))

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["anchor", "class"]).sort_values(["anchor", "class"])
        texts, anchor = frame["body"].tolist(), frame["anchor"].to_numpy()
        # Equal strings have one anchor: anchors are gone through by pieces of the shard.
        edge = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
        ends, spans, a = np.cumsum([0, *map(len, texts)])[edge], [], 0
        while a < len(edge) - 1:
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + PIECE_BYTES, side="right")) - 1)
            spans += covered(texts[edge[a]:edge[b]], length)
            a = b
        spans = np.array(spans).reshape(-1, 2)
        out = pd.DataFrame({"anchor": frame["anchor"].to_numpy(), "text": frame["class"].to_numpy(), "begin": spans[:, 0], "end": spans[:, 1]})
        return out[(spans[:, 1] > 0) & (frame["n"].to_numpy() == 1)]

    schema = "anchor long, text long, begin long, end long"
    usual = bodies.where(F.col("classes") <= CLASSES).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(count)))
    found = usual.groupBy("shard").applyInPandas(scan, schema)

    def strings(batches):
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in (0, 1, 4)]
            for anchor, cls, body in zip(*cols):
                data = np.frombuffer(body, dtype=np.uint8)
                h = [textbytes.Rolling(data, k).windows(length).view(np.int64) for k in (0, 1)]
                n = len(h[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(np.full(n, cls)), pa.array(np.arange(n)), *map(pa.array, h)],
                                                 names=["anchor", "text", "at", "h1", "h2"])

    crowded = bodies.where(F.col("classes") > CLASSES)
    if not crowded.isEmpty():
        every = crowded.dropDuplicates(["anchor", "class"]).mapInArrow(strings, "anchor long, text long, at long, h1 long, h2 long")
        twice = materialise(every.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1").select("h1", "h2"), "repeat-strings")
        met = every.join(twice, ["h1", "h2"]).groupBy("anchor", "text").agg(F.min("at").alias("begin"), (F.max("at") + length).alias("end"))
        found = found.union(met)
    single = found.join(classes.where("n = 1").select("anchor", "text"), ["anchor", "text"], "left_semi")
    whole = classes.where("n > 1").select("anchor", "text", F.lit(0).cast("long").alias("begin"), (F.col("at.strings") - 1 + length).alias("end"))
    cover = materialise(whole.union(single), "repeat-cover")
    return cuts.join(cover, ["anchor", "text"]).select("key", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, kept`` (binary) and ``spans``, the
    removed [begin, end) byte ranges of the original text in order.

    A byte goes if a string of ``length`` bytes over it starts at any other place
    of the corpus too. NULL and empty texts, and those shorter than ``length``,
    stay as they are. Equal rows are copies of each other, so all of them go
    (as far as they are long enough); ids may be NULL. An empty table gives no
    rows; other columns are ignored.
    """
    gram = gram or min(GRAM, max(1, length // 4))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text"))
    source = source.withColumn("key", F.substring(F.unhex(F.sha2(named, 256)), 1, 16))
    spans = repeat_spans(source.select("key", "text"), length, gram)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))

    joined = source.join(spans, "key", "left").select("doc_id", "text", "spans")
    schema = T.StructType([joined.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])))])
    return joined.mapInArrow(strip, schema)
