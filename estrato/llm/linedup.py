"""Repeated lines, found with two Bloom filters and confirmed exactly.

Each block of documents sends the distinct keys of its lines, as 32-bit probes,
to the filter segments they hash to. A segment keeps two Bloom filters: keys
seen once, and keys met again while already in the first. It then answers every
block with the probes that hit the second filter. Only the lines behind those,
the suspected repeats, are shuffled with their whole 128-bit keys, which settles
how many documents hold them and which comes first. The filters are sharded by
hash and their number follows the number of lines, so none is ever broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from estrato.llm import textbytes
from estrato.session import materialise

#: Keys of a filter segment on average, and bits and probes of its filters.
SEGMENT_KEYS = 1 << 18
FILTER_BITS, PROBES = 1 << 22, 3
#: Line keys of a block of documents.
BLOCK_KEYS = 1 << 16


def keyed_lines(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """(starts, ends, row, h1, h2, long): every line, its key's 128-bit hash and
    whether the key has ``min_chars`` code points."""
    starts, ends, row = textbytes.lines(data, offsets)
    a, b = textbytes.stripped(data, starts, ends)
    small = textbytes.lower(data)
    points = textbytes.code_points(data)
    return (starts, ends, row, textbytes.Rolling(small).spans(a, b), textbytes.Rolling(small, 1).spans(a, b),
            points[b] - points[a] >= min_chars)


def line_blocks(docs: DataFrame, min_chars: int) -> DataFrame:
    """(block, doc, h1, h2): arrays as binary, a distinct (document, key) once a slice."""
    def run(batches):
        block = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        for part, data, offsets in textbytes.slices(batches):
            _, _, row, h1, h2, long = keyed_lines(data, offsets, min_chars)
            doc = part.column(0).to_numpy()[row[long]]
            found = np.unique(np.column_stack([doc, h1[long], h2[long]]), axis=0)
            held.append(found)
            if sum(map(len, held)) >= BLOCK_KEYS:
                yield packed(block, held)
                block, held = block + 1, []
        if sum(map(len, held)):
            yield packed(block, held)

    def packed(block, held):
        doc, h1, h2 = np.ascontiguousarray(np.concatenate(held).T)
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(doc)]), *(pa.array([x.tobytes()]) for x in (doc, h1, h2))],
                                          names=["block", "n", "doc", "h1", "h2"])

    return docs.mapInArrow(run, "block long, n long, doc binary, h1 binary, h2 binary")


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64)


def segment_of(h1: np.ndarray, segments: int) -> np.ndarray:
    return ((h1.view(np.uint64) >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)


def positions(probes: np.ndarray) -> np.ndarray:
    """The filter bits of 32-bit probes, one row for each probe function."""
    h = textbytes.mix(probes.astype(np.uint64))
    step = h >> np.uint64(32) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) % np.uint64(FILTER_BITS) for k in range(PROBES)]).astype(np.int64)


def suspects_of(frame: pd.DataFrame) -> pd.DataFrame:
    """The answers of one segment: (block, probes in the twice-seen filter)."""
    frame = frame.sort_values("block")
    once, twice = np.zeros(FILTER_BITS, dtype=bool), np.zeros(FILTER_BITS, dtype=bool)
    sent = [(np.frombuffer(p, dtype=np.uint32), np.frombuffer(m, dtype=bool)) for p, m in zip(frame["probes"], frame["many"])]
    for probes, many in sent:
        bits = positions(probes)
        again = once[bits].all(axis=0) | many
        twice[bits[:, again]] = True
        once[bits] = True
    hits = [p[twice[positions(p)].all(axis=0)].tobytes() for p, _ in sent]
    out = pd.DataFrame({"block": frame["block"].to_numpy(), "segment": frame["segment"].to_numpy(), "hits": hits})
    return out[[len(h) > 0 for h in hits]]


def matched(seg: np.ndarray, probe: np.ndarray, hits: list[dict]) -> np.ndarray:
    """Which keys, by segment and probe, are among the answers of the segments."""
    found = [np.frombuffer(hit["hits"], dtype=np.uint32).astype(np.uint64) | np.uint64(hit["segment"] << 32) for hit in hits]
    return np.isin(seg.astype(np.uint64) << np.uint64(32) | probe.astype(np.uint64), np.concatenate(found))


def repeated_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, h1, h2): the lines to drop, those of every document but the first; not all distinct."""
    blocks = materialise(line_blocks(docs, min_chars), "line-blocks")
    keys = blocks.agg(F.sum("n")).first()[0] or 0
    segments = max(1, -(-keys // SEGMENT_KEYS))

    def send(batches):
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h1, times = np.unique(longs(raw), return_counts=True)
                seg = segment_of(h1, segments)
                order = np.argsort(seg, kind="stable")
                own, first = np.unique(seg[order], return_index=True)  # those met here, however many there are
                parts = np.split(order, first[1:]) if len(own) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array([block] * len(own), pa.int64()),
                     pa.array([h1[p].astype(np.uint32).tobytes() for p in parts], pa.binary()),
                     pa.array([(times[p] > 1).tobytes() for p in parts], pa.binary())],
                    names=["segment", "block", "probes", "many"])

    def settle(batches):
        for batch in batches:
            for doc, h1, h2, hits in zip(*(batch.column(i).to_pylist() for i in range(4))):
                doc, h1, h2 = longs(doc), longs(h1), longs(h2)
                seg, probe = segment_of(h1, segments), h1.astype(np.uint32)
                marked = matched(seg, probe, hits)
                yield pa.RecordBatch.from_arrays([pa.array(x[marked]) for x in (doc, h1, h2)], names=["doc", "h1", "h2"])

    answers = (blocks.select("block", "h1").mapInArrow(lambda b: send(b), "segment long, block long, probes binary, many binary")
               .groupBy("segment").applyInPandas(suspects_of, "block long, segment long, hits binary")
               .groupBy("block").agg(F.collect_list(F.struct("segment", "hits")).alias("hits")))
    suspects = materialise(blocks.join(answers, "block").select("doc", "h1", "h2", "hits")
                           .mapInArrow(settle, "doc long, h1 long, h2 long"), "line-suspects")
    confirmed = suspects.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    # Written, so that both sides of the join are plain shuffles, of which Spark can split a hot key.
    confirmed = materialise(confirmed.select("h1", "h2", "first"), "line-first")
    return suspects.join(confirmed, ["h1", "h2"]).where("doc > first").select("doc", "h1", "h2")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Every input row as struct ``row``, with ``kept`` (its text without the lines
    that an earlier document holds), ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of separators at both ends and with A-Z
    lower-cased. Keys of at least ``min_chars`` code points found in two or more
    documents stay only in the document with the smallest id. NULL and empty
    texts are one empty line, and ``kept`` is then empty. Rows with one id are one
    document; all rows with a NULL id are one document that comes after all
    others. An empty table gives none. Input columns may have any name.
    """
    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                         F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest"))
    drops = repeated_keys(source.select("doc", "text"), min_chars)
    drops = drops.groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("drop"))

    def rebuild(batches):
        for part, data, offsets in textbytes.slices(batches, "text"):
            lists = part.column(part.schema.names.index("drop")).to_pylist()
            starts, ends, row, h1, h2, long = keyed_lines(data, offsets, min_chars)
            total = np.bincount(row, minlength=part.num_rows)
            first = np.r_[0, np.cumsum(total)]
            texts, dropped = [], np.zeros(part.num_rows, dtype=np.int64)
            for i, drop in enumerate(lists):
                lo, hi = first[i], first[i + 1]
                if drop:
                    gone = {(x["h1"], x["h2"]) for x in drop}
                    keep = [k for k in range(lo, hi) if not (long[k] and (int(h1[k]), int(h2[k])) in gone)]
                    dropped[i] = hi - lo - len(keep)
                    texts.append(b"\n".join(data[starts[k]:ends[k]].tobytes() for k in keep))
                else:
                    texts.append(data[offsets[i]:offsets[i + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.names.index("rest")), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total), pa.array(dropped)],
                names=["rest", "kept", "n_lines", "n_dropped"])

    joined = source.join(drops, "doc", "left").select("text", "rest", "drop")
    schema = T.StructType([T.StructField("rest", source.schema["rest"].dataType), T.StructField("kept", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(rebuild, schema)
