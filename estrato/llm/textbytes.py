"""Vectorised work on the UTF-8 bytes of Arrow string columns.

Arrow keeps the texts of a batch back to back in one buffer, so tokens, lines
and windows of all rows can be cut and hashed without a loop over rows. A
64-bit hash of any span comes from two prefix sums (see :class:`Rolling`).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Bytes of text worked on at once; the arrays made from them take about 100 times as much.
SLICE_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The separators of the word contracts: space and the bytes 0x09 to 0x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """64-bit hashes of any spans of a byte array, equal for equal bytes.

    ``which`` (0 or 1) picks one of two independent hashes.
    """

    _forward = _back = np.zeros(0, dtype=np.uint64)

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        if len(Rolling._forward) < n + 1:
            Rolling._forward, Rolling._back = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODES[which][data] * Rolling._forward[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes as int64, of the spans from ``starts`` up to ``ends``."""
        h = (self.sums[ends] - self.sums[starts]) * Rolling._back[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) * _M2)).view(np.int64)

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all windows of one width, as uint64, in order of their start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * Rolling._back[:n])


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes as they are."""
    return _LOWER[data]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches of about ``limit`` bytes of text, one row at least,
    each with its bytes and offsets."""
    for batch in batches:
        data, offsets = buffers(batch.column(batch.schema.names.index(column)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
            yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                   offsets[start:stop + 1] - offsets[start])
            start = stop


def blocks(rows: DataFrame, column: str, limit: int) -> DataFrame:
    """(block, rows): the rows in arrays of about ``limit`` bytes of text. A block's number
    holds only where the table is written."""
    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for part, _, _ in slices(batches, column, limit):
            whole = pa.StructArray.from_arrays(part.columns, names=part.schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), whole)], names=["block", "rows"])
            block += 1

    return rows.mapInArrow(run, f"block long, rows array<{rows.schema.simpleString()}>")


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of bytes that are no separators;
    no run crosses a row."""
    gap = separators[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = gap[1:] != gap[:-1] if len(data) else False
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = ~gap[starts] if len(data) else np.zeros(len(starts), dtype=bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """A list column from values whose rows ascend."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the parts between line feeds; a text has one at least."""
    feed = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feed, side="right") - 1])
    starts = np.concatenate([offsets[:-1], feed + 1])
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    ends = offsets[row + 1].copy()
    same = np.flatnonzero(row[1:] == row[:-1])
    ends[same] = starts[same + 1] - 1
    return starts, ends, row


def stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without separators at both ends; empty ones become (start, start)."""
    solid = np.append(np.flatnonzero(~SPACES[data]), np.iinfo(np.int64).max)
    first, last = solid[np.searchsorted(solid, starts)], np.searchsorted(solid, ends) - 1
    empty = first >= ends
    return np.where(empty, starts, first), np.where(empty, starts, solid[np.maximum(last, 0)] + 1)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position, and in all."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans one after the other, a space after each: (bytes, new starts, new ends)."""
    new_end = np.cumsum(ends - starts + 1) - 1
    new_start = new_end - (ends - starts)
    out = np.full(int(new_end[-1]) + 1 if len(starts) else 0, 32, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[new_end] = False
    mask = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(mask, starts, 1)
    np.add.at(mask, ends, -1)
    out[inside] = data[np.cumsum(mask[:-1]).astype(bool)]
    return out, new_start, new_end
