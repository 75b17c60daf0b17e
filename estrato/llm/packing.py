"""Vector bin packing of tokenised documents into training sequences.

A piece of a document is a vector: its tokens, one segment, and its
loss-bearing tokens. A sequence has a limit on each. Sequences are filled one
after the other; the next piece is the one with the largest dot product of its
vector and what the sequence has left, weighted by the demand for each
dimension (Panigrahy et al., "Heuristics for vector bin packing"). When nothing
fits whole, a piece is cut to fill the rest, so a sequence ends short only by
the segment or loss limit or at the end of a task. Such a rest is cut into
sequences whose lengths are powers of two, which need no padding.

Every task packs the documents of its own partition from pools of a fixed
number of tokens, so there is no shuffle and memory is bounded by the pool and
the longest document. Unfinished pieces pass on to the task's next pool.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from estrato.llm import textbytes

#: Id that closes each document.
END_ID = 1
POOL_TOKENS = 1 << 21
#: Texts of these characters alone are cut alike by both tokenizer libraries
#: (tests/llm/test_packing.py); others and those that name a special token go
#: to ``tokenizers`` itself.
PLAIN = re.compile("[\t\n\r -~\xa1-ɏ‐-‧‰-⁞₠-₿]*")

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
          "sequence_id long, segment long, offset long")


@lru_cache(maxsize=4)
def encoder(path: str, ranks: str | None):
    """A function from text to its ids (uint32) by the file's tokenizer.

    ``ranks`` names the same vocabulary in the rank format, with which ordinary
    texts are encoded several times as fast to the same ids.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)

    def by_file(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if ranks is None:
        return by_file
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and "<|" not in text:
            return np.array(fast.encode_ordinary(text), dtype=np.uint32)
        return by_file(text)

    return encode


class Piece:
    """What is left of a document: ids from ``start`` on."""

    __slots__ = ("doc_id", "ids", "start", "free")

    def __init__(self, doc_id, ids: np.ndarray, free: int):
        self.doc_id, self.ids, self.start, self.free = doc_id, ids, 0, free

    def left(self) -> int:
        return len(self.ids) - self.start

    def loss(self, length: int) -> int:
        """Loss-bearing ids among the next ``length``; the first ``free`` of a document bear none."""
        return max(0, self.start + length - max(self.start, self.free))

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest part from here within both limits."""
        return min(self.left(), tokens, max(0, self.free - self.start) + loss)


def fill(pool: list[Piece], limits: tuple[int, int, int], last: bool) -> Iterator[list[tuple[Piece, int, int]]]:
    """Sequences as lists of (piece, start, length). Unless ``last``, stops when
    what is left no longer fills a sequence; ``pool`` then holds it."""
    tokens, segments, loss = limits
    for p in pool:  # long documents fill sequences of their own
        while p.left() > tokens and p.fitting(tokens, loss) == tokens:
            yield [(p, p.start, tokens)]
            p.start += tokens
    size = np.array([p.left() for p in pool], dtype=np.int64)
    cost = np.array([p.loss(p.left()) for p in pool], dtype=np.int64)
    alive = size > 0
    total = int(size.sum())
    caps = np.array([tokens, segments, loss], dtype=np.float64)
    while total and (last or total >= tokens):
        demand = np.array([total, alive.sum(), cost[alive].sum()], dtype=np.float64)
        weight = demand / demand.sum() / caps ** 2
        room = [tokens, segments, loss]
        chosen: list[tuple[Piece, int, int]] = []
        while room[0] and room[1] and total:
            fits = alive & (size <= room[0]) & (cost <= room[2])
            if fits.any():
                score = size * (weight[0] * room[0]) + cost * (weight[2] * room[2]) + weight[1] * room[1]
                k = int(np.argmax(np.where(fits, score, -1.0)))
                n = int(size[k])
            else:
                k = int(np.argmax(np.where(alive, size, -1)))
                n = pool[k].fitting(room[0], room[2])
                if not n:
                    break
            p = pool[k]
            chosen.append((p, p.start, n))
            room[0] -= n
            room[1] -= 1
            room[2] -= p.loss(n)
            p.start += n
            total -= n
            size[k], cost[k] = p.left(), p.loss(p.left())
            alive[k] = size[k] > 0
        yield from [chosen] if not room[0] else halves(chosen, tokens)
    pool[:] = [p for p in pool if p.left()]


def halves(chosen: list[tuple[Piece, int, int]], tokens: int) -> Iterator[list[tuple[Piece, int, int]]]:
    """A short sequence cut into ones whose lengths are powers of two."""
    n = sum(x[2] for x in chosen)
    chosen = chosen[::-1]
    while n:
        want = 1 << (n.bit_length() - 1)
        n -= want
        part = []
        while want:
            p, start, length = chosen.pop()
            part.append((p, start, min(length, want)))
            if length > want:
                chosen.append((p, start + want, length - want))
            want -= part[-1][2]
        yield part


def pack(docs: DataFrame, tokenizer: str, *, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         free_col: str | None = None, max_tokens: int = 2048, max_segments: int = 256, max_loss: int = 2048,
         pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (unsigned little-endian
    32-bit), ``doc_tokens, loss_tokens, sequence_id, segment, offset``.

    ``free_col`` counts the leading ids of a document that bear no loss (the
    prompt of instruction data); NULL, or no such column, means one, the id
    without context. NULL and empty texts are the closing id alone. Rows with a
    NULL or repeated id are packed like any other. An empty table gives no rows.
    Other columns of the input are ignored, whatever their names.
    """
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("every limit must be at least 1")
    limits = (max_tokens, max_segments, max_loss)
    free = F.col(f"`{free_col}`").cast("long") if free_col else F.lit(1).cast("long")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.greatest(F.coalesce(free, F.lit(1)), F.lit(1)).cast("long").alias("free"))

    def run(batches):
        encode = encoder(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 40
        pool: list[Piece] = []
        held = 0

        def emit(last: bool):
            nonlocal sequence
            rows: list[tuple] = []
            weight = 0
            for chosen in fill(pool, limits, last):
                offset = 0
                for segment, (p, start, n) in enumerate(chosen):
                    before = p.start
                    p.start = start
                    rows.append((p.doc_id, start, n, p.ids[start:start + n].tobytes(), len(p.ids), p.loss(n),
                                 sequence, segment, offset))
                    p.start = before
                    offset += n
                sequence += 1
                weight += offset
                if weight >= 1 << 20:
                    yield rows_batch(rows)
                    rows, weight = [], 0
            if rows:
                yield rows_batch(rows)

        for part, _, _ in textbytes.slices(batches):
            for doc_id, text, free_ids in zip(*(part.column(i).to_pylist() for i in range(3))):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                pool.append(Piece(doc_id, ids, free_ids))
                held += len(ids)
                if held >= pool_tokens:
                    yield from emit(False)
                    held = sum(p.left() for p in pool)
        yield from emit(True)

    return source.mapInArrow(run, SCHEMA)


_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("segment", pa.int64()), ("offset", pa.int64())])


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
