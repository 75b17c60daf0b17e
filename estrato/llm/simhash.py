"""SimHash fingerprints and their self-join over a binary trie.

The distinct fingerprints form a binary trie. A join walks pairs of its nodes
together, adds up the bits in which their paths differ and leaves a pair as soon
as they exceed the error budget. Spark gets the top of the walk: every pair of
nodes at one depth that is still within the budget is a group of its own. Bits
are taken in order of balance, so that the nodes at that depth are of like size.
Equal texts have equal fingerprints, so groups of copies are one trie leaf.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from estrato.llm import textbytes
from estrato.llm.components import Forest, components
from estrato.session import materialise

SEED = 42
#: Distinct fingerprints below a trie node that is a task's share, on average.
CELL = 1 << 14
#: Node pairs held at once while a task walks its part.
FRONTIER = 1 << 19


def hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the word shingles of lower-cased texts, repeats included."""
    import xxhash

    starts, ends, row = textbytes.words(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.uint64), row
    size = ends - starts + 1  # with one space after it
    new_end = np.cumsum(size) - 1
    new_start = new_end - size + 1
    spaced = np.full(int(new_end[-1]) + 1, 32, dtype=np.uint8)
    inside = np.ones(len(spaced), dtype=bool)
    inside[new_end] = False
    mask = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(mask, starts, 1)
    np.add.at(mask, ends, -1)
    spaced[inside] = data[np.cumsum(mask[:-1]).astype(bool)]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    count = np.diff(np.r_[first, n])
    begin = np.ones(n, dtype=bool)  # words at which a shingle starts
    for k in range(1, width):
        ends_at = first + count - k
        begin[ends_at[ends_at > first]] = False
    begin = np.flatnonzero(begin)
    last = np.repeat(first + count - 1, count)[begin]
    stop = new_end[np.minimum(begin + width - 1, last)]
    joined = spaced.tobytes()
    digest = xxhash.xxh64_intdigest
    out = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(new_start[begin].tolist(), stop.tolist())),
                      dtype=np.uint64, count=len(begin))
    return out, row[begin]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp long): a bit is 1 if it is set in over half of the shingle hashes
    (XXH64, seed 42); a text without words, empty or NULL has 0."""
    if width < 1:
        raise ValueError("shingles have one word at least")

    def run(batches):
        for part, data, offsets in textbytes.slices(batches):
            h, row = hashes(textbytes.lower(data), offsets, width)
            fp = np.zeros(part.num_rows, dtype=np.uint64)
            if len(h):
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                total = np.diff(np.r_[first, len(row)])
                bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
                set_ = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
                fp[row[first]] = np.ascontiguousarray(set_).view("<u8")[:, 0]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        run, f"id {dict(docs.select(f'`{id_col}`').dtypes)[id_col]}, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def walk(left: np.ndarray, right: np.ndarray, same: bool, depth: int, spent: int, budget: int):
    """Blocks of index pairs (i in left, j in right) within the budget.

    Both arrays are sorted and distinct; all of one share their first ``depth``
    bits, which differ in ``spent`` places. ``same``: both are one array, and a
    pair is met once.
    """
    whole = np.array([[0, len(left), 0, len(right), spent]], dtype=np.int64)
    stack = [(depth, whole)] if len(left) and len(right) else []
    while stack:
        bit, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(bit, pairs[:half]), (bit, pairs[half:])]
            continue
        a0, a1, b0, b1, err = pairs.T
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = distance(left[i], right[j]) <= budget
            if same:
                near &= i != j
            yield i[near], j[near]
            pairs = pairs[~leaf]
        if not len(pairs) or bit == 64:
            continue
        a0, a1, b0, b1, err = pairs.T
        high, ones = np.uint64(1 << (63 - bit)), np.uint64(((1 << bit) - 1) << (64 - bit))
        am = np.clip(np.searchsorted(left, (left[a0] & ones) | high), a0, a1)
        bm = np.clip(np.searchsorted(right, (right[b0] & ones) | high), b0, b1)
        twin = (a0 == b0) & (a1 == b1) if same else np.zeros(len(pairs), dtype=bool)
        children = [np.column_stack([a0, am, b0, bm, err]), np.column_stack([am, a1, bm, b1, err]),
                    np.column_stack([a0, am, bm, b1, err + 1]), np.column_stack([am, a1, b0, bm, err + 1])[~twin]]
        pairs = np.concatenate(children)
        stack.append((bit + 1, pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (pairs[:, 4] <= budget)]))


def permute(fp: np.ndarray, order: list[int]) -> np.ndarray:
    """Bit ``order[k]`` becomes the k-th highest bit; distances stay."""
    out = np.zeros(len(fp), dtype=np.uint64)
    for k, bit in enumerate(order):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(63 - k)
    return out


def links(fps: DataFrame, budget: int) -> DataFrame:
    """(a, b): of each task's part of the trie the links that connect what is
    connected there, at most one a fingerprint. ``fps``: distinct (fp long)."""
    counts = fps.agg(F.count("*").alias("n"), *[F.sum(F.shiftright("fp", k).bitwiseAND(1)).alias(f"b{k}") for k in range(64)]).first()
    n = counts["n"]
    order = sorted(range(64), key=lambda k: abs(2 * (counts[f"b{k}"] or 0) - n))
    depth = min(16, max(4, int(np.ceil(np.log2(max(n, 1) / CELL)))))
    flips = np.array([x for x in range(1 << depth) if x.bit_count() <= budget], dtype=np.uint64)

    def deal(batches):
        """The fingerprints of a batch below each node, once for every pair of nodes, as one array."""
        for batch in batches:
            fp = np.sort(permute(batch.column(0).to_numpy().view(np.uint64), order))
            node = fp >> np.uint64(64 - depth)
            own = np.unique(node)
            cut = np.r_[np.searchsorted(node, own), len(fp)]
            for flip in flips:
                other = own ^ flip
                cell = ((np.minimum(own, other) << np.uint64(16)) | np.maximum(own, other)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(own > other), pa.array([fp[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["cell", "upper", "fps"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        cell = int(frame["cell"].iloc[0])
        same = cell >> 16 == cell & 0xFFFF
        parts = [np.frombuffer(x, dtype=np.uint64) for x in frame["fps"]]
        key, upper = np.concatenate(parts), np.repeat(frame["upper"].to_numpy(), [len(x) for x in parts])
        rank = np.argsort(key)
        key, upper = key[rank], upper[rank]
        left = np.flatnonzero(~upper)
        right = left if same else np.flatnonzero(upper)
        forest = Forest(len(key))
        for i, j in walk(key[left], key[right], same, depth, (cell >> 16 ^ cell & 0xFFFF).bit_count(), budget):
            forest.add(left[i], right[j])
        moved = np.flatnonzero(forest.label != np.arange(len(key)))
        fp = permute(key, [63 - order.index(63 - k) for k in range(64)])
        return pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[forest.label[moved]].view(np.int64)})

    return fps.mapInArrow(deal, "cell long, upper boolean, fps binary").groupBy("cell").applyInPandas(join, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, budget: int = 2) -> DataFrame:
    """One row per input row: (id, fp long, component_id): the smallest id reachable
    over fingerprints that differ in ``budget`` bits at most.

    NULL and empty texts have fingerprint 0 and link like any other. Rows with a
    NULL id get their group's smallest id, or NULL if it has none. Equal rows
    give equal rows; an empty table gives none. Other columns are ignored.
    """
    found = materialise(fingerprints(docs, id_col, text_col, width), "simhash")
    reps = materialise(found.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    joined = components(links(reps.select("fp"), budget), "simhash")
    group = reps.join(joined, reps["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group"))
    least = group.groupBy("group").agg(F.min("first").alias("component_id"))
    return found.join(group.join(least, "group").select("fp", "component_id"), "fp").select("id", "fp", "component_id")
