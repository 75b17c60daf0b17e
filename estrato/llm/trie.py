"""The prefix trie of conversations, from their sorted order.

Conversations are sorted as sequences of turn digests over the whole cluster. The
number of turns that two sorted neighbours share is an edge between them. A union-find
takes the edges from the deepest to the shallowest: each component is a subtree, known
by the depth of its top node, and an edge lifts the components at its ends to its own
depth, where they become one node. So every merge of components makes a branching node,
and lifting makes the nodes without branches above it.

A task does this for its part of the order. What its neighbours may share, the paths of
its first and of its last conversation, cannot be finished there: subtrees beside these
paths are finished and contracted to one entry for each depth they hang from. Contracted
forests of neighbouring parts are merged by the same union-find, block by block, until
one is left. The entries of a part are no more than the turns of two conversations.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from estrato.session import materialise

#: Bytes of a turn's digest.
TURN = 16
#: Contracted forests merged by one task.
FAN = 64
NODES = ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "key", "open"]
NODE_TYPES = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 4 + [pa.string(), pa.bool_()]
NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, parent_key string, n_convs long, n_children long, "
               "n_leaves long, saved_tokens long, key string, open boolean")
#: An entry of a contracted forest: its depth, members, finished children and leaves, tokens saved
#: below, smallest member, whether members end there, and whether it lies on the last path; and the
#: turns it shares with the next entry.
ENTRY = ["depth", "n", "kids", "leaves", "saved", "low", "ends", "side"]


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // TURN


def keys(path: bytes, depths) -> dict[int, str]:
    """The key of the node at each depth of a path."""
    out, digest, at = {}, hashlib.md5(), 0
    for depth in sorted(set(depths)):
        digest.update(path[at * TURN:depth * TURN])
        at, out[depth] = depth, digest.copy().hexdigest()
    return out


class Forest:
    """Subtrees in sorted order; ``paths[path[i]]`` is a (sequence, words of its turns) that
    runs through subtree i. The first and the last of an unfinished forest stay as deep as they are."""

    def __init__(self, paths, path, entries: dict[str, list[int]], edges: list[int]):
        self.paths, self.path, self.edges = paths, path, edges
        self.depth, self.n, self.kids, self.leaves, self.saved, self.low, self.ends = (list(entries[c]) for c in ENTRY[:7])
        self.known = [False] * len(path)  # was an entry of a contracted forest before
        self.pending: list[list[int]] = [[] for _ in path]
        self.nodes: dict[str, list] = {c: [] for c in NODES}

    def lift(self, i: int, to: int) -> None:
        """Finish the nodes of subtree i that are deeper than ``to``."""
        depth = self.depth[i]
        if depth <= to:
            return
        nodes, n, low = self.nodes, self.n[i], self.low[i]
        path, words = self.paths[self.path[i]]
        for child in self.pending[i]:
            nodes["parent_conv_id"][child] = low
        self.leaves[i] = self.leaves[i] if self.kids[i] else 1
        for d in range(depth, to, -1):
            top = d == depth
            self.saved[i] += (n - 1) * words[d - 1] if d else 0
            key = hashlib.md5(path[:d * TURN]).hexdigest() if top and (self.ends[i] or self.known[i]) else None
            row = (low, d, low if d > to + 1 else None, None, n, self.kids[i] if top else 1, self.leaves[i], self.saved[i], key, top and self.known[i])
            for c, v in zip(NODES, row):
                nodes[c].append(v)
        self.pending[i] = [len(nodes["depth"]) - 1]
        self.kids[i], self.ends[i], self.known[i], self.depth[i] = 1, 0, False, to

    def merge(self, finish: bool) -> dict[str, list]:
        """Take all edges; what is left is the contracted forest, empty when finished."""
        k = len(self.path)
        up, held, side = list(range(k)), [False] * k, [0] * k
        if not finish:
            held[0] = held[-1] = True
            side[-1] = 1 if k > 1 else 0

        def find(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for e in sorted(range(k - 1), key=lambda e: -self.edges[e]):
            to, a, b = self.edges[e], find(e), find(e + 1)
            for i in (a, b):
                if not held[i]:
                    self.lift(i, to)
            if self.depth[a] == self.depth[b] == to:
                for field in (self.n, self.kids, self.leaves, self.saved):
                    field[a] += field[b]
                self.low[a], self.ends[a], self.known[a] = min(self.low[a], self.low[b]), self.ends[a] | self.ends[b], self.known[a] or self.known[b]
                few, many = sorted((self.pending[a], self.pending[b]), key=len)
                many.extend(few)
                self.pending[a], self.pending[b] = many, []
                if held[b] and not held[a]:
                    side[a], self.path[a] = side[b], self.path[b]
                held[a], up[b] = held[a] or held[b], a
            elif self.depth[a] == to:  # a hangs from the unfinished path through b
                held[a], side[a], self.path[a] = True, side[b], self.path[b]
            elif self.depth[b] == to:
                held[b], side[b], self.path[b] = True, side[a], self.path[a]
        roots = [i for i in range(k) if up[i] == i]
        if finish:
            for i in roots:
                self.lift(i, -1)
            return {c: [] for c in [*ENTRY, "edges"]}
        for s, end in ((0, roots[0]), (1, roots[-1])):  # the deepest entries of the two paths
            own = [i for i in roots if side[i] == s and self.pending[i]]
            key = keys(self.paths[self.path[end]][0], [self.depth[i] for i in own])
            for i in own:
                for child in self.pending[i]:
                    self.nodes["parent_key"][child] = key[self.depth[i]]
        out = {c: [getattr(self, c)[i] for i in roots] for c in ENTRY[:7]}
        out["side"] = [side[i] for i in roots]
        out["edges"] = [self.edges[b - 1] for b in roots[1:]]
        return out


def of_rows(ids, sequences, words):
    """The forest of sorted conversations."""
    n = len(ids)
    entries = {"depth": [len(s) // TURN for s in sequences], "n": [1] * n, "kids": [0] * n, "leaves": [0] * n, "saved": [0] * n, "low": ids, "ends": [1] * n}
    return Forest(list(zip(sequences, words)), list(range(n)), entries, [shared_turns(a, b) for a, b in zip(sequences, sequences[1:])])


def of_parts(parts: list[dict]) -> Forest:
    """The forest of neighbouring contracted ones."""
    paths, path, edges, entries = [], [], [], {c: [] for c in ENTRY}
    for k, p in enumerate(parts):
        if k:
            edges.append(shared_turns(parts[k - 1]["last"], p["first"]))
        paths += [(p["first"], p["first_words"]), (p["last"], p["last_words"])]
        path += [2 * k + s for s in p["side"]]
        edges += p["edges"]
        for c in ENTRY:
            entries[c] += p[c]
    out = Forest(paths, path, entries, edges)
    out.known = [True] * len(path)
    return out


def contracted(parts: list[dict]) -> tuple[dict, dict]:
    """(contracted forest, finished nodes) of neighbouring contracted forests."""
    forest = of_parts(parts)
    left = forest.merge(False)
    return left | {c: parts[0][c] for c in ("part", "first", "first_words")} | {c: parts[-1][c] for c in ("last", "last_words")}, forest.nodes


def digests(ids: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): a key's ids in order, comma-joined. They pass
    through a hash as a sorted stream, so a key may have any number of them."""
    def run(batches):
        last, digest = None, None
        for batch in batches:
            key, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            done, a = [], 0
            for b in range(1, len(key) + 1):
                if b == len(key) or key[b] != key[a]:
                    if key[a] != last:
                        if last is not None:
                            done.append((last, digest.hexdigest()))
                        last, digest, before = key[a], hashlib.sha256(), b""
                    else:
                        before = b","
                    digest.update(before + ",".join(map(str, conv[a:b])).encode())
                    a = b
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], names=["key", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    return ids.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key string, ends_sha256 string")


def forest(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie, one row each, from (conv_id long, seq binary, words
    array<long>): 16 bytes and a number of words for each turn; ids are distinct.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, the digest of the sorted ids of the members without
    further turns. No sequences: no nodes.
    """
    arrow = pa.schema([(c, t) for c, t in zip(NODES, NODE_TYPES)])
    lists = ["first_words", "last_words", "edges", *ENTRY]
    blob = pa.struct([("part", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), *[(c, pa.list_(pa.int64())) for c in lists]])
    schema = f"{NODE_SCHEMA}, forest struct<{', '.join(f'{f.name}: ' + ('long' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'array<long>') for f in blob)}>"

    def rows(nodes, left):
        n = len(nodes["depth"])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(nodes[c], t) for c, t in zip(NODES, NODE_TYPES)] + [pa.nulls(n, blob)], names=[*NODES, "forest"])
        if left:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, t) for t in NODE_TYPES] + [pa.array([left], blob)], names=[*NODES, "forest"])

    def cut(batches):
        part, state = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, seq, words = (batch.column(k).to_pylist() for k in range(3))
            own = of_rows(ids, seq, words)
            left = own.merge(False) | {"part": part, "first": seq[0], "last": seq[-1], "first_words": words[0], "last_words": words[-1]}
            yield from rows(own.nodes, None)
            if state is not None:
                left, nodes = contracted([state, left])
                yield from rows(nodes, None)
            state = left
        if state is not None:
            yield from rows({"depth": []}, state)

    ordered = sequences.select("conv_id", "seq", "words").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    made = materialise(ordered.mapInArrow(cut, schema), "trie-parts")
    nodes = made.where("forest is null").select(*NODES)
    parts = made.where("forest is not null").select("forest.*")
    groups = parts.agg(F.max("part")).first()[0]
    while groups is not None:
        groups //= FAN
        last = groups == 0

        def join(table: pa.Table) -> pa.Table:
            own = sorted(table.drop_columns(["block"]).to_pylist(), key=lambda p: p["part"])
            if last:
                whole = of_parts(own)
                whole.merge(True)
                out = list(rows(whole.nodes, None))
            else:
                left, done = contracted(own)
                out = list(rows(done, left | {"part": own[0]["part"] // FAN}))
            return pa.Table.from_batches(out, arrow.append(pa.field("forest", blob)))

        made = materialise(parts.withColumn("block", F.expr(f"part div {FAN}")).groupBy("block").applyInArrow(join, schema), "trie-merged")
        nodes = nodes.union(made.where("forest is null").select(*NODES))
        parts = made.where("forest is not null").select("forest.*")
        if last:
            break
    # The smallest member of an unfinished node was not known where its finished children were.
    above = nodes.where("open").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    below = nodes.where("parent_key is not null").drop("parent_conv_id").join(above, "parent_key").withColumnRenamed("above", "parent_conv_id")
    nodes = nodes.where("parent_key is null").unionByName(below)
    ends = digests(sequences.select(F.md5("seq").alias("key"), "conv_id"))
    ended = nodes.where("key is not null").join(ends, "key", "left")
    nodes = ended.unionByName(nodes.where("key is null").withColumn("ends_sha256", F.lit(None).cast("string")))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def sequenced(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order as (digest in hex, words).

    Turns of one number (NULL comes first) are ordered by role, then text; equal rows are
    turns of their own. NULL roles and texts are empty; rows without a conv_id belong to
    no conversation and are left out. Texts are only gathered of conversations that have
    different turns of one number.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.where("conv_id is not null").withColumns({
        "digest": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")),
        "words": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")})
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns"))
    first, second = F.slice("turns", F.lit(1), F.size("turns") - 1), F.slice("turns", F.lit(2), F.size("turns") - 1)
    tied = F.exists(F.arrays_zip(first.alias("a"), second.alias("b")), lambda x: x["a"]["turn"].eqNullSafe(x["b"]["turn"]) & (x["a"]["digest"] != x["b"]["digest"]))
    listed = materialise(listed.withColumn("tied", tied), "conversations")
    plain = F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")
    ordered = listed.where(~F.col("tied")).select("conv_id", plain)
    if listed.where("tied").isEmpty():
        return ordered
    again = rows.join(listed.where("tied").select("conv_id"), "conv_id", "left_semi")
    again = again.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "digest", "words"))).alias("turns"))
    return materialise(ordered.union(again.select("conv_id", plain)), "conversations-ordered")


def rebuilt(listed: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, seq, words): each conversation c with its first h turns taken from
    conversation c - c % ``group``, h = crc32(c in decimal) % ``most``; none if that is absent."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = listed.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    none = F.array().cast(dict(listed.dtypes)["turns"])
    whole = listed.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    whole = whole.select("conv_id", F.concat(head, tail).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))
