"""Near-duplicate vectors by a robust-pruned graph.

Equal vectors of one label become one representative. Representatives are dealt
to overlapping cluster shards of bounded size. Each shard builds a flat graph:
every vector keeps those of its nearest and some random vectors that no kept one
is much closer to (robust pruning, Subramanya et al., "DiskANN"). The adjacency
lists of all shards are united per vector. Then every shard searches for each of
its vectors in the united graph: greedily from the shard's medoids and the
vector itself, then outwards through everything within a little more than the
range. Links are verified in double precision and counted in one of the shards
that hold both ends: only counts leave a task, and a spanning forest of the links
for the components. Where a vector met in reach has adjacency lists from clusters
that the searching one is not in, the search goes on outside the shard: (query,
vector) pairs are a table, joined with those lists and verified in rounds until
nothing new is in reach, so vectors that share no shard are linked too. An audit compares the links of a bounded
sample with brute force over all vectors, vector by vector and dense ones apart from
sparse ones; below its target the work is repeated with more overlap and wider
search, and labels that are still below it are compared exactly, pair by pair in
blocks.

A cluster too dense to cut, such as thousands of near copies, is cut into parts
by hash, and each pair of parts is a shard. That costs as many comparisons as
the links that it has to count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from estrato.llm.components import Forest, components
from estrato.llm.textbytes import mix
from estrato.session import materialise

#: Vectors of a label that is not cut (of a cluster: twice as many), and of each part of a shard.
CELL, PART = 512, 512
#: Clusters that a vector is dealt to, children of one at most on average, and levels.
OVERLAP, CHILDREN, LEVELS = 3, 256, 5
#: Centres nearer than this to one already chosen are left out, so that a cluster of copies is not cut.
CENTRE_COSINE = 0.6
DEGREE, NEAREST, RANDOM, ALPHA = 24, 48, 8, 1.2
#: Starts of a search besides the vector itself, its beam, and how far below the range it goes on.
MEDOIDS, BEAM, SLACK = 8, 16, 0.03
#: Vectors whose links are checked by brute force, at most.
AUDIT_QUERIES, AUDIT_TARGET, ROUNDS = 512, 0.98, 3
#: Vectors with more links than this are audited apart from the others.
DENSE = NEAREST


def unit(raw) -> np.ndarray:
    x = np.stack([np.frombuffer(r, dtype="<f8") for r in raw]) if len(raw) else np.zeros((0, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def child(cell: np.ndarray | int, k: np.ndarray) -> np.ndarray:
    return mix(np.asarray(cell, dtype=np.int64).view(np.uint64) + (k.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def split(members: DataFrame, overlap: int) -> DataFrame:
    """(cell, rep, vec) dealt to clusters of about CELL vectors where that is possible."""
    done = None
    for level in range(LEVELS):
        members, top = materialise(members, "vector-cells"), level == 0
        sizes = members.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > (2 * CELL if level else CELL))
        if sizes.isEmpty():
            break
        marked = members.join(sizes, "cell", "left")
        still = marked.where("size is null").select("cell", "rep", "vec")
        done = still if done is None else done.union(still)
        large = marked.where("size is not null")
        share = F.least(F.ceil(F.col("size") / (CELL / 4)), F.lit(CHILDREN)) / F.col("size")
        lot = F.pmod(F.xxhash64("rep", "cell"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        salts = F.ceil(F.col("size") / F.lit(16384))
        centres = (large.where(lot < share).groupBy("cell", "size").agg(F.collect_list("vec").alias("centres"))
                   .select(F.col("cell").alias("of"), F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias("lot"), "centres"))

        def assign(own: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
            if not len(own):
                return pd.DataFrame({"cell": [], "rep": [], "vec": [], "final": []})
            cell = int(own["cell"].iloc[0])
            chosen = np.zeros((0, 1))
            for c in unit(sorted(centre["centres"].iloc[0])) if len(centre) else ():
                if not len(chosen) or (chosen @ c).max() < CENTRE_COSINE:
                    chosen = np.vstack([chosen, c]) if len(chosen) else c[None]
            whole = len(chosen) < 2
            if not whole and not top:
                # A dense cluster keeps together, and would be dealt again and again: it stays whole.
                sample = unit(centre["centres"].iloc[0])
                whole = np.bincount((sample @ chosen.T).argmax(axis=1)).max() > len(sample) / 2
            if whole:
                return pd.DataFrame({"cell": cell, "rep": own["rep"], "vec": own["vec"], "final": True})
            near = np.argsort(-(unit(own["vec"].tolist()) @ chosen.T), axis=1, kind="stable")[:, :overlap]
            return pd.DataFrame({"cell": child(cell, near.ravel()), "rep": np.repeat(own["rep"].to_numpy(), near.shape[1]),
                                 "vec": np.repeat(own["vec"].to_numpy(), near.shape[1]), "final": False})

        dealt = large.withColumn("salt", F.pmod(F.xxhash64("rep"), salts).cast("int")).groupBy("cell", "salt").cogroup(
            centres.groupBy("of", "lot")).applyInPandas(assign, "cell long, rep long, vec binary, final boolean")
        dealt = materialise(dealt, "vector-dealt")
        done = done.union(dealt.where("final").drop("final"))
        members = dealt.where("not final").drop("final").distinct()
    return members if done is None else done.union(members)


def shards(members: DataFrame) -> DataFrame:
    """(shard, cell, rep, vec, shards, cells): clusters, or pairs of parts of one that stayed large."""
    members = materialise(members, "vector-members")
    sizes = members.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.when(F.col("size") > 2 * CELL, F.ceil(F.col("size") / F.lit(PART))).otherwise(F.lit(1)).cast("int")
    dealt = members.join(sizes, "cell").select("cell", "rep", "vec", parts.alias("parts"))
    own = F.pmod(F.xxhash64("rep", "cell"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("own", own).select("cell", "rep", "vec", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "cell", "rep", "vec")
    dealt = materialise(dealt, "vector-shards")
    return dealt.join(dealt.groupBy("rep").agg(F.collect_set("shard").alias("shards"), F.collect_set("cell").alias("cells")), "rep")


def pruned(x: np.ndarray, seed: int, degree: int) -> np.ndarray:
    """Adjacency of a flat graph over unit vectors: neighbours by row, -1 for none."""
    n = len(x)
    r = np.random.default_rng(seed & 0x7FFFFFFF)
    out = np.full((n, degree + RANDOM), -1, dtype=np.int64)
    if n < 2:
        return out
    near_n = min(NEAREST, n - 1)
    for lo in range(0, n, 256):
        rows = np.arange(lo, min(n, lo + 256))
        cos = x[rows] @ x.T
        cos[np.arange(len(rows)), rows] = -2
        pool = np.argpartition(-cos, near_n - 1, axis=1)[:, :near_n]
        away = 2 - 2 * np.take_along_axis(cos, pool, 1)
        order = np.argsort(away, axis=1, kind="stable")
        pool, away = np.take_along_axis(pool, order, 1), np.take_along_axis(away, order, 1)
        between = 2 - 2 * np.einsum("bcd,bed->bce", x[pool], x[pool])
        live = np.ones(pool.shape, dtype=bool)
        at = np.arange(len(rows))
        for k in range(min(degree, near_n)):
            first = live.argmax(axis=1)
            some = live[at, first]
            out[rows[some], k] = pool[at[some], first[some]]
            live[at, first] = False
            live &= ~(some[:, None] & (ALPHA ** 2 * between[at, first] <= away))
        out[rows, degree:] = r.integers(0, n, (len(rows), RANDOM))
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The vector nearest the mean, then each time the one farthest from those chosen."""
    first = int(np.argmax(x @ x.mean(axis=0)))
    chosen, near = [first], x @ x[first]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    return np.array(chosen)


def search(x: np.ndarray, adjacent: np.ndarray, at_least: float, beam: int, reach: list | None = None):
    """Blocks of index pairs (query, other) with cosine ``at_least``; every vector is a query.
    ``reach`` gets the pairs of each block that the search went on from."""
    n = len(x)
    starts = medoids(x, MEDOIDS)
    for lo in range(0, n, 512):
        q = np.arange(lo, min(n, lo + 512))
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n), dtype=bool)
        opened = np.zeros((len(q), n), dtype=bool)
        score = np.full((len(q), n), -2.0)

        def visit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Scores the pairs not seen yet and returns them."""
            pair = np.unique(a * n + b)
            pair = pair[~seen.ravel()[pair]]
            a, b = pair // n, pair % n
            seen[a, b] = True
            for k in range(0, len(a), 1 << 16):
                score[a[k:k + (1 << 16)], b[k:k + (1 << 16)]] = np.einsum("ij,ij->i", x[q[a[k:k + (1 << 16)]]], x[b[k:k + (1 << 16)]])
            return a, b

        def neighbours(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            opened[a, b] = True
            to = adjacent[b]
            ok = to >= 0
            return np.repeat(a, ok.sum(axis=1)), to[ok]

        visit(np.repeat(rows, len(starts)), np.tile(starts, len(q)))
        visit(rows, q)
        for _ in range(beam):  # greedy: the best not opened, of the best seen
            best = np.where(opened, -3.0, score)
            to = best.argmax(axis=1)
            rank = (score > best[rows, to][:, None]).sum(axis=1)
            go = (best[rows, to] > -2) & (rank < beam)
            if not go.any():
                break
            visit(*neighbours(rows[go], to[go]))
        a, b = np.nonzero((score >= at_least - SLACK) & ~opened)
        while len(a):  # outwards while anything new is in reach
            found = [visit(*neighbours(a[k:k + 4096], b[k:k + 4096])) for k in range(0, len(a), 4096)]
            a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            near = score[a, b] >= at_least - SLACK
            a, b = a[near], b[near]
        if reach is not None:
            a, b = np.nonzero(score >= at_least - SLACK)
            reach.append((q[a], b))
        a, b = np.nonzero(score >= at_least)
        other = q[a] != b
        yield q[a[other]], b[other]


def every(x: np.ndarray, at_least: float):
    """Like ``search``, by comparing all pairs."""
    for lo in range(0, len(x), 512):
        a, b = np.nonzero(x[lo:lo + 512] @ x.T >= at_least - 1e-9)
        a += lo
        ok = (a != b) & (np.einsum("ij,ij->i", x[a], x[b]) >= at_least)
        yield a[ok], b[ok]


def linked(reps: DataFrame, at_least: float, overlap: int, widen: int, exact: bool = False) -> DataFrame:
    """(rep, n_links, n_reps, forest): counts of linked vectors from each shard, with
    copies and without. ``exact`` compares all pairs of a label in blocks."""
    whole = reps.select(F.xxhash64("label", F.octet_length("vec")).alias("cell"), "rep", "vec")
    dealt = materialise(shards(whole if exact else split(whole, overlap)), "vector-dealt")

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep")
        rep = frame["rep"].to_numpy()
        graph = np.zeros((len(rep), 0), dtype=np.int64) if exact else pruned(unit(frame["vec"].tolist()), int(frame["shard"].iloc[0]), DEGREE * widen)
        source, way = np.nonzero(graph >= 0)
        target = graph[source, way]
        near = way < DEGREE * widen  # these edges are walked both ways
        source, target = np.r_[source, target[near]], np.r_[target, source[near]]
        order = np.argsort(source, kind="stable")
        cut = np.searchsorted(source[order], np.arange(len(rep) + 1))
        return pd.DataFrame({"rep": rep, "cell": frame["cell"].to_numpy(), "to": [rep[target[order[a:b]]] for a, b in zip(cut, cut[1:])]})

    graph = dealt.select("shard", "cell", "rep", "vec").groupBy("shard").applyInPandas(build, "rep long, cell long, to array<long>")
    graph = materialise(graph, "vector-graph")
    united = graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
    ready = dealt.join(united, "rep").join(reps.select("rep", "copies"), "rep")

    def look(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep")
        rep, here = frame["rep"].to_numpy(), int(frame["shard"].iloc[0])
        place = {int(r): k for k, r in enumerate(rep)}
        known = [[place[t] for t in to.tolist() if t in place] for to in frame["to"]]
        adjacent = np.full((len(rep), max(1, max(map(len, known)))), -1, dtype=np.int64)
        for k, to in enumerate(known):
            adjacent[k, :len(to)] = to
        alone = np.array([len(s) == 1 for s in frame["shards"]])
        holds = [set(map(int, s)) for s in frame["shards"]]
        cells = [frozenset(map(int, c)) for c in frame["cells"]]
        kind = {c: k for k, c in enumerate(dict.fromkeys(cells))}
        kinds = np.array([kind[c] for c in cells])
        leads = np.array([[bool(b - a) for b in kind] for a in kind])  # out of the query's cells
        copies, forest = frame["copies"].to_numpy(), Forest(len(rep))
        n_links, n_reps = np.zeros(len(rep), dtype=np.int64), np.zeros(len(rep), dtype=np.int64)
        reach, out = [], [[np.zeros(0, dtype=np.int64)] * 2]
        x = unit(frame["vec"].tolist())
        for a, b in every(x, at_least) if exact else search(x, adjacent, at_least, BEAM * widen, reach):
            for near, by in reach:
                ahead = leads[kinds[near], kinds[by]]
                out.append([near[ahead], by[ahead]])
            reach.clear()
            forest.add(a, b)
            mine = alone[a] | alone[b]  # a link belongs to the smallest shard that has both ends
            rest = np.flatnonzero(~mine)
            mine[rest] = [min(holds[i] & holds[j]) == here for i, j in zip(a[rest].tolist(), b[rest].tolist())]
            np.add.at(n_links, a[mine], copies[b[mine]])
            np.add.at(n_reps, a[mine], 1)
        near, by = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(near, kind="stable")
        cut = np.searchsorted(near[order], np.arange(len(rep) + 1))
        return pd.DataFrame({"rep": rep, "n_links": n_links, "n_reps": n_reps, "forest": rep[forest.label],
                             "ahead": [rep[by[order[a:b]]] for a, b in zip(cut, cut[1:])]})

    found = materialise(ready.groupBy("shard").applyInPandas(look, "rep long, n_links long, n_reps long, forest long, ahead array<long>"), "vector-found")
    if exact:
        return found.drop("ahead")
    places = materialise(dealt.select("rep", "cells").distinct().join(reps.select("rep", "vec", "copies"), "rep"), "vector-places")
    frontier = found.select(F.col("rep").alias("q"), F.explode("ahead").alias("by")).distinct()
    return found.drop("ahead").union(crossed(frontier, graph, places, at_least))


def crossed(frontier: DataFrame, graph: DataFrame, places: DataFrame, at_least: float) -> DataFrame:
    """(rep, n_links, n_reps, forest) of the links between vectors that share no cell, found
    from ``frontier`` (q, by): the adjacency lists of ``by`` from cells without ``q``
    lead to new vectors, and those in reach lead on."""
    end = lambda name: places.select(F.col("rep").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("cells", "vec", "copies")])

    def verify(batches):
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            score = np.einsum("ij,ij->i", unit(a), unit(b)) if len(a) else np.zeros(0)
            out = pa.RecordBatch.from_arrays([*batch.columns[:2], *batch.columns[4:], pa.array(score)], names=["a", "b", "a_copies", "b_copies", "score"])
            yield out.filter(pa.array(score >= at_least - SLACK))

    links, seen = None, None
    while not frontier.isEmpty():
        lists = graph.select(F.col("rep").alias("by"), "cell", "to")
        pairs = (frontier.join(places.select(F.col("rep").alias("q"), "cells"), "q").join(lists, "by")
                 .where(~F.array_contains("cells", F.col("cell"))).select("q", F.explode("to").alias("t"))
                 .select(F.least("q", "t").alias("a"), F.greatest("q", "t").alias("b")).where("a < b").distinct())
        pairs = materialise(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), "vector-pairs")
        seen = pairs if seen is None else seen.union(pairs)
        apart = pairs.join(end("a"), "a").join(end("b"), "b").where(~F.arrays_overlap("a_cells", "b_cells"))
        near = materialise(apart.select("a", "b", "a_vec", "b_vec", "a_copies", "b_copies").mapInArrow(
            verify, "a long, b long, a_copies long, b_copies long, score double"), "vector-near")
        links = near if links is None else links.union(near)
        frontier = near.select(F.col("a").alias("q"), F.col("b").alias("by")).union(near.select("b", "a"))
    if links is None:
        return places.limit(0).select("rep", F.col("copies").alias("n_links"), F.col("copies").alias("n_reps"), F.col("rep").alias("forest"))
    links = links.where(F.col("score") >= at_least)
    one = F.lit(1).cast("long").alias("n_reps")
    return links.select(F.col("a").alias("rep"), F.col("b_copies").alias("n_links"), one, F.col("b").alias("forest")).union(
        links.select("b", "a_copies", one, "a"))


def audit(reps: DataFrame, found: DataFrame, at_least: float) -> tuple[float, list[str]]:
    """Recall of a sample of at most AUDIT_QUERIES vectors, and the labels below target.

    A vector's recall is the share of the other vectors that brute force over all
    vectors links it to, copies counted once. Recall is the mean over the vectors
    with links, of the dense or of the sparse ones, whichever is lower."""
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(AUDIT_QUERIES).select("rep", "label", "vec")
    queries = [(r["rep"], r["label"], r["vec"]) for r in sample.collect()]
    groups: dict[tuple, list] = {}
    for rep, label, vec in queries:
        groups.setdefault((label, len(vec)), []).append((rep, vec))

    def compare(frames):
        ready = {k: (np.array([r for r, _ in v]), unit([x for _, x in v])) for k, v in groups.items()}
        for frame in frames:
            for (label, size), own in frame.groupby([frame["label"], frame["vec"].map(len)]):
                if (label, size) in ready:
                    rep, x = ready[label, size]
                    near = (x @ unit(own["vec"].tolist()).T >= at_least) & (rep[:, None] != own["rep"].to_numpy())
                    yield pd.DataFrame({"rep": rep, "label": label, "n": near.sum(axis=1)})

    true = reps.select("rep", "label", "vec").mapInPandas(compare, "rep long, label string, n long").groupBy("rep", "label").agg(F.sum("n").alias("n"))
    share = F.least(F.coalesce(F.col("n_reps") / F.col("n"), F.lit(0.0)), F.lit(1.0))
    rows = true.where("n > 0").join(found, "rep", "left").select("label", (F.col("n") > DENSE).alias("dense"), share.alias("share")).collect()
    parts: dict[tuple, list] = {}
    for r in rows:  # of the sample
        for part in (r["dense"],), (r["dense"], r["label"]):
            parts.setdefault(part, []).append(r["share"])
    mean = {part: sum(x) / len(x) for part, x in parts.items()}
    return (min((m for part, m in mean.items() if len(part) == 1), default=1.0),
            sorted({part[1] for part, m in mean.items() if len(part) == 2 and m < AUDIT_TARGET}))


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    at_least: float = 0.93) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept, recall``.

    Rows link when their labels are equal and their cosine is ``at_least``.
    Vectors that are NULL, empty, zero or hold NULL or non-finite values, and
    rows without a label, link with nothing: 0 links, their own component, kept.
    Vectors of different lengths never link. Equal rows link like others. A row
    with a NULL id is kept if it links with nothing; a component takes its
    smallest id. ``recall`` is the audit's. An empty table gives no rows.
    """
    source = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
                          F.col(f"`{label_col}`").cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    # Spark groups -0.0 and 0.0 as one value, their bytes differ: zeros lose their sign.
    unsigned = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    source = materialise(source.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("v", unsigned), "vectors")

    def encode(batches):
        for batch in batches:
            vec = [np.array(x, dtype="<f8").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vec, pa.binary()), *batch.columns[2:]], names=["label", "vec", "copies", "first"])

    distinct = source.where("usable").groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    reps = distinct.select("label", "v", "copies", "first").mapInArrow(encode, "label string, vec binary, copies long, first long")
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "vector-reps")
    recall = 1.0
    for attempt in range(ROUNDS):
        found = materialise(linked(reps, at_least, OVERLAP + attempt, 1 + attempt), "vector-links")
        counts = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"), F.sum("n_reps").alias("n_reps"))
        recall, short = audit(reps, counts, at_least)
        if recall >= AUDIT_TARGET:
            break
    else:
        for labels in (short, None):  # labels that are still short are compared exactly; if that is not it, all are
            again = reps if labels is None else reps.where(F.col("label").isin(labels))
            found = found.join(again.select("rep"), "rep", "left_anti").unionByName(linked(again, at_least, 1, 1, exact=True))
            found = materialise(found, "vector-links")
            counts = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"), F.sum("n_reps").alias("n_reps"))
            recall, _ = audit(reps, counts, at_least)
            if recall >= AUDIT_TARGET:
                break
    joined = components(found.select(F.col("rep").alias("a"), F.col("forest").alias("b")), "vector")
    group = reps.select("rep", "first", "copies").join(joined, F.col("rep") == F.col("node"), "left").select(
        "rep", "first", "copies", F.coalesce("component", "rep").alias("component"))
    least = group.groupBy("component").agg(F.min("first").alias("component_id"))
    facts = group.join(least, "component").join(counts.drop("n_reps"), "rep", "left").select(
        "rep", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    facts = materialise(reps.select("rep", "label", "vec").join(facts, "rep").drop("rep"), "vector-facts")

    def key(batches):
        for batch in batches:
            vec = [np.array(x, dtype="<f8").tobytes() if ok else None for x, ok in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(vec, pa.binary())], names=["vec_id", "label", "vec"])

    out = source.mapInArrow(key, "vec_id long, label string, vec binary").join(facts, ["label", "vec"], "left")
    component = F.coalesce("component_id", "vec_id")
    n_links = F.coalesce("n_links", F.lit(0))
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, n_links == 0).alias("kept"), F.lit(recall).alias("recall"))
