"""A probabilistic suffix tree over words that grows with the corpus, dealt by context.

Every run of up to ``depth + 1`` words seen ``min_count`` times in the training texts
counts, at any size of input. A context becomes a state when its distribution
diverges from that of its longest shorter state; the rest of its mass goes there
(Witten-Bell), down to the words of the whole vocabulary.

A context and all longer ones that end in it hang on one branch of the tree. Words get
numbers by falling frequency, so a number tells the word's count. Each block of
texts sends its distinct windows (a word and the ``depth`` words before it), as packed
numbers, to the shard of the word before; the shard grows that branch and answers
each window with its probability. A branch is thus learned and asked where it is, and
no table of runs is written, joined, collected or broadcast.

Contexts seen over ``split_rows`` times are hot: their branches are cut at them. One
exchange a level counts their next words, added up per block first and dealt by
context and next word; windows carry these counts on to the shards of the longer
contexts, to which a hot context's windows are dealt. Its five sums go to every task:
at most ``HOT`` contexts a level are hot, as ``split_rows`` grows with the corpus beyond.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from estrato.llm import textbytes
from estrato.session import discard, materialise

#: Stands for the end of a text; ``ALPHA`` is added to the count of every word.
END = np.int64(0x5EED0FE11D0C5EED)
ALPHA = 0.1
#: Bytes of all texts a shard, and of the texts of a block (of which a task holds about 30 times as much).
SHARD_BYTES, ASK_BYTES = 2 << 20, 4 << 20
#: Shards of windows to one of words.
WORD_SHARDS = 8
#: How messages are compressed.
CODEC = pa.Codec("zstd", compression_level=6)
#: A window's log10 probability is sent in such steps: 1.2e-10 off at most.
STEPS = 1 << 32
#: Windows of a context that one shard takes, and contexts of a length that may have more.
SPLIT_ROWS, HOT = 1 << 20, 1 << 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row): lower-cased words and an end for each text."""
    rows = len(offsets) - 1
    small = textbytes.lower(data)
    starts, ends, row = textbytes.words(small, offsets)
    h = np.full(len(starts) + rows, END, dtype=np.int64)
    h[np.arange(len(starts)) + row] = textbytes.Rolling(small).spans(starts, ends)
    return h, np.repeat(np.arange(rows), np.bincount(row, minlength=rows) + 1)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers from 0, each byte place by itself, so that equal places compress."""
    widths = [(int(c.max()).bit_length() + 7) // 8 if len(c) else 0 for c in columns]
    planes = [np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths)]
    raw = np.int64(len(columns[0])).tobytes() + bytes([len(columns), *widths]) + b"".join(planes)
    return np.int64(len(raw)).tobytes() + CODEC.compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = CODEC.decompress(blob[8:], int(np.frombuffer(blob, "<i8", 1)[0]), asbytes=True)
    n, many = int(np.frombuffer(raw, "<i8", 1)[0]), raw[8]
    out, at = [], 9 + many
    for width in raw[9:at]:
        column = np.zeros((n, 8), np.uint8)
        column[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(column.view("<i8").ravel())
        at += n * width
    return out


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers of 64 bits, as their steps."""
    x = x.astype(np.int64).view(np.uint64)
    return pack(np.diff(x, prepend=x[:1] * np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob)[0].view(np.uint64), dtype=np.uint64).view(np.int64)


def stepped(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows in ascending order as steps from the row before, in each column as long as the columns before are equal."""
    out, new = [], np.arange(len(columns[0])) == 0
    for c in columns:
        step = c.astype(np.int64)
        step[1:] -= np.where(new[1:], 0, c[:-1])
        out.append(step)
        new = new | (step != 0)
    return out


def unstepped(steps: list[np.ndarray]) -> list[np.ndarray]:
    at = np.arange(len(steps[0]))
    out, new = [], at == 0
    for step in steps:
        whole, first = np.cumsum(step), np.maximum.accumulate(np.where(new, at, 0))
        out.append(whole - (whole - step)[first])
        new = new | (step != 0)
    return out


def pack_logs(x: np.ndarray) -> tuple[bytes, bytes]:
    """Logarithms to the nearest 1 / ``STEPS``: which of the distinct ones, and these."""
    values, which = np.unique(np.rint(x * STEPS).astype(np.int64), return_inverse=True)
    return pack(which), pack_sorted(values)


def unpack_logs(which: bytes, values: bytes) -> np.ndarray:
    return unpack_sorted(values)[unpack(which)[0]] / STEPS


def dense(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): where each distinct row of the columns stands, in their order, and which one each row is."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    key, most = np.zeros(len(columns[0]), dtype=np.int64), 1
    for c in columns:
        wide = int(c.max()) + 1
        if most * wide >= 1 << 63:  # numbers of the distinct rows so far take less
            first, key = ranked(key)
            most = len(first)
        key *= wide
        key += c
        most *= wide
    return ranked(key)


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def folded(h: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The hash of what ``h`` stands for with one more number."""
    return textbytes.mix(textbytes.mix(h + np.uint64(0x9E3779B97F4A7C15)) + column.astype(np.uint64))


def written(df: DataFrame, label: str) -> DataFrame:
    """An intermediate whose shuffles are deleted when it is written: nothing reads them again."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return materialise(df, label)
    finally:
        conf.set(name, before)


def by_shard(key: np.ndarray, shards: int):
    """(order, own, cuts): keys by shard, the shards met, and where the keys of each begin and the last end."""
    shard = np.mod(key, shards)
    order = np.argsort(shard, kind="stable")
    own, first = np.unique(shard[order], return_index=True)
    return order, own, np.r_[first, len(key)]


@dataclass
class Model:
    """What every task knows: the counts of words by their numbers, one entry for each
    distinct count (fewer than the root of twice the tokens), and the sums of hot contexts."""

    n: int
    words: int
    texts: int
    firsts: np.ndarray
    counts: np.ndarray
    depth: int
    min_count: int
    divergence: float
    split: int
    hot: list[pd.DataFrame] = field(default_factory=list)

    @property
    def start(self) -> int:
        """The number of what stands before a text; unknown words have the one below, nothing at all the one above."""
        return self.words + 1

    def slim(self, number: np.ndarray) -> np.ndarray:
        return number.astype(np.int32 if self.words < (1 << 31) - 4 else np.int64)

    def count(self, number: np.ndarray) -> np.ndarray:
        if not self.words:
            return np.zeros(len(number), dtype=np.int64)
        found = self.counts[np.searchsorted(self.firsts, number, side="right") - 1]
        return np.where(number < self.words, found, 0)

    def chance(self, number: np.ndarray) -> np.ndarray:
        return (self.count(number) + ALPHA) / (self.n + ALPHA * (self.words + 1))

    def chances(self, before: list[np.ndarray], word: np.ndarray, times: np.ndarray, carried: list[np.ndarray]) -> np.ndarray:
        """The probability of each window's word. The windows of a context that is not
        hot are all here; ``carried`` has for each length how often a hot one's goes on so."""
        p, context, live, key = self.chance(word), np.zeros(len(word), dtype=np.int64), np.arange(len(word)), np.zeros(1, dtype=np.uint64)
        for k, own in enumerate(before):
            first_of, context = dense(context, own[live])
            m, total, met = len(first_of), np.bincount(context, times[live], len(first_of)), np.zeros(len(first_of), dtype=bool)
            if k < len(self.hot) and len(self.hot[k]):
                known, key = self.hot[k], folded(key, own)
                keys, some = known["key"].to_numpy(), key[live[first_of]].view(np.int64)
                at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
                met = keys[at] == some
                total[met] = known["total"].to_numpy()[at[met]]
            # Contexts too rare to be a state have no longer ones that are.
            good = (total[context] >= max(self.min_count, 1)) & (own[live] <= self.start)
            live, context = live[good], context[good]
            first, which = dense(context, word[live])
            count = np.bincount(which, times[live], len(first))
            kept = count >= self.min_count
            of, some, parent = context[first][kept], count[kept], p[live[first]][kept]
            held, types, covered, far = (np.bincount(of, x, m) for x in (some, np.ones(len(of)), parent, some * np.log(some / parent)))
            count = count[which]
            if met.any():
                for name, x in (("held", held), ("types", types), ("covered", covered), ("far", far)):
                    x[met] = known[name].to_numpy()[at[met]]
                count = np.where(met[context], carried[k][live], count)
            with np.errstate(divide="ignore", invalid="ignore"):
                left = (total - held) / total
                apart = (far - held * np.log(total)) / total
                apart += np.where(left > 0, left * np.log(left / np.maximum(1 - covered, 1e-12)), 0)
                back, mass = total - held + types, total + types
                state = (types > 0) & (apart >= self.divergence)
                below = p[live]
                p[live] = np.where(state[context], (np.where(count >= self.min_count, count, 0) + back[context] * below) / mass[context], below)
        return p


def blocks(docs: DataFrame) -> DataFrame:
    """(block, words, seen, codes, doc_id, learn, n): a block's distinct words, how often its
    training texts hold each, and its texts as numbers of these words."""
    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for part, data, offsets in textbytes.slices(batches, "text", ASK_BYTES):
            learn = part.column(part.schema.names.index("learn"))
            found, rows = [], 0
            for some, own, at in textbytes.slices([part]):
                h, row = tokens(own, at)
                found.append((h, row + rows))
                rows += some.num_rows
            h, row = (np.concatenate(x) for x in zip(*found))
            words, codes = np.unique(h, return_inverse=True)
            seen = np.bincount(codes, learn.to_numpy(zero_copy_only=False)[row], len(words)).astype(np.int64)
            order = np.argsort(-np.bincount(codes), kind="stable")
            place = np.empty(len(words), dtype=np.int64)
            place[order] = np.arange(len(words))
            texts = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), x) for x in
                     (part.column(part.schema.names.index("doc_id")), learn, pa.array(np.bincount(row, minlength=rows)))]
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([words[order].tobytes()]), pa.array([pack(seen[order])]),
                                              pa.array([pack(place[codes])]), *texts],
                                             names=["block", "words", "seen", "codes", "doc_id", "learn", "n"])
            block += 1

    return docs.mapInArrow(run, "block long, words binary, seen binary, codes binary, doc_id array<long>, learn array<boolean>, n array<long>")


NUMBERED = "block long, numbers binary, doc_id array<long>, learn array<boolean>, n array<long>, carried array<binary>"


def numbered(held: DataFrame, shards: int, **settings) -> tuple[DataFrame, Model]:
    """The blocks with words as numbers by falling count in the training texts, and the model so far."""
    def dealt(words: np.ndarray):
        """As :func:`by_shard`, ascending within a shard."""
        ascending = np.argsort(words)
        order, own, cuts = by_shard(words[ascending], shards)
        return ascending[order], own, cuts

    def send(batches):
        for batch in batches:
            for block, words, seen in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words, seen = np.frombuffer(words, "<i8"), unpack(seen)[0]
                order, own, cuts = dealt(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.full(len(own), block)),
                     *(pa.array([f(x[order[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()) for x, f in ((words, pack_sorted), (seen, pack)))],
                    names=["shard", "block", "words", "seen"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        key, which = np.unique(np.concatenate([unpack_sorted(x) for x in frame["words"]]), return_inverse=True)
        n = np.bincount(which, np.concatenate([unpack(x)[0] for x in frame["seen"]]), len(key)).astype(np.int64)
        return pd.DataFrame({"shard": frame["shard"].iloc[0], "key": key[n > 0], "n": n[n > 0]})

    def look(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["n", "key"])
        number = own["first"].to_numpy(np.int64) + own.groupby("n").cumcount().to_numpy()
        order = np.argsort(own["key"].to_numpy(np.int64))
        keys, number = own["key"].to_numpy(np.int64)[order], number[order]
        out = []
        for blob in asked["words"]:
            key = unpack_sorted(blob)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            out.append(pack(np.where(keys[at] == key, number[at], words) if len(keys) else np.full(len(key), words)))
        return pd.DataFrame({"block": asked["block"], "shard": asked["shard"], "told": out})

    def rename(rows: pa.Table, told: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        order, _, _ = dealt(np.frombuffer(row["words"], "<i8"))
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.concatenate([unpack(x)[0] for x in told.sort_by("shard").column("told").to_pylist()])
        return rows.select(["block", "doc_id", "learn", "n"]).add_column(1, "numbers", pa.array([pack(number[unpack(row["codes"])[0]])])).append_column(
            "carried", pa.array([[]], pa.list_(pa.binary())))

    asks = held.select("block", "words", "seen").mapInArrow(send, "shard long, block long, words binary, seen binary")
    counted = written(asks.groupBy("shard").applyInPandas(add, "shard long, key long, n long"), "words")
    sizes = counted.groupBy("n").count().toPandas().sort_values("n", ascending=False)  # one row for each distinct count
    n, words = int((sizes["n"] * sizes["count"]).sum()), int(sizes["count"].sum())
    texts = counted.where(F.col("key") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    firsts = np.r_[0, sizes["count"].cumsum().to_numpy(np.int64)][:-1]
    model = Model(n, words, texts, firsts, sizes["n"].to_numpy(np.int64), **settings)
    # Words of one count are numbered shard by shard.
    starts = held.sparkSession.createDataFrame(list(zip(sizes["n"].tolist(), firsts.tolist())), "n long, begin long")
    before = Window.partitionBy("n").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = (counted.groupBy("shard", "n").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
              .join(starts, "n").select("shard", "n", (F.col("begin") + F.col("before")).alias("first")))
    own = counted.join(places, ["shard", "n"])
    told = asks.groupBy("shard").cogroup(own.groupBy("shard")).applyInPandas(look, "block long, shard long, told binary")
    out = written(held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(rename, NUMBERED), "numbered")
    discard(counted)
    return out, model


class Windows:
    """The windows of one block: a word, the words before it (nearest first), counts carried along."""

    def __init__(self, row: dict, model: Model):
        self.word = model.slim(unpack(row["numbers"])[0])
        sizes = np.array(row["n"], dtype=np.int64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.learn = np.array(row["learn"], dtype=bool)[self.row]
        self.place = np.arange(len(self.word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.before = [np.where(self.place >= k, np.roll(self.word, k), model.slim(model.start + (self.place != k - 1))) for k in range(1, model.depth + 1)]
        self.carried = [unpack(x)[0] for x in row["carried"]]
        self.model = model

    def hot(self, levels: int) -> list[np.ndarray]:
        """For each length whether the context is hot. How often a longer one is seen was
        carried one place before, as its first words are a hot context, too."""
        out, own = [], np.ones(len(self.word), dtype=bool)
        for k, before in enumerate(self.before[:levels]):
            if k:
                seen = np.where(self.place > 0, np.roll(self.carried[k - 1], 1), 0)
            else:
                seen = np.where(before == self.model.start, self.model.texts, self.model.count(before))
            own = own & (seen > self.model.split) & (before <= self.model.start)
            out.append(own)
        return out

    def asked(self, level: int, shards: int):
        """(at, which, times, order, own, cuts): the distinct windows in the order they are
        sent. A ``level`` from 1 asks for the next words of hot contexts of that length, 0 for all."""
        hot = self.hot(level or len(self.carried))
        some = np.flatnonzero(hot[-1]) if level else np.arange(len(self.word))
        before = [x[some] for x in self.before[:level or None]]
        first, which = dense(before[0], self.word[some], *before[1:])  # so that equal chances stand together
        times = np.bincount(which, self.learn[some], len(first)).astype(np.int64)
        at = some[first]
        before = [x[first] for x in before]
        key, free = np.zeros(len(at), dtype=np.uint64), np.ones(len(at), dtype=bool)
        h = np.zeros(1, dtype=np.uint64)
        for k, own in enumerate([*before, self.word[at]]):
            h = folded(h, own)
            key[free] = h[free]
            if k < len(before):
                free = free & ((hot[k][at] if k < len(hot) else False) | (before[k] > self.model.start))
            if not free.any():
                break
        return (at, some, which, times, *by_shard(key.view(np.int64), shards))

    def sent(self, level: int, shards: int):
        at, _, _, times, order, own, cuts = self.asked(level, shards)
        before, at, times = self.before[:level or None], at[order], times[order]
        rows = [x[at] for x in (before[0], self.word, *before[1:])]
        others = [times, *(x[at] for x in self.carried)]
        return own, [pack(*stepped([x[a:b] for x in rows]), *(x[a:b] for x in others)) for a, b in zip(cuts, cuts[1:])]


def exchange(held: DataFrame, level: int, shards: int, model: Model) -> DataFrame:
    """(shard, block, sent): the windows of all blocks, dealt to shards."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, blobs = Windows(row, model).sent(level, shards)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), row["block"])), pa.array(blobs, pa.binary())],
                                                     names=["shard", "block", "sent"])

    return held.mapInArrow(run, "shard long, block long, sent binary")


def together(blobs: list[bytes], level: int):
    """(before, word, times, carried, ends) of all messages about contexts of ``level``
    words, and where each message ends but the last."""
    parts = [unpack(x) for x in blobs]
    parts = [[*unstepped(p[:level + 1]), *p[level + 1:]] for p in parts]
    nearest, word, *others = (np.concatenate(x) for x in zip(*parts))
    return [nearest, *others[:level - 1]], word, others[level - 1], others[level:], np.cumsum([len(p[0]) for p in parts])[:-1]


SUMS = ["total", "held", "types", "covered", "far", "most"]


def counted_hot(held: DataFrame, level: int, shards: int, model: Model) -> tuple[DataFrame, pd.DataFrame]:
    """The blocks with the counts of the next words of hot contexts of one length carried along, and the sums of these contexts."""
    def settle(table: pa.Table) -> pa.Table:
        before, word, times, carried, ends = together(table.column("sent").to_pylist(), level)
        first, which = dense(*before, word)
        count = np.bincount(which, times, len(first)).astype(np.int64)
        parent = model.chances(before[:-1], word, times, carried)[first]
        key = np.zeros(1, dtype=np.uint64)
        for x in before:
            key = folded(key, x[first])
        key, own = np.unique(key.view(np.int64), return_inverse=True)
        kept = count >= model.min_count
        sums = [np.bincount(own, x, len(key)) for x in (count, np.where(kept, count, 0), kept, np.where(kept, parent, 0),
                                                        np.where(kept, count * np.log(np.maximum(count, 1) / parent), 0))]
        most = np.zeros(len(key))
        np.maximum.at(most, own, count)
        answers = [pack(x) for x in np.split(count[which], ends)]
        a, b = len(answers), len(key)
        return pa.table([pa.array([*table.column("block").to_pylist(), *[None] * b], pa.int64()), pa.array([*table.column("shard").to_pylist(), *[None] * b], pa.int64()),
                         pa.array([*answers, *[None] * b], pa.binary()), pa.array([*[None] * a, *key.tolist()], pa.int64()),
                         *(pa.array([*[None] * a, *x.tolist()], pa.float64()) for x in (*sums, most))], names=["block", "shard", "told", "key", *SUMS])

    def carry(rows: pa.Table, told: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        own = Windows(row, model)
        out = np.zeros(len(own.word), dtype=np.int64)
        if told.num_rows:
            _, some, which, _, order, _, _ = own.asked(level, shards)
            count = np.empty(len(order), dtype=np.int64)
            count[order] = np.concatenate([unpack(x)[0] for x in told.sort_by("shard").column("told").to_pylist()])
            out[some] = count[which]
        return rows.drop_columns(["carried"]).append_column("carried", pa.array([[*row["carried"], pack(out)]], pa.list_(pa.binary())))

    settled = exchange(held, level, shards, model).groupBy("shard").applyInArrow(
        settle, "block long, shard long, told binary, key long, " + ", ".join(f"{c} double" for c in SUMS))
    settled = written(settled, f"hot-{level}")
    sums = settled.where("key is not null").groupBy("key").agg(*[F.sum(c).alias(c) for c in SUMS[:-1]], F.max("most").alias("most"))
    sums = sums.toPandas().sort_values("key")  # at most HOT rows: split grows with the tokens
    told = settled.where("key is null").select("block", "shard", "told")
    out = written(held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(carry, NUMBERED), f"carried-{level}")
    discard(settled, held)
    return out, sums


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 3,
          min_count: int = 2, divergence: float = 0.02, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per document row: ``doc_id, learn, n_tokens, n_known, train_tokens,
    base_score, score`` (log10 probabilities), of a tree with every context and next
    word seen together ``min_count`` times in the rows where ``learn`` is true.

    NULL and empty texts are the end token alone, which is learned like a word. Rows
    with NULL or repeated ids and repeated rows are rows of their own, each learned
    from. NULL of ``learn`` counts as false. Where nothing is learned every word is as
    likely as any. An empty table gives no rows. Other columns are ignored, whatever
    their names. ``split_rows`` changes how the work is dealt, not the result. Scores are
    off by 1.2e-10 a token at most (:data:`STEPS`).
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.coalesce(learn, F.lit(False)).alias("learn"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    cut = written(blocks(source), "word-blocks")
    held, model = numbered(cut, max(8, shards // WORD_SHARDS), depth=depth, min_count=min_count, divergence=divergence, split=split_rows)
    discard(cut)
    model.split = max(split_rows, model.n // HOT)
    most = max([model.texts, *model.counts[:1].tolist()])
    while most > model.split and len(model.hot) < depth:
        held, sums = counted_hot(held, len(model.hot) + 1, shards, model)
        model.hot.append(sums)
        most = sums["most"].max() if len(sums) else 0

    def answer(table: pa.Table) -> pa.Table:
        *windows, ends = together(table.column("sent").to_pylist(), depth)
        p = model.chances(*windows)
        which, values = zip(*(pack_logs(x) for x in np.split(np.log10(p), ends)))
        return pa.table([table.column("shard"), table.column("block"), pa.array(which, pa.binary()), pa.array(values, pa.binary())],
                        names=["shard", "block", "which", "told"])

    def gather(rows: pa.Table, told: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        own = Windows(row, model)
        _, _, which, _, order, _, _ = own.asked(0, shards)
        value = np.empty(len(order))
        told = told.sort_by("shard")
        value[order] = np.concatenate([unpack_logs(*x) for x in zip(told.column("which").to_pylist(), told.column("told").to_pylist())])
        n = len(row["n"])
        known, base, whole = (np.bincount(own.row, x, n) for x in (model.count(own.word) > 0, np.log10(model.chance(own.word)), value[which]))
        return pa.table([pa.array(row["doc_id"], pa.int64()), pa.array(row["learn"], pa.bool_()), pa.array(row["n"], pa.int64()),
                         pa.array(known.astype(np.int64)), pa.array(np.full(n, model.n)), pa.array(base), pa.array(whole)],
                        names=["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    answers = exchange(held, 0, shards, model).groupBy("shard").applyInArrow(answer, "shard long, block long, which binary, told binary")
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        gather, "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
