"""URL filter: rules for hosts and paths, and where none fits a character model.

Accepted and rejected URLs, as the rules tell them, train one Markov model of
characters each. A character is predicted from as many characters before it as were
seen together in training, ``ORDER`` at most; what is left goes to the shorter context
(Witten-Bell), down to equal shares. The judgement is the difference of both models'
log-likelihoods a character, against a limit that parts accepted from rejected best in
labelled URLs kept out of training.

Counts cover every labelled URL. Blocks of URLs send each of their distinct strings of
characters once, with its counts, to the shard of its context; the shard adds them up
and answers each block. So a host with a third of all pages costs one entry a block,
and no part of the models is collected or broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from estrato.llm import textbytes
from estrato.session import materialise

#: Verdict, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Characters of a context at most; six symbols of nine bits and their number make a key.
ORDER = 5
START, END = 256, 257
#: Bytes of URLs of a block, and of all URLs a shard.
BLOCK_BYTES, SHARD_BYTES = 1 << 19, 1 << 18
#: One labelled URL in so many sets the limit instead of training.
CALIBRATION = 5
#: Steps of the score for one character that the limit is chosen from, and the largest.
STEP, STEPS = 0.01, 4000
_BITS, _LENGTH = np.uint64(9), np.uint64(54)


def parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with ``host`` (A-Z lower-cased) and ``path`` of a URL, empty where it has none."""
    rest = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    path = F.when(F.substr(rest, F.length(host) + 1, F.lit(1)) == "/", path).otherwise("")
    return urls.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", path)


def ruled(urls: DataFrame, rules=RULES) -> DataFrame:
    """``urls`` (with host and path) with the longest ``rule`` that fits, as host and
    path in one, and its ``verdict``; else NULL. A rule fits its host and all subdomains,
    if the path starts with its own."""
    rule = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("verdict", verdict)


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, places, row): for each context length the keys of all strings of context and
    next character, the place of that character among all, and the row of each place."""
    data, offsets = textbytes.buffers(column)
    n = len(offsets) - 1
    begin = offsets[:-1] + 2 * np.arange(n)
    size = np.diff(offsets) + 2
    symbol = np.zeros(len(data) + 2 * n, dtype=np.uint64)
    inner = np.ones(len(symbol), dtype=bool)
    inner[begin], inner[begin + size - 1] = False, False
    symbol[begin], symbol[begin + size - 1], symbol[inner] = START, END, data
    row = np.repeat(np.arange(n), size)
    after = np.arange(len(symbol)) - begin[row]
    keys, places = [], []
    key = np.zeros(len(symbol), dtype=np.uint64)
    for j in range(ORDER + 1):
        at = np.flatnonzero(after >= max(j, 1))
        key[at] |= symbol[at - j] << (_BITS * np.uint64(j))
        keys.append(key[at] | np.uint64(j + 1) << _LENGTH)
        places.append(at)
    return keys, places, row


def contexts(key: np.ndarray) -> np.ndarray:
    """The strings without their last character."""
    return ((key & ((np.uint64(1) << _LENGTH) - np.uint64(1))) >> _BITS) | (key >> _LENGTH) - np.uint64(1) << _LENGTH


def in_shards(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, shard, cuts): distinct keys by the shard of their context, in a fixed order."""
    shard = (textbytes.mix(contexts(key)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((key, shard))
    own, first = np.unique(shard[order], return_index=True)
    return order, own, np.r_[first, len(key)]


def answers(frame: pd.DataFrame) -> pd.DataFrame:
    """What a shard tells each block of its strings: the share of the next character in its
    context and the share of the shorter context, for accepted and for rejected URLs."""
    keys = [np.frombuffer(x, np.uint64) for x in frame["keys"]]
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    _, context = np.unique(contexts(key), return_inverse=True)
    told = []
    for name in ("accepted", "rejected"):
        n = np.bincount(where, np.concatenate([np.frombuffer(x, "<i8") for x in frame[name]]), len(key))
        mass = np.bincount(context, n) + np.bincount(context, n > 0)
        types = np.bincount(context, n > 0)[context]
        seen = mass[context] > 0
        told += [n / np.where(seen, mass[context], 1), np.where(seen, types / np.where(seen, mass[context], 1), 1.0)]
    cuts = np.cumsum([0, *map(len, keys)])
    told = np.stack(told, axis=1)
    return pd.DataFrame({"block": frame["block"].to_numpy(), "shard": frame["shard"].to_numpy(),
                         "told": [told[where[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])]})


def likelihoods(column: pa.Array, told: np.ndarray, order: np.ndarray, inverse: np.ndarray, keys, places, row) -> np.ndarray:
    """The difference of log-likelihoods a character for each URL."""
    value = np.empty_like(told)
    value[order] = told
    n = len(row)
    p = np.full((2, n), 1.0 / 258)
    at = 0
    for key, place in zip(keys, places):
        own = value[inverse[at:at + len(key)]]
        at += len(key)
        p[0, place] = own[:, 0] + own[:, 1] * p[0, place]
        p[1, place] = own[:, 2] + own[:, 3] * p[1, place]
    each = np.zeros(n)
    each[places[0]] = np.log(p[0, places[0]]) - np.log(p[1, places[0]])
    rows = len(column)
    return np.bincount(row, each, rows) / np.maximum(np.bincount(row, minlength=rows) - 1, 1)


def scored(rows: DataFrame) -> DataFrame:
    """``rows`` (with url, verdict and ``fit``: whether it trains) with ``score``, the
    accepted model's log-likelihood a character less the rejected one's."""
    size = rows.agg(F.sum(F.octet_length("url"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    held = materialise(textbytes.blocks(rows, "url", BLOCK_BYTES), "url-blocks")

    def send(batches):
        for batch in batches:
            for i, block in enumerate(batch.column(0).to_pylist()):
                own = batch.column(1).slice(i, 1).flatten()
                keys, places, row = strings(own.field("url"))
                verdict = own.field("verdict").to_numpy(zero_copy_only=False)
                fit = own.field("fit").to_numpy(zero_copy_only=False)
                owner = np.concatenate([row[p] for p in places])
                key, where = np.unique(np.concatenate(keys), return_inverse=True)
                order, shard, cuts = in_shards(key, shards)
                counts = [np.bincount(where, (fit & (verdict == v))[owner], len(key)).astype("<i8")[order] for v in ("allow", "block")]
                key = key[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(np.full(len(shard), block)),
                     *(pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in (key, *counts))],
                    names=["shard", "block", "keys", "accepted", "rejected"])

    told = (held.select("block", F.transform("rows", lambda r: F.struct(r["url"].alias("url"), r["verdict"].alias("verdict"), r["fit"].alias("fit"))).alias("rows"))
            .mapInArrow(send, "shard long, block long, keys binary, accepted binary, rejected binary")
            .groupBy("shard").applyInPandas(answers, "block long, shard long, told binary"))

    def judge(own: pa.Table, told: pa.Table) -> pa.Table:
        rows = own.column("rows").combine_chunks().flatten()
        keys, places, row = strings(rows.field("url"))
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        order, _, _ = in_shards(key, shards)
        told = told.sort_by("shard")
        value = np.frombuffer(b"".join(told.column("told").to_pylist()), "<f8").reshape(-1, 4)
        score = likelihoods(rows, value, order, where, keys, places, row)
        return pa.Table.from_arrays([*rows.flatten(), pa.array(score)], names=[f.name for f in rows.type] + ["score"])

    schema = rows.schema.add("score", "double")
    return held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(judge, schema)


def limit(known: DataFrame) -> float:
    """The score that parts accepted from rejected URLs best: most of both rightly judged,
    each class weighing the same. Scores count in steps; without one of the classes it is 0."""
    step = F.greatest(F.least(F.floor(F.col("score") / STEP), F.lit(STEPS)), F.lit(-STEPS))
    counted = known.groupBy(step.cast("int").alias("step"), "verdict").agg(F.count("*").alias("n")).collect()
    n = {v: np.zeros(2 * STEPS + 1) for v in ("allow", "block")}
    for r in counted:
        n[r["verdict"]][r["step"] + STEPS] += r["n"]
    if not n["allow"].sum() or not n["block"].sum():
        return 0.0
    below = {v: np.r_[0, np.cumsum(x)] / x.sum() for v, x in n.items()}
    right = below["block"] + 1 - below["allow"]
    best = np.flatnonzero(right >= right.max() - 1e-12) - STEPS
    return float(best[np.argmin(np.abs(best))]) * STEP


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per input row: ``page_id`` (of its own type), ``url, host, path, rule,
    verdict, score``.

    ``verdict`` is allow or block: that of the longest rule that fits, else allow where
    ``score`` reaches the limit. NULL and empty URLs, and those without ``://``, have an
    empty host and path, and are scored like any other text. Repeated rows and NULL ids
    are rows of their own. Without labelled URLs all scores are 0 and all are allowed.
    An empty table gives no rows. Other columns are ignored.
    """
    source = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = ruled(parts(source), rules)
    fit = F.col("verdict").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(CALIBRATION)) != 0)
    out = materialise(scored(rows.withColumn("fit", fit)), "url-scores")
    least = limit(out.where("verdict is not null and not fit"))
    own = F.coalesce("verdict", F.when(F.col("score") >= least, "allow").otherwise("block"))
    return out.select("page_id", "url", "host", "path", "rule", own.alias("verdict"), "score")
