"""A byte-level convolutional network that tells clean text from junk.

Bytes are embedded, learned filters of eight bytes slide over the whole text in
steps of four, and each filter keeps its maximum in every chunk of 512 bytes;
chunks overlap by half. The mean and the maximum of the chunks pass a small
hidden layer into one probability. The network is numpy alone. It is fitted in
one task on a bounded sample of labelled rows and is a few kilobytes in size;
scoring is a scan.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from estrato.llm import textbytes

EMBED, STEP, FILTERS, HIDDEN, HALF = 8, 4, 32, 16, 256
THRESHOLD = 0.7
#: Labelled rows that the network is fitted on at most, and the longest text among them.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 4000, 1 << 16
#: Texts seen in a fit, all passes together; passes over a small sample at most.
VISITS, PASSES, BATCH = 24_000, 30, 16

Model = dict[str, np.ndarray]


def fresh() -> Model:
    r = np.random.default_rng(0)
    wide = 2 * STEP * EMBED
    shapes = {"emb": ((256, EMBED), 0.5), "w": ((wide, FILTERS), wide ** -0.5), "b": ((FILTERS,), 0), "h": ((2 * FILTERS, HIDDEN), (2 * FILTERS) ** -0.5),
              "hb": ((HIDDEN,), 0), "o": ((HIDDEN,), HIDDEN ** -0.5), "ob": ((), 0)}
    return {k: np.asarray(r.normal(0, 1, shape) * scale, dtype=np.float32) for k, (shape, scale) in shapes.items()}


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each filled up with zero bytes to whole half chunks
    (two at least), and the half chunks of each."""
    size = np.diff(offsets)
    halves = np.maximum(2, -(-size // HALF))
    begin = np.cumsum(halves * HALF) - halves * HALF
    out = np.zeros(int(halves.sum()) * HALF, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(begin - offsets[:-1], size)] = data
    return out, halves


def forward(model: Model, x: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logits of the texts, and what the gradient needs."""
    blocks = model["emb"][x].reshape(-1, STEP * EMBED)
    half_w = STEP * EMBED
    y = blocks @ model["w"][half_w:]
    edge = np.cumsum(halves) * (HALF // STEP) - 1  # the last block of a text: zero bytes follow
    y[:-1] = y[1:]
    y[edge] = np.tile(model["emb"][0], STEP) @ model["w"][half_w:]
    y += blocks @ model["w"][:half_w]
    y += model["b"]
    np.maximum(y, 0, out=y)
    y = y.reshape(-1, HALF // STEP, FILTERS)
    at = y.argmax(axis=1)
    top = np.take_along_axis(y, at[:, None], 1)[:, 0]
    later = top[1:] > top[:-1]
    chunk = np.where(later, top[1:], top[:-1])
    begin = np.cumsum(halves) - halves
    own = np.ones(len(chunk), dtype=bool)
    own[begin[1:] - 1] = False  # pairs of half chunks across texts
    keep = np.flatnonzero(own)
    chunk = chunk[keep]
    first = np.cumsum(halves - 1) - (halves - 1)
    mean = np.add.reduceat(chunk, first, axis=0) / (halves - 1)[:, None].astype(np.float32)
    most = np.maximum.reduceat(chunk, first, axis=0)
    v = np.concatenate([mean, most], axis=1)
    hidden = np.maximum(v @ model["h"] + model["hb"], 0)
    return hidden @ model["o"] + model["ob"], (blocks, at, top, later, keep, chunk, first, most, v, hidden)


def gradient(model: Model, x: np.ndarray, halves: np.ndarray, cache: tuple, delta: np.ndarray) -> Model:
    blocks, at, top, later, keep, chunk, first, most, v, hidden = cache
    g: Model = {"o": hidden.T @ delta, "ob": delta.sum()}
    dh = np.outer(delta, model["o"]) * (hidden > 0)
    g["h"], g["hb"] = v.T @ dh, dh.sum(axis=0)
    dv = dh @ model["h"].T
    text = np.repeat(np.arange(len(halves)), halves - 1)
    dchunk = (dv[:, :FILTERS] / (halves - 1)[:, None].astype(np.float32))[text]
    peak = chunk == most[text]
    peak &= np.cumsum(peak, axis=0) - (np.cumsum(peak, axis=0) - peak)[first][text] == 1  # the first of equals
    dchunk += dv[:, FILTERS:][text] * peak
    dtop = np.zeros_like(top)
    second = later[keep]
    dtop[keep + 1] += dchunk * second
    dtop[keep] += dchunk * ~second
    dtop *= top > 0
    where, f = np.nonzero(dtop)
    d = dtop[where, f][:, None]
    pos = where * (HALF // STEP) + at[where, f]
    last = np.zeros(len(blocks), dtype=bool)
    last[np.cumsum(halves) * (HALF // STEP) - 1] = True
    spans = np.where(last[pos][:, None] & (np.arange(2 * STEP) >= STEP), -1, pos[:, None] * STEP + np.arange(2 * STEP))
    bytes_ = np.where(spans < 0, 0, x[spans])
    dw = np.zeros((FILTERS, 2 * STEP * EMBED), dtype=np.float32)
    np.add.at(dw, f, model["emb"][bytes_].reshape(len(f), -1) * d)
    g["w"], g["b"] = dw.T, np.bincount(f, d[:, 0], FILTERS).astype(np.float32)
    dwin = (model["w"].T[f] * d).reshape(-1, EMBED)
    g["emb"] = np.stack([np.bincount(bytes_.ravel(), dwin[:, k], 256) for k in range(EMBED)], axis=1).astype(np.float32)
    return g


def fit(texts: list[bytes], labels: np.ndarray) -> Model | None:
    """Adam on the log loss; the same sample gives the same model. None without rows."""
    if not texts:
        return None
    model, r = fresh(), np.random.default_rng(1)
    m, v = ({k: np.zeros_like(x) for k, x in model.items()} for _ in range(2))
    passes = int(np.clip(-(-VISITS // len(texts)), 1, PASSES))
    steps, t = passes * -(-len(texts) // BATCH), 0
    for _ in range(passes):
        order = r.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            data = np.frombuffer(b"".join(texts[k] for k in pick), dtype=np.uint8)
            offsets = np.r_[0, np.cumsum([len(texts[k]) for k in pick])]
            x, halves = padded(data, offsets)
            logit, cache = forward(model, x, halves)
            delta = ((1 / (1 + np.exp(-logit)) - labels[pick]) / len(pick)).astype(np.float32)
            rate = 3e-3 * (1 - t / steps) + 1e-4
            t += 1
            for k, d in gradient(model, x, halves, cache, delta).items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                model[k] = (model[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Model | None:
    """The network fitted on at most ``rows`` labelled documents for which
    ``usable`` (of ``doc_id``) holds, picked by a hash of the id. Labels other than
    0 and 1 and rows with a NULL id or label are no material."""
    marked = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    marked = marked.where(usable & F.col("label").isin(0, 1))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)  # so many rows at most are broadcast
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sample = (texts.where(F.octet_length("text") <= SAMPLE_TEXT_BYTES).join(F.broadcast(picked), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text")).limit(rows))

    def learn(frames):
        frame = pd.concat([pd.DataFrame({"text": [], "label": []}), *frames])
        model = fit([t.encode() for t in frame["text"]], frame["label"].to_numpy(dtype=np.float32))
        out = io.BytesIO()
        np.savez(out, **(model or {}))
        yield pd.DataFrame({"model": [out.getvalue()]})

    raw = sample.select("text", "label").coalesce(1).mapInPandas(learn, "model binary").first()
    return None if raw is None else dict(np.load(io.BytesIO(raw[0]))) or None


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every input row as struct ``row`` and its ``score``, the probability of label 1.

    All bytes of a text count; NULL is an empty text, which is scored as blank.
    Without a model every score is 0.5. Equal texts score alike up to rounding.
    An empty table gives none; input columns may have any name.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches):
        for batch in batches:
            row = batch.column(0)
            text = pc.cast(pc.struct_field(row, text_col), pa.string())
            both = pa.RecordBatch.from_arrays([row, text], names=["row", "text"])
            for part, data, offsets in textbytes.slices([both], "text", 1 << 20):
                if model is None:
                    p = np.full(part.num_rows, 0.5)
                else:
                    logit = forward(model, *padded(data, offsets))[0].astype(np.float64)
                    p = 1 / (1 + np.exp(-logit))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["row", "score"])

    schema = T.StructType([T.StructField("row", source.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label may be learned from; a NULL id is one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))
