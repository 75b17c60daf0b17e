"""Benchmark passages in documents, allowing a few edits.

By the pigeonhole principle an item within k edits holds one of its k + 1 pieces
unchanged. The pieces of all items are searched at once with an Aho-Corasick
automaton over the whole text; around each hit the whole item is verified with
Myers' bit-parallel edit distance. Documents are only scanned, never shuffled.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Items go to the executors in blocks of about this many bytes of text.
ITEM_BYTES = 8 << 20
#: Edits for each character of an item: pieces have about twelve characters then, few
#: enough texts share one. At 0.1 verifying chance hits takes ten times as long.
RATE = 0.08
SCHEMA = "doc_id long, item_id long, distance long, start_word long, end_word long"


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split())


class Item:
    """One benchmark text ready for search."""

    def __init__(self, item_id: int | None, text: str, rate: float):
        self.item_id, self.text, self.budget = item_id, text, int(len(text) * rate)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def pieces(self) -> list[tuple[int, str]]:
        n, parts = len(self.text), self.budget + 1
        cuts = [n * k // parts for k in range(parts + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the place in ``text`` with the fewest edits, by Myers'
        bit vectors; the first of equals."""
        m = len(self.text)
        every, high = (1 << m) - 1, 1 << (m - 1)
        up, down, score = every, 0, m
        found = (m, 0)
        masks = self.masks
        for j, c in enumerate(text):
            eq = masks.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            plus = down | (every & ~(xh | up))
            minus = up & xh
            if plus & high:
                score += 1
            elif minus & high:
                score -= 1
                if score < found[0]:
                    found = (score, j + 1)
            plus = (plus << 1) & every
            minus = (minus << 1) & every
            up = minus | (every & ~(xv | plus))
            down = plus & xv
        return found

    def begin(self, text: str, end: int, distance: int) -> int:
        """Where the place that ends at ``end`` begins."""
        turned = Item(None, self.text[::-1], 0.0)
        tail = text[max(0, end - len(self.text) - distance):end][::-1]
        return end - turned.best(tail)[1]


def automaton(items: list[Item]):
    import ahocorasick

    where: dict[str, list[tuple[int, int]]] = {}
    for k, item in enumerate(items):
        for start, piece in item.pieces():
            where.setdefault(piece, []).append((k, start))
    search = ahocorasick.Automaton()
    for piece, places in where.items():
        search.add_word(piece, (len(piece), places))
    search.make_automaton()
    return search


def matches(text: str, items: list[Item], search) -> list[tuple[int | None, int, int, int]]:
    """(item_id, distance, start word, end word) of the best place of each item found."""
    windows: dict[int, list[list[int]]] = {}
    for last, (length, places) in search.iter(text):
        for k, start in places:
            item = items[k]
            a = last + 1 - length - start - item.budget
            b = a + len(item.text) + 2 * item.budget
            own = windows.setdefault(k, [])
            if own and a <= own[-1][1]:
                own[-1][0], own[-1][1] = min(own[-1][0], a), max(own[-1][1], b)
            else:
                own.append([a, b])
    out = []
    for k, own in windows.items():
        item, best = items[k], None
        for a, b in own:
            a = max(0, a)
            distance, end = item.best(text[a:b])
            if distance <= item.budget and (best is None or distance < best[0]):
                best = (distance, a + end)
        if best:
            begin = item.begin(text, best[1], best[0])
            out.append((item.item_id, best[0], text.count(" ", 0, begin), text.count(" ", 0, best[1]) + 1))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document row and item it holds: ``doc_id, item_id, distance,
    start_word, end_word`` (words from 0, the end exclusive) of the best place.

    Texts are compared in lower case with white space as single spaces. An item
    may differ by ``rate`` edits a character, rounded down. NULL and empty items
    match nothing, NULL and empty documents hold nothing. Equal items and equal
    documents give a row each; NULL ids stay NULL. Items may be any number: they
    are sent in blocks of a fixed size, one scan of the documents each.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    queries = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    queries = queries.where("text is not null")
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    out = None
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()
        items = [(r["item_id"], normal(r["text"])) for r in mine]
        items = [x for x in items if x[1]]
        if not items:
            continue
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent):
            own = [Item(i, x, rate) for i, x in sent.value]
            search = automaton(own)
            for batch in batches:
                rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text
                        for hit in matches(normal(text), own, search)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                                                 names=["doc_id", "item_id", "distance", "start_word", "end_word"])

        found = texts.mapInArrow(run, SCHEMA)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out
