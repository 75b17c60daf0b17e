"""License notices in texts: phrases, and a set-similarity join with templates.

A block is a window of words, over line ends too, so a wrapped notice is one block and
words far apart are none. Templates are classed by length, the least power of two
that holds one; for a class of c words, windows of 2c words begin at every multiple of
c, so any c words that follow one another are in one. A block matches a template when
it holds at least ``threshold`` of the template's distinct words. Words are ordered by
their number in all texts, rarest first. With a required overlap of k, a block and a
template that match share a word among the first size - k + 1 of each (prefix filter),
so only windows around such rare words are made; a block has k known words at least
(length filter); and from the place of the shared word on, both have enough words left
(positional filter). What passes is verified. Templates are a fixed list, so their side
is bounded. All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: The phrases of the base scan and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices whose words are looked for, and their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under a creative commons attribution share alike license", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
     "merchantability or fitness for a particular purpose see the gnu general public license for more details", "gpl"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied", "apache-2.0"),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
     "in the documentation and or other materials provided with the distribution", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission", "bsd"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)

#: A word, and what may stand between two. Written as ranges: the negated form
#: of the same set takes the regex engine ten times as long.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words with A-Z lower-cased, in order."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def places(words: Column, phrase: str) -> Column:
    """Starts, in words from 0, at which the phrase's words stand one after the other."""
    parts = phrase.split()
    span = F.when(F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts)))

    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + k) == part)
        return same
    return F.coalesce(F.filter(span, here), F.array().cast("array<int>"))


def base_scan(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without the text, with ``text_hash, n_words, n_base,
    first_word, last_word`` and ``base`` (array of labels)."""
    likely = "(?i)" + "|".join(GAP.join(p.split()) for p, _ in PHRASES)
    found = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(likely), words_of(F.col("text"))).alias("words"))
    found = found.select("doc_id", "text_hash", "n_words", *[places(F.col("words"), p).alias(f"p{k}") for k, (p, _) in enumerate(PHRASES)])
    every = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    labels = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]), F.isnotnull)
    return found.select("doc_id", "text_hash", "n_words", F.size(every).cast("long").alias("n_base"),
                        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), labels.alias("base"))


def length_class(template: str) -> int:
    """The least power of two that its words number."""
    return 1 << (len(template.split()) - 1).bit_length()


def template_join(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, label, containment): the largest share of a template's
    words in a block of the text, for each label with one that meets the threshold."""
    spark = docs.sparkSession
    sets = [sorted(set(t.split())) for t, _ in templates]
    need = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    vocabulary = sorted({w for s in sets for w in s})
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("ws"))
    known = F.filter("ws", lambda w: w.isin(vocabulary))
    counted = {r["word"]: r["n"] for r in words.select(F.explode(known).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    index, whole = [], []
    for t, (own, k) in enumerate(zip(sets, need)):
        ranks = sorted(rank[w] for w in own)
        whole.append((t, templates[t][1], ranks, k))
        index += [(order[ranks[i]], t, i, len(ranks), k, length_class(templates[t][0])) for i in range(len(ranks) - k + 1)]
    prefixes = spark.createDataFrame(index, "word string, template int, i int, size int, need int, class int")
    whole = spark.createDataFrame(whole, "template int, label string, ranks array<int>, need int")
    ranked = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    # A rare word brings along as many words on both sides as the widest window has.
    rare, reach = sorted({r[0] for r in index}), 2 * max(length_class(t) for t, _ in templates)
    at = F.filter(F.transform("ws", lambda w, i: F.when(w.isin(rare), i)), F.isnotnull)
    around = F.transform(at, lambda i: F.struct(
        i.alias("at"), F.get("ws", i).alias("word"), F.greatest(i - reach, F.lit(0)).alias("since"),
        F.slice("ws", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach)).alias("near")))
    met = words.select("doc_id", "text_hash", F.explode(around).alias("a")).select("doc_id", "text_hash", "a.*")
    met = met.join(F.broadcast(prefixes), "word")
    step = F.floor(F.col("at") / F.col("class")).cast("int")
    met = met.withColumn("window", F.explode(F.filter(F.array(step - 1, step), lambda k: k >= 0)))
    held = F.slice("near", F.greatest(F.col("window") * F.col("class") - F.col("since"), F.lit(0)) + 1, 2 * F.col("class"))
    block = F.array_sort(F.transform(F.array_distinct(F.filter(held, lambda w: w.isin(vocabulary))), lambda w: F.element_at(ranked, w)))
    met = met.select("doc_id", "text_hash", "template", "i", "size", "need", block.alias("block"), F.element_at(ranked, F.col("word")).alias("rank"))
    met = met.withColumn("j", F.array_position("block", F.col("rank")) - 1).where(
        (F.size("block") >= F.col("need")) & (F.col("j") <= F.size("block") - F.col("need"))
        & (F.least(F.col("size") - F.col("i"), F.size("block") - F.col("j")) >= F.col("need")))
    met = met.join(F.broadcast(whole.drop("need")), "template")
    shared = F.size(F.array_intersect("block", "ranks"))
    return (met.select("doc_id", "text_hash", "label", shared.alias("shared"), F.col("size"), "need").where("shared >= need")
            .groupBy("doc_id", "text_hash", "label").agg(F.max(F.col("shared") / F.col("size")).alias("containment")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    ``labels`` adds to the phrases' labels those of templates of whose distinct
    words some block (see above) holds at least ``threshold``. ``score`` is the largest such
    share, 1 where a phrase stands, 0 where nothing does. NULL and empty texts
    have no words: counts 0, first and last NULL, labels empty strings. Repeated
    rows and NULL ids give a row each. Other columns are ignored.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    joined = template_join(source, templates, threshold).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    joined = joined.select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"), "more", "best")
    out = base_scan(source).join(joined, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"))
