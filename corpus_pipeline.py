"""From raw documents to packed training sequences, in five written stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``. The second stage takes rows that share a
``doc_id`` for one document. The third and the fourth judge rows by id and text, so
rows that share an id or have none are compared and searched like any other; rows
with the same id and text are one there, of which the smallest by the other columns stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from estrato.llm import decontaminate, linedup, packing, quality, simhash
from estrato.llm.queries import tokenizer_files
from estrato.llm.registry import table
from estrato.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; NULL and empty texts are scored as blank."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; ``n_chars`` follows them."""
    kept = linedup.drop_repeated_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the row with the smallest id (NULL comes last), then digest of its text."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    keyed = docs.select(key.alias("key"), *[F.col(f"`{c}`") for c in docs.columns])
    groups = simhash.near_duplicates(keyed.select("key", "text"), id_col="key", width=3, budget=2)
    first = materialise(groups.where("id = component_id").groupBy("id").agg(F.count("*").alias("rows")), "kept-rows")
    # One plan at every size: ids grow with the corpus, so they are never broadcast.
    kept = keyed.join(first.select(F.col("id").alias("key")).hint("shuffle_hash"), "key", "left_semi")
    if not first.where("rows > 1").isEmpty():
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        kept = kept.groupBy("key").agg(F.min(whole).alias("row")).select("row.*")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, whatever their ids. A document that has one
    goes whole: what surrounds a passage tends to give its answer."""
    key = F.xxhash64("doc_id", "text")
    hits = decontaminate.contaminated(docs.select(key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), id_col="key")
    hits = materialise(hits.select("doc_id").distinct(), "contaminated")
    return docs.join(hits.select(F.col("doc_id").alias("key")), key == F.col("key"), "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document, with its ids and its place in a sequence."""
    return packing.pack(docs, **tokenizer_files())


STAGES = [("quality", keep_quality), ("lines", drop_lines), ("near_copies", drop_near_copies),
          ("decontamination", drop_benchmark), ("packing", pack)]

#: The classifier, SimHash and tokenizer are beyond SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
