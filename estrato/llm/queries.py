"""The registered queries of the numbered operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from estrato.llm import decontaminate, grams, licenses, linedup, packing, periods, quality, repeats, simhash, trie, units, urls, vectors
from estrato.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_files() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken")}


@query("op8_packing")
def op8_packing(spark, sf_dir):
    out = packing.pack(table(spark, sf_dir, "documents"), **tokenizer_files())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset", "segment", "loss_tokens")


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, budget=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP2_SQL = """
with d as (
  select doc_id, coalesce(doc_id, 9223372036854775807) as own, row_number() over () as rid,
    string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (
  select doc_id, own, rid, unnest(range(len(lines))) as pos, unnest(lines) as line from d),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
g as (
  select key, min(own) as first from k where length(key) >= 10 group by key having min(own) < max(own)),
m as (
  select k.*, coalesce(own > first, false) as gone from k left join g using (key))
select doc_id, count(*) as n_lines, sum(gone::int)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by rid, doc_id
"""


@query("op2_line_dedup", OP2_SQL)
def op2_line_dedup(spark, sf_dir):
    out = linedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("rest.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~quality.held_out())
    out = quality.score(docs, model).select("row.doc_id", "score")
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op5_sql() -> str:
    """The same by a plain comparison of every window of words with every template."""
    def stands(phrase: str) -> str:
        same = " and ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1))
        return f"list_filter(range(0, len(ws) - {len(phrase.split()) - 1}), lambda i: {same})"

    places = ", ".join(f"{stands(p)} as p{k}" for k, (p, _) in enumerate(licenses.PHRASES))
    base = " || ".join(f"case when len(p{k}) > 0 then ['{label}'] else [] end" for k, (_, label) in enumerate(licenses.PHRASES))
    every = " || ".join(f"p{k}" for k in range(len(licenses.PHRASES)))
    templates = ", ".join(f"({sorted(set(t.split()))}, {2 ** math.ceil(math.log2(len(t.split())))}, '{label}')" for t, label in licenses.TEMPLATES)
    lowered = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"
    return f"""
with d as (
  select doc_id, row_number() over () as rid, coalesce(text, '') as text from documents),
t(words, c, label) as (values {templates}),
u as (select rid, regexp_extract_all({lowered.format('text')}, {word}) as ws from d),
l as (
  select rid, c, list_distinct(ws[k * c + 1:k * c + 2 * c]) as ws
  from (select rid, ws, c, unnest(range(greatest((len(ws) + c - 1) // c, 1))) as k from u, (select distinct c from t))),
m as (
  select rid, list_distinct(list(label)) as more, max(len(list_intersect(ws, words)) / len(words)) as best
  from l join t using (c) where len(list_intersect(ws, words)) >= ceil(0.8 * len(words) - 1e-9) group by rid),
w as (
  select doc_id, rid, regexp_extract_all({lowered.format('text')}, {word}) as ws from d),
p as (select doc_id, rid, len(ws) as n_words, {places} from w),
b as (select doc_id, rid, n_words, {every} as every, list_sort({base}) as base from p)
select doc_id, n_words, len(every)::bigint as n_base, list_min(every) as first_word, list_max(every) as last_word,
  array_to_string(base, ',') as base_labels, array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') as labels,
  greatest(case when len(every) > 0 then 1.0::double else 0.0::double end, coalesce(best, 0.0)::double) as score
from b left join m using (rid)
"""


@query("op5_licenses", op5_sql())
def op5_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op1_suffix_tree")
def op1_suffix_tree(spark, sf_dir):
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    out = grams.score(table(spark, sf_dir, "documents"), learn)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP3_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) as (
  select vec_id, vec_id from v union select r.a, l.b from reach r join links l on r.b = l.a),
n as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from (select a as vec_id, min(b) as component_id from reach group by a) left join n on n.a = vec_id
"""


@query("op3_embeddings", OP3_SQL)
def op3_embeddings(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings")).drop("recall")


def span_bytes(spans: str):
    return F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"]), F.lit(0))


@query("op4_suffix_array")
def op4_suffix_array(spark, sf_dir):
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", span_bytes("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir):
    out = units.remove_repeated_units(table(spark, sf_dir, "documents"), unit="passage")
    return out.select("doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), span_bytes("removed").alias("removed_bytes"),
                      F.transform("removed", lambda s: s["begin"]).alias("removed_begin"),
                      F.transform("removed", lambda s: s["end"]).alias("removed_end"), F.sha2("kept", 256).alias("kept_sha256"))


def looped(docs):
    """``docs`` with every tenth document's words, by the checksum of its id, made to go
    round in a loop from some word on; a document without an id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    laid = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    laid = laid.withColumn("a", F.when(n > 0, a).cast("int")).withColumn("p", F.when(n > 0, p).cast("int"))
    tail = F.transform(F.sequence(F.lit(0), n - F.col("a") - 1), lambda i: F.get("w", F.col("a") + i % F.col("p")))
    whole = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return laid.select("doc_id", F.when(n > 0, whole).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    out = periods.runs(looped(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("at"), (-r["period"]).alias("by"))))
    out = out.withColumn("top", longest)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.at")).alias("start"), F.col("top.length").alias("length"),
                      (-F.col("top.by")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.by")).cast("long").alias("exponent_milli"),
                      F.sha2(listed, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


@query("op13_url_filter")
def op13_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


OP11_SQL = """
with crc as (
  select list(v order by i) as tab from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
      lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as v from range(256) r(i))),
l as (
  select conv_id, list(md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as ts,
    list(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as ws
  from conversations where conv_id is not null group by conv_id),
c as (
  select conv_id, ts, ws, conv_id - conv_id % 20 as base,
    xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295::bigint) % 4 as h
  from l, crc),
s as (
  select c.conv_id, list_concat(coalesce(b.ts[1:h], []), c.ts[h + 1:]) as ts, list_concat(coalesce(b.ws[1:h], []), c.ws[h + 1:]) as ws
  from c left join l b on b.conv_id = c.base),
p as (
  select conv_id, d, array_to_string(ts[1:d], '') as k, array_to_string(ts[1:d - 1], '') as up, d = len(ts) as ends, case when d > 0 then ws[d] else 0 end as w, ts
  from (select conv_id, ts, ws, unnest(range(len(ts) + 1)) as d from s)),
n as (
  select d, k, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(w) as own, any_value(ts) as ts,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends) as ids from p group by d, k),
kids as (select up as k, d - 1 as d, count(*) as n_children from n where d > 0 group by 1, 2),
a as (select n.*, coalesce(n_children, 0) as n_children from n left join kids using (k, d)),
sums as (
  select array_to_string(ts[1:j], '') as k, j as d, sum((n_children = 0)::int) as n_leaves, sum(own) as saved_tokens
  from (select ts, own, n_children, unnest(range(d + 1)) as j from a) group by 1, 2)
select a.conv_id, a.d as depth, u.conv_id as parent_conv_id, a.n_convs, a.n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens,
  sha256(coalesce(a.ids, '')) as ends_sha256
from a join sums using (k, d) left join a u on u.k = a.up and u.d = a.d - 1
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark, sf_dir):
    return trie.forest(trie.rebuilt(trie.sequenced(table(spark, sf_dir, "conversations"))))
