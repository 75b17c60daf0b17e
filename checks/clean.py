from __future__ import annotations

from pyspark.sql import functions as F

from checks import geo
from checks.registry import query, table
from estrato.functions import columns as C
from estrato.operators import clean
from estrato.session import new_path
from estrato.sources import tables

FILE_SQL = ("concat('Colegio_', cast(user_id % 25 as string), "
            "case when event_id % 3 = 0 then '.csv_' else '_' end, event_type, '.csv')")


@query("site_name", f"select event_id, replace(replace({FILE_SQL}, '.csv', ''), '_', ' ') "
                    "as colegio from events")
def site_name(spark, sf):
    return table(spark, sf, "events").select("event_id", C.site_name(F.expr(FILE_SQL)).alias("colegio"))


@query("drop_all_null_rows",
       f"select sample_id, gravas, sucs, nspt from ({geo.RAW_SQL}) r "
       "where gravas is not null or sucs is not null or nspt is not null")
def drop_all_null_rows(spark, sf):
    rows = geo.raw(spark, sf).select("sample_id", "gravas", "sucs", "nspt")
    return clean.drop_all_null_rows(rows, ["gravas", "sucs", "nspt"])


@query("sentinel_to_null",
       f"select sample_id, nullif(hasta, '-') as hasta, nullif(vs_m_s, '-') as vs_m_s, "
       f"nullif(qadm_kg_cm2, '-') as qadm_kg_cm2 from ({geo.RAW_SQL}) r")
def sentinel_to_null(spark, sf):
    names = ["hasta", "vs_m_s", "qadm_kg_cm2"]
    return clean.replace_sentinel(geo.raw(spark, sf).select("sample_id", *names), names)


@query("numeric_coerce",
       "select sample_id, " + ", ".join(f"{geo.number(c)} as {c}" for c in geo.NUMBERS)
       + f" from ({geo.RAW_SQL}) r")
def numeric_coerce(spark, sf):
    return clean.coerce_numeric(geo.raw(spark, sf).select("sample_id", *geo.NUMBERS))


@query("coercion_report", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as present, count({geo.number(c)}) as parsed, "
    f"count({c}) - count({geo.number(c)}) as nulled from ({geo.RAW_SQL}) r" for c in geo.NUMBERS))
def coercion_report(spark, sf):
    return clean.coercion_report(geo.raw(spark, sf))


@query("mid_depth", f"select sample_id, profundidad_media from ({geo.DERIVED_SQL}) d")
def mid_depth(spark, sf):
    rows = clean.coerce_numeric(geo.raw(spark, sf).select("sample_id", "de", "hasta"))
    return clean.add_mid_depth(rows).select("sample_id", "profundidad_media")


@query("test_type",
       "select o_orderkey as id, split_part(o_orderpriority, '-', 1) as tipo_ensayo from orders "
       f"union all select -1 - sample_id, split_part(item, '-', 1) from ({geo.RAW_SQL}) r")
def test_type(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                               F.col("o_orderpriority").alias("item"))
    items = geo.raw(spark, sf).select((-1 - F.col("sample_id")).alias("id"), "item")
    return clean.add_test_type(orders.unionByName(items)).select("id", "tipo_ensayo")


CLEAN_COLUMNS = ("sample_id, colegio, item, de, hasta, vs_m_s, gravas, arenas, finos, sucs, nspt, "
                 "qadm_kg_cm2, potencia, profundidad_media, tipo_ensayo")


@query("clean_rows", f"select {CLEAN_COLUMNS} from ({geo.CLEAN_SQL}) c")
def clean_rows(spark, sf):
    return geo.clean(spark, sf).select(*CLEAN_COLUMNS.split(", "))


PROFILED = [c for c in CLEAN_COLUMNS.split(", ")]


@query("null_column_profile", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as non_null, count(*) as total "
    f"from ({geo.CLEAN_SQL}) c" for c in PROFILED))
def null_column_profile(spark, sf):
    return clean.null_column_profile(geo.clean(spark, sf), PROFILED)


@query("drop_null_columns",
       f"select {CLEAN_COLUMNS.replace('potencia, ', '')} from ({geo.CLEAN_SQL}) c")
def drop_null_columns(spark, sf):
    return clean.drop_null_columns(geo.clean(spark, sf).select(*PROFILED))


@query("table_shape", f"select count(*) as n_rows, 15 as n_columns from ({geo.CLEAN_SQL}) c")
def table_shape(spark, sf):
    return clean.table_shape(geo.clean(spark, sf).select(*PROFILED))


@query("union_by_name",
       "select c_custkey as id, c_name as name, c_acctbal as acctbal, c_mktsegment as segment "
       "from customer union all select s_suppkey, s_name, s_acctbal, null from supplier")
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "c_custkey as id", "c_mktsegment as segment", "c_acctbal as acctbal", "c_name as name")
    s = table(spark, sf, "supplier").selectExpr(
        "s_name as name", "s_suppkey as id", "s_acctbal as acctbal")
    return clean.union_by_name([c, s]).select("id", "name", "acctbal", "segment")


@query("load_clean", f"select {CLEAN_COLUMNS} from ({geo.CLEAN_SQL}) c")
def load_clean(spark, sf):
    path = new_path(spark, "clean")
    tables.write_table(geo.clean(spark, sf).select(*PROFILED), path)
    return tables.load_table(spark, path)


@query("csv_roundtrip", f"select {CLEAN_COLUMNS} from ({geo.CLEAN_SQL}) c")
def csv_roundtrip(spark, sf):
    path = new_path(spark, "clean-csv")
    rows = geo.clean(spark, sf).select(*PROFILED)
    tables.write_csv(rows, path)
    return tables.load_table(spark, path, schema=rows.schema, fmt="csv")


SUMMARY_SQL = f"""
select colegio, tipo_ensayo, count(*) as n, count(vs_m_s) as n_vs,
  round(avg(vs_m_s), 6) + 0.0 as vs_mean, min(vs_m_s) as vs_min, max(vs_m_s) as vs_max,
  round(avg(profundidad_media), 6) + 0.0 as depth_mean
from ({geo.CLEAN_SQL}) c group by colegio, tipo_ensayo"""


@query("site_summary", SUMMARY_SQL)
def site_summary(spark, sf):
    """Flagship: raw text to cleaned rows to one line per site and test type."""
    return geo.clean(spark, sf).groupBy("colegio", "tipo_ensayo").agg(
        F.count("*").alias("n"), F.count("vs_m_s").alias("n_vs"),
        F.round(F.avg("vs_m_s"), 6).alias("vs_mean"),
        F.min("vs_m_s").alias("vs_min"), F.max("vs_m_s").alias("vs_max"),
        F.round(F.avg("profundidad_media"), 6).alias("depth_mean"))
