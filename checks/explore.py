from __future__ import annotations

from pyspark.sql import functions as F

from checks import geo
from checks.registry import query, table
from estrato import config
from estrato.operators import evaluate, explore, stats

NAMES = (*config.CORRELATION_COLUMNS, "k")
CORR_SQL = " union all ".join(
    f"select {i} as idx_a, {j} as idx_b, '{a}' as var_a, '{b}' as var_b, "
    f"case when min(case when {b} is not null then {a} end) < max(case when {b} is not null then {a} end) "
    f"and min(case when {a} is not null then {b} end) < max(case when {a} is not null then {b} end) "
    f"then round(corr({a}, {b}), 6) + 0.0 end as corr, "
    f"count(case when {a} is not null and {b} is not null then 1 end) as n "
    f"from (select *, 4.0 as k from ({geo.CLEAN_SQL}) c) c"
    for i, a in enumerate(NAMES) for j, b in enumerate(NAMES))


def _matrix(spark, sf):
    return stats.correlation_matrix(geo.clean(spark, sf).withColumn("k", F.lit(4.0)), NAMES)


@query("corr_matrix", CORR_SQL)
def corr_matrix(spark, sf):
    return _matrix(spark, sf).withColumn("corr", F.round("corr", 6))


@query("corr_lower_triangle",
       f"select idx_a, idx_b, var_a, var_b, round(corr, 2) + 0.0 as corr, n from ({CORR_SQL}) m "
       "where idx_a > idx_b")
def corr_lower_triangle(spark, sf):
    return stats.lower_triangle(_matrix(spark, sf))


LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("corr_all_numeric", " union all ".join(
    f"select '{a}' as var_a, '{b}' as var_b, round(corr({a}, {b}), 6) + 0.0 as corr, "
    "count(*) as n from lineitem" for a in LINE for b in LINE))
def corr_all_numeric(spark, sf):
    """No column list: every numeric column, chosen by type."""
    return stats.correlation_matrix(table(spark, sf, "lineitem")).select("var_a", "var_b", F.round("corr", 6).alias("corr"), "n")


def _points(measure: str) -> str:
    return (f"select tipo_ensayo as series, {measure} as value, profundidad_media as depth "
            f"from ({geo.CLEAN_SQL}) c where {measure} is not null and tipo_ensayo is not null")


@query("depth_profile_vs", _points("vs_m_s"))
def depth_profile_vs(spark, sf):
    return explore.depth_profile(geo.clean(spark, sf), "vs_m_s")


@query("depth_profile_nspt", _points("nspt"))
def depth_profile_nspt(spark, sf):
    return explore.depth_profile(geo.clean(spark, sf), "nspt")


@query("depth_profile_by_item",
       f"select item as series, count(*) as points, min(vs_m_s) as value_min, "
       "max(vs_m_s) as value_max, min(profundidad_media) as depth_min, "
       f"max(profundidad_media) as depth_max from ({geo.CLEAN_SQL}) c "
       "where vs_m_s is not null group by item")
def depth_profile_by_item(spark, sf):
    rows = geo.clean(spark, sf).drop("tipo_ensayo")
    return explore.profile_summary(explore.depth_profile(rows, "vs_m_s"))


@query("profile_series_count",
       f"select count(distinct series) as n_series, count(distinct series) > 1 as legend "
       f"from ({_points('nspt')}) p")
def profile_series_count(spark, sf):
    return explore.series_count(explore.depth_profile(geo.clean(spark, sf), "nspt"))


# --- evaluation over given predictions ---------------------------------------

SCORED = ("select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, "
          "l_extendedprice as label, l_quantity * 2000 + l_tax * 1000 as prediction from lineitem")
METRICS = ("round(avg(e * e), 4) + 0.0 as mse, round(sqrt(avg(e * e)), 4) + 0.0 as rmse, "
           "round(avg(abs(e)), 4) + 0.0 as mae, "
           "round(1 - sum(e * e) / (var_pop(label) * count(label)), 6) + 0.0 as r2")


def scored(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "l_extendedprice as label", "l_quantity * 2000 + l_tax * 1000 as prediction")


def rounded(df, *keep):
    return df.select(*keep, *[F.round(c, 4).alias(c) for c in ("mse", "rmse", "mae")],
                     F.round("r2", 6).alias("r2"))


@query("regression_metrics",
       f"select {METRICS}, count(*) as n from (select *, label - prediction as e from ({SCORED}) s) s")
def regression_metrics(spark, sf):
    m = evaluate.regression_metrics(scored(spark, sf))
    return rounded(m, "n")


@query("regression_metrics_by",
       f"select l_returnflag, {METRICS}, count(*) as n "
       f"from (select *, label - prediction as e from ({SCORED}) s) s group by l_returnflag")
def regression_metrics_by(spark, sf):
    m = evaluate.regression_metrics(scored(spark, sf), by=["l_returnflag"])
    return rounded(m, "l_returnflag", "n")


@query("residuals",
       "select l_orderkey, l_partkey, l_suppkey, l_linenumber, label, round(prediction, 6) + 0.0 "
       f"as prediction, round(label - prediction, 6) + 0.0 as residual from ({SCORED}) s")
def residuals(spark, sf):
    r = evaluate.add_residual(scored(spark, sf))
    return r.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "label",
                    F.round("prediction", 6).alias("prediction"),
                    F.round("residual", 6).alias("residual"))


@query("identity_bounds",
       "select 'joint' as kind, least(min(label), min(prediction)) as low, "
       f"greatest(max(label), max(prediction)) as high from ({SCORED}) s "
       f"union all select 'label', min(label), max(label) from ({SCORED}) s")
def identity_bounds(spark, sf):
    rows = scored(spark, sf)
    joint = evaluate.identity_bounds(rows).select(F.lit("joint").alias("kind"), "low", "high")
    alone = evaluate.identity_bounds(rows, joint=False)
    return joint.union(alone.select(F.lit("label").alias("kind"), "low", "high"))


@query("metric_label",
       "select concat('NSPT ', upper(l_returnflag)) as title, "
       "printf('RMSE: %.2f', sqrt(avg(e * e))) || chr(10) || printf('MAE: %.2f', avg(abs(e))) "
       "|| chr(10) || printf('R²: %.4f', 1 - sum(e * e) / (var_pop(label) * count(label))) as label "
       f"from (select *, label - prediction as e from ({SCORED}) s) s group by l_returnflag")
def metric_label(spark, sf):
    from estrato.functions.columns import metric_label as label

    m = evaluate.regression_metrics(scored(spark, sf), by=["l_returnflag"])
    return m.select(F.concat(F.lit("NSPT "), F.upper("l_returnflag")).alias("title"),
                    label(F.col("rmse"), F.col("mae"), F.col("r2")).alias("label"))
