from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import geo
from checks.registry import query, table
from estrato import config
from estrato.operators import features, split, stats
from estrato.session import materialise

# The given tables lack some soil columns: the presets keep what exists.
NUM = ("profundidad_media", "vs_m_s", "gravas", "arenas", "finos")
CAT = ("sucs", "tipo_ensayo")


@query("target_rows", f"select sample_id, nspt from ({geo.CLEAN_SQL}) c where nspt is not null")
def target_rows(spark, sf):
    return features.target_rows(geo.clean(spark, sf), "nspt").select("sample_id", "nspt")


@query("feature_frame",
       f"select 'nspt' as target, sample_id, {', '.join(NUM)}, sucs, tipo_ensayo, nspt as label "
       f"from ({geo.CLEAN_SQL}) c where nspt is not null union all "
       f"select 'qadm', sample_id, {', '.join(NUM)}, sucs, tipo_ensayo, qadm_kg_cm2 "
       f"from ({geo.CLEAN_SQL}) c where qadm_kg_cm2 is not null")
def feature_frame(spark, sf):
    df = geo.clean(spark, sf)
    parts = [features.feature_frame(df, preset, ["sample_id"]).df
             .select(F.lit(preset.name).alias("target"), "sample_id", *NUM, *CAT, "label")
             for preset in (config.NSPT, config.QADM)]
    return parts[0].union(parts[1])


GUARDED = (
    config.NSPT,
    config.QADM,
    replace(config.NSPT, name="no_target", target="absent"),
    replace(config.NSPT, name="empty_target", target="potencia"),
    replace(config.NSPT, name="few", numeric=("profundidad_media", "lp", "vs_m_s")),
    replace(config.NSPT, name="no_depth", required=("profundidad_media", "absent")),
)


def _guard(name, column):
    return (f"select '{name}' as target, count({column}) >= 10 as ok, case when count({column}) < 10 "
            f"then 'too few rows with a target' end as reason from ({geo.CLEAN_SQL}) c")


def _fixed(name, reason):
    return f"select '{name}', false, '{reason}' from ({geo.CLEAN_SQL}) c having count(*) > 0"


@query("feature_guards", " union all ".join([
    _guard("nspt", "nspt"), _guard("qadm", "qadm_kg_cm2"),
    _fixed("no_target", "no target column absent"), _guard("empty_target", "potencia"),
    _fixed("few", "too few numeric features"),
    _fixed("no_depth", "missing required features: absent")]))
def feature_guards(spark, sf):
    return features.guard_report(geo.clean(spark, sf), GUARDED)


MEDIANS = ("profundidad_media", "vs_m_s", "gravas", "arenas", "finos", "nspt", "qadm_kg_cm2")


@query("impute_median",
       f"with c as ({geo.CLEAN_SQL}) select sample_id, "
       + ", ".join(f"coalesce({c}, (select median({c}) from c)) as {c}" for c in MEDIANS)
       + " from c")
def impute_median(spark, sf):
    rows = geo.clean(spark, sf).select("sample_id", *MEDIANS, "potencia")
    return features.impute_median(rows, [*MEDIANS, "potencia"])    # the all-null one goes


LINE = {"l_quantity": "case when l_orderkey % 7 = 0 then null else l_quantity end",
        "l_extendedprice": "case when l_partkey % 5 = 0 then null else l_extendedprice end",
        "l_discount": "l_discount", "l_tax": "case when l_orderkey % 3 = 0 then null else l_tax end",
        "constant": "cast(case when l_suppkey % 2 = 0 then 3 end as double)"}
LINE_SQL = "select l_orderkey, l_partkey, " + ", ".join(f"{e} as {c}" for c, e in LINE.items()) \
           + " from lineitem"


@query("column_medians", " union all ".join(
    f"select '{c}' as \"column\", median({c}) as median from ({LINE_SQL}) l" for c in LINE))
def column_medians(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in LINE.items()])
    found = stats.exact_medians(rows, list(LINE))
    return spark.createDataFrame(list(found.items()), "`column` string, median double")


@query("standardize",
       f"with l as ({LINE_SQL}), i as (select l_orderkey, l_partkey, "
       + ", ".join(f"coalesce({c}, (select median({c}) from l)) as {c}" for c in LINE)
       + " from l) select l_orderkey, l_partkey, "
       + ", ".join(f"round(({c} - (select avg({c}) from i)) / coalesce(nullif("
                   f"(select stddev_pop({c}) from i), 0), 1), 6) + 0.0 as {c}" for c in LINE)
       + " from i")
def standardize(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey",
                                                   *[f"{e} as {c}" for c, e in LINE.items()])
    scaled = features.scale(rows, list(LINE))
    return scaled.select("l_orderkey", "l_partkey", *[F.round(c, 6).alias(c) for c in LINE])


PART = ("select p_partkey, case when p_partkey % 6 = 0 then null else p_type end as p_type, "
        "case when p_partkey % 4 = 0 then null else p_brand end as p_brand from part")


def _mode(c):
    return (f"(select {c} from p where {c} is not null group by {c} "
            f"order by count(*) desc, {c} limit 1)")


@query("impute_mode",
       f"with p as ({PART}) select p_partkey, coalesce(p_type, {_mode('p_type')}) as p_type, "
       f"coalesce(p_brand, {_mode('p_brand')}) as p_brand from p")
def impute_mode(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey", "case when p_partkey % 6 = 0 then null else p_type end as p_type",
        "case when p_partkey % 4 = 0 then null else p_brand end as p_brand")
    return features.impute_mode(rows, ["p_type", "p_brand"])


@query("category_levels",
       f"with p as ({PART}) select 'p_type' as feature, p_type as value, count(*) as n from p "
       "where p_type is not null group by 2 union all "
       "select 'p_brand', p_brand, count(*) from p where p_brand is not null group by 2")
def category_levels(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "case when p_partkey % 6 = 0 then null else p_type end as p_type",
        "case when p_partkey % 4 = 0 then null else p_brand end as p_brand")
    return stats.category_counts(rows, ["p_type", "p_brand"])


# Levels are fitted on the parts of even size; brands sold only odd stay unseen.
ONE_HOT = """
with p as (select p_partkey, p_size, case when p_partkey % 10 = 1 then concat('only-', p_brand)
             else p_brand end as p_brand from part),
levels as (select distinct p_brand as level from p where p_partkey % 2 = 0),
numbered as (select level, row_number() over (order by level) - 1 as slot from levels)
select p_partkey, slot, case when p_brand = level then 1.0 else 0.0 end as value
from p, numbered"""


@query("one_hot", ONE_HOT.replace("then 1.0 else 0.0 end", "then cast(1 as double) else 0 end"))
def one_hot(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey", "case when p_partkey % 10 = 1 then concat('only-', p_brand) else p_brand end "
                     "as p_brand", "double(p_size) as p_size")
    train = rows.filter("p_partkey % 2 = 0")
    model = features.fit_preprocessor(train, [], ["p_brand"])
    hot = model.transform(rows).select("p_partkey", vector_to_array("features").alias("v"))
    return hot.select("p_partkey", F.posexplode("v").alias("slot", "value")).select(
        "p_partkey", F.col("slot").cast("long").alias("slot"), "value")


def _vector_sql() -> str:
    mode = "(select {c} from tr where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"
    out = [f"""with c as (select * from ({geo.CLEAN_SQL}) c where nspt is not null),
tr as (select * from c where sample_id % 4 <> 0),
i as (select sample_id, {', '.join(f"coalesce({c}, (select median({c}) from tr)) as {c}" for c in NUM)},
  {', '.join(f"coalesce({c}, {mode.format(c=c)}) as {c}" for c in CAT)} from c),
ti as (select * from i where sample_id % 4 <> 0),
lv as (select level, f, row_number() over (order by f, level) + {len(NUM) - 1} as slot from (
  select distinct 0 as f, sucs as level from ti union all
  select distinct 1, tipo_ensayo from ti) l)"""]
    parts = [f"select sample_id, {j} as slot, round(({c} - (select avg({c}) from ti)) / coalesce("
             f"nullif((select stddev_pop({c}) from ti), 0), 1), 6) + 0.0 as value from i"
             for j, c in enumerate(NUM)]
    parts.append("select sample_id, slot, case when level = case when f = 0 then sucs "
                 "else tipo_ensayo end then cast(1 as double) else 0 end from i, lv")
    return out[0] + " " + " union all ".join(parts)


@query("feature_vector", _vector_sql())
def feature_vector(spark, sf):
    """Fit on three quarters, transform all: every slot of every vector."""
    rows = materialise(features.target_rows(geo.clean(spark, sf), "nspt")
                       .select("sample_id", *NUM, *CAT), "rows")
    model = features.fit_preprocessor(rows.filter("sample_id % 4 <> 0"), list(NUM), list(CAT))
    v = model.transform(rows).select("sample_id", vector_to_array("features").alias("v"))
    return v.select("sample_id", F.posexplode("v").alias("slot", "value")).select(
        "sample_id", F.col("slot").cast("long").alias("slot"), F.round("value", 6).alias("value"))


ORDERED = ("select o_orderkey, row_number() over (order by md5('42:' || cast(o_orderkey as string))) "
           "as rn, count(*) over () as n from orders")


@query("train_test_split",
       f"select o_orderkey, rn <= ceil(0.25 * n) as is_test from ({ORDERED}) o")
def train_test_split(spark, sf):
    return split.train_test_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


FOLDS_SQL = ("select o_orderkey, ntile(5) over (order by rn) - 1 as fold "
             f"from ({ORDERED}) o where rn > ceil(0.25 * n)")


@query("kfold_assign", FOLDS_SQL)
def kfold_assign(spark, sf):
    rows = split.split_and_folds(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return rows.filter("not is_test").select("o_orderkey", F.col("fold").cast("long").alias("fold"))


@query("kfold_assign_rest", FOLDS_SQL)
def kfold_assign_rest(spark, sf):
    """The same folds, assigned to the training rows on their own."""
    rows = split.train_test_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    folds = split.assign_folds(rows.filter("not is_test"), ["o_orderkey"])
    return folds.select("o_orderkey", F.col("fold").cast("long").alias("fold"))


LKEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
LHASH = "md5('42:' || concat_ws('-', " + ", ".join(f"cast({k} as string)" for k in LKEY) + "))"


@query("split_composite_key",
       f"select {', '.join(LKEY)}, row_number() over (order by {LHASH}) <= ceil(0.25 * count(*) over ()) "
       "as is_test from lineitem")
def split_composite_key(spark, sf):
    return split.train_test_split(table(spark, sf, "lineitem").select(*LKEY), LKEY)
