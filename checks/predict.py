from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks import geo
from checks.registry import query, table
from estrato import config
from estrato.operators import evaluate, linear, predict
from estrato.plans import predict as plan
from estrato.session import materialise, new_path
from estrato.sources import artifacts, tables
from estrato.sources.requests import parse_requests

REQUEST = {
    "request_id": "c_custkey",
    "north": "case when c_custkey % 7 = 0 then '' when c_custkey % 11 = 0 then 'abc' "
             "else concat(' ', cast(9457265 + c_custkey as string)) end",
    "east": "case when c_custkey % 13 = 0 then null "
            "else concat(cast(535010 + c_custkey as string), '.25') end",
    "max_depth": "case when c_custkey % 5 = 0 then ' ' when c_custkey % 17 = 0 then 'x' "
                 "when c_custkey % 3 = 0 then concat(cast(20 + c_nationkey as string), '.5') "
                 "else cast(20 + c_custkey % 50 as string) end",
}
REQUEST_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in REQUEST.items()) + " from customer"
GIVEN = f"({geo.number('north')}) is not null and ({geo.number('east')}) is not null"
DEPTH = (f"case when trim(coalesce(max_depth, '')) = '' then 50.0 else {geo.number('max_depth')} end")
PARSED_SQL = f"""
select request_id, case when {GIVEN} then {geo.number('north')} else 9457265 end as norte,
  case when {GIVEN} then {geo.number('east')} else 535010 end as este,
  cast({DEPTH} as double) as max_depth,
  case when {GIVEN} then concat('Norte ', trim(north), '.0 Este ', trim(east))
       else 'Ubicación Predeterminada' end as location,
  case when ({DEPTH}) is null then 'invalid max_depth' end as error
from ({REQUEST_SQL}) r"""
GRID_SQL = f"""
select request_id, norte, este, max_depth, location, i as depth_idx,
  case when i = 99 then max_depth else i * (max_depth / 99) end as profundidad
from ({PARSED_SQL}) p, range(100) g(i) where error is null"""


def requests(spark, sf):
    return table(spark, sf, "customer").selectExpr(*[f"{e} as {n}" for n, e in REQUEST.items()])


def grid(spark, sf):
    return predict.profile_grid(parse_requests(requests(spark, sf)))


@query("parse_requests", PARSED_SQL)
def parsed(spark, sf):
    return parse_requests(requests(spark, sf))


@query("depth_grid",
       "select s_suppkey, i as depth_idx, round(case when i = 99 then abs(s_acctbal) "
       "else i * (abs(s_acctbal) / 99) end, 8) + 0.0 as profundidad "
       "from supplier, range(100) g(i)")
def depth_grid(spark, sf):
    rows = table(spark, sf, "supplier").selectExpr("s_suppkey", "abs(s_acctbal) as max_depth")
    return predict.depth_grid(rows).select("s_suppkey", "depth_idx",
                                           F.round("profundidad", 8).alias("profundidad"))


@query("profile_grid",
       f"select request_id, location, depth_idx, round(profundidad, 9) + 0.0 as profundidad "
       f"from ({GRID_SQL}) g")
def profile_grid(spark, sf):
    return grid(spark, sf).select("request_id", "location", "depth_idx",
                                  F.round("profundidad", 9).alias("profundidad"))


INPUTS = (*config.NSPT.numeric, "norte", "este", *config.NSPT.categorical)


@query("profile_inputs",
       "select request_id, depth_idx, round(profundidad, 9) + 0.0 as profundidad_media, "
       "cast(0 as double) as vs_m_s, norte, este, "
       + ", ".join(f"'{v}' as {k}" if isinstance(v, str) else f"cast({v} as double) as {k}"
                   for k, v in config.NSPT_DEFAULTS.items())
       + f", 'vs_m_s' as defaulted from ({GRID_SQL}) g")
def profile_inputs(spark, sf):
    rows = predict.profile_inputs(grid(spark, sf), INPUTS, config.NSPT_DEFAULTS,
                                  keep=["request_id", "depth_idx"])
    return (rows.withColumn("defaulted", F.concat_ws(",", "defaulted_features"))
            .drop("defaulted_features")
            .withColumn("profundidad_media", F.round("profundidad_media", 9)))


# --- linear stand-ins: blow count by depth, pressure by depth and blow count ---------

TRAIN = f"select profundidad_media as x, nspt as z, qadm_kg_cm2 as y from ({geo.CLEAN_SQL}) c"
CHAIN_SQL = f"""
with t as ({TRAIN}),
m1 as (select regr_slope(z, x) as w, regr_intercept(z, x) as b from t
       where z is not null),
s as (select avg(x) as mx, avg(z) as mz, avg(y) as my, var_pop(x) as xx, var_pop(z) as zz,
        covar_pop(x, z) as xz, covar_pop(x, y) as xy, covar_pop(z, y) as zy
      from t where y is not null and z is not null),
m2 as (select (zz * xy - xz * zy) / (xx * zz - xz * xz) as wx,
         (xx * zy - xz * xy) / (xx * zz - xz * xz) as wz, mx, mz, my from s),
p1 as (select g.*, b + w * profundidad as nspt from ({GRID_SQL}) g, m1),
p2 as (select p1.*, my + wx * (profundidad - mx) + wz * (nspt - mz) as qadm from p1, m2)"""


_stored: dict[tuple[str, str], str] = {}


def models(spark, sf) -> str:
    """Train and store both stand-ins, once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        _stored[key] = _train(spark, sf)
    return _stored[key]


def _train(spark, sf) -> str:
    rows = materialise(geo.clean(spark, sf).select("profundidad_media", "nspt", "qadm_kg_cm2"),
                       "rows")
    root = new_path(spark, "models")
    for preset, names in ((config.NSPT, ["profundidad_media"]),
                          (config.QADM, ["profundidad_media", "nspt"])):
        part = rows.select(*names, F.col(preset.target).alias("label")).na.drop()
        model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"),
                                 linear.estimator("Linear", None)]).fit(part)
        artifacts.save_artifacts(root, preset.name, model,
                                 evaluate.regression_metrics(model.transform(part)), names)
    return root


@query("profile_nspt", CHAIN_SQL + """
select request_id, depth_idx, round(nspt, 5) + 0.0 as NSPT_prediccion from p1""")
def profile_nspt(spark, sf):
    found = artifacts.load_artifacts(spark, models(spark, sf), "nspt")
    out = predict.predict_profile(grid(spark, sf), found.features, config.NSPT_DEFAULTS,
                                  found.model.transform, "NSPT_prediccion",
                                  keep=["request_id", "depth_idx"]).drop("NSPT_prediccion_defaulted")
    return out.withColumn("NSPT_prediccion", F.round("NSPT_prediccion", 5))


@query("profile_chain", CHAIN_SQL + """
select request_id, location, depth_idx, round(profundidad, 9) + 0.0 as profundidad,
  round(nspt, 5) + 0.0 as NSPT_prediccion, round(qadm, 5) + 0.0 as Qadm_prediccion from p2""")
def profile_chain(spark, sf):
    out = plan.predict_requests(spark, requests(spark, sf), models(spark, sf)).profiles
    return out.withColumns({"profundidad": F.round("profundidad", 9),
                            "NSPT_prediccion": F.round("NSPT_prediccion", 5),
                            "Qadm_prediccion": F.round("Qadm_prediccion", 5)})


@query("profile_errors", f"select request_id, location, error from ({PARSED_SQL}) p where error is not null")
def profile_errors(spark, sf):
    """The requests that the job gives no profile for."""
    return plan.predict_requests(spark, requests(spark, sf), models(spark, sf)).errors


# A third model asks for inputs that no request and no default has.
ASKS = ("profundidad_media", "vs_m_s", "potencia")


@query("profile_defaults", "select 'nspt' as target, unnest(['vs_m_s', 'potencia']) as feature from (select count(*) from customer) c "
                           "union all select 'qadm', 'potencia'")
def profile_defaults(spark, sf):
    rows = materialise(geo.clean(spark, sf).select("profundidad_media", "vs_m_s", F.lit(1.0).alias("potencia"), "nspt", "qadm_kg_cm2"), "rows")
    root = new_path(spark, "models")
    for preset in (config.NSPT, config.QADM):
        part = rows.select(*ASKS, F.col(preset.target).alias("label")).na.drop()
        model = Pipeline(stages=[VectorAssembler(inputCols=list(ASKS), outputCol="features"),
                                 linear.estimator("Linear", None)]).fit(part)
        artifacts.save_artifacts(root, preset.name, model, evaluate.regression_metrics(model.transform(part)), list(ASKS))
    return plan.predict_requests(spark, requests(spark, sf), root).defaults


@query("profile_export", CHAIN_SQL + """
select request_id, replace(location, ' ', '_') as location, depth_idx, round(profundidad, 9) + 0.0 as profundidad,
  round(nspt, 5) + 0.0 as NSPT_prediccion, round(qadm, 5) + 0.0 as Qadm_prediccion from p2""")
def profile_export(spark, sf):
    """Both targets for every request, written and read again."""
    path = new_path(spark, "profiles")
    done = plan.export_requests(spark, requests(spark, sf), models(spark, sf), path)
    back = tables.load_table(spark, path, schema=done.profiles.schema, fmt="csv")
    return back.withColumns({"profundidad": F.round("profundidad", 9),
                             "NSPT_prediccion": F.round("NSPT_prediccion", 5),
                             "Qadm_prediccion": F.round("Qadm_prediccion", 5)})
