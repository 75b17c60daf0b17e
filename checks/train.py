from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks import geo
from checks.explore import SCORED, rounded, scored
from checks.registry import query, table
from estrato import config
from estrato.operators import evaluate, linear, select, split, svr, trees
from estrato.plans import train as plan
from estrato.session import materialise, new_path
from estrato.sources import artifacts

# --- given result tables -------------------------------------------------------

CV_SQL = """
select l_returnflag as family, l_linenumber as grid_idx, l_suppkey % 5 as fold,
  avg(l_quantity) as mse from lineitem group by 1, 2, 3"""


@query("grid_select", f"""
with m as (select family, grid_idx, avg(mse) as cv_mse from ({CV_SQL}) c group by 1, 2)
select family, grid_idx, round(cv_mse, 6) + 0.0 as cv_mse from (
  select *, row_number() over (partition by family order by cv_mse, grid_idx) as rn from m) r
where rn = 1""")
def grid_select(spark, sf):
    cv = (table(spark, sf, "lineitem")
          .groupBy(F.col("l_returnflag").alias("family"), F.col("l_linenumber").alias("grid_idx"),
                   (F.col("l_suppkey") % 5).alias("fold"))
          .agg(F.avg("l_quantity").alias("mse")))
    return select.best_grid_point(cv).withColumn("cv_mse", F.round("cv_mse", 6))


STAND_INS = {      # a prediction per family; two of them tie
    "RandomForest": "prediction", "GradientBoosting": "prediction * 1.01",
    "Linear": "prediction", "Ridge": "prediction * 0.9", "Lasso": "0 * prediction + 50000", "SVR": "prediction * 0.8",
}
BOARD_SQL = " union all ".join(
    f"select '{family}' as family, {i} as family_order, "
    f"round(1 - sum((label - p) * (label - p)) / (var_pop(label) * count(label)), 6) + 0.0 as train_r2 "
    f"from (select label, {e} as p from ({SCORED}) s) s"
    for i, (family, e) in enumerate(STAND_INS.items()))


def _board(spark, sf):
    rows = scored(spark, sf).withColumns({f: F.expr(e) for f, e in STAND_INS.items()})
    m = evaluate.compare_predictions(rows, {f: f for f in STAND_INS})
    order = F.array_position(F.lit(list(STAND_INS)), F.col("name")) - 1
    return m.select(F.col("name").alias("family"), order.cast("int").alias("family_order"),
                    F.round("r2", 6).alias("train_r2"))


@query("model_leaderboard", BOARD_SQL)
def model_leaderboard(spark, sf):
    return _board(spark, sf)


@query("model_select", f"select * from ({BOARD_SQL}) b order by train_r2 desc, family_order limit 1")
def model_select(spark, sf):
    return select.choose_family(_board(spark, sf))


# --- fits with a closed form ---------------------------------------------------

XY_SQL = (f"select sample_id, profundidad_media as x, qadm_kg_cm2 as y from ({geo.CLEAN_SQL}) c "
          "where qadm_kg_cm2 is not null")
ALPHAS = (0.1, 1.0, 10.0)


def _xy(spark, sf):
    rows = geo.clean(spark, sf).filter("qadm_kg_cm2 is not null").selectExpr(
        "sample_id", "profundidad_media as x", "qadm_kg_cm2 as label")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


def _fitted(spark, sf, family, alphas):
    rows = materialise(_xy(spark, sf).select("features", "label", F.lit(0).alias("fold")), "xy")
    gram = linear.total_gram(linear.grams_by_fold(rows))
    out = []
    for a in alphas:
        m = linear.estimator(family, gram, a).fit(rows)
        out.append((a, round(float(m.coefficients[0]), 5), round(m.intercept, 4)))
    return spark.createDataFrame(out, "alpha double, slope double, intercept double")


SUMS = ("select count(*) as n, avg(x) as mx, avg(y) as my, covar_pop(x, y) * count(*) as sxy, "
        "var_pop(x) * count(*) as sxx from xy")


def _closed(slope: str) -> str:
    alphas = ", ".join(f"(cast({a} as double))" for a in ALPHAS)
    return (f"with xy as ({XY_SQL}), s as ({SUMS}), w as (select a, mx, my, {slope} as w from s, "
            f"(values {alphas}) t(a)) select a as alpha, round(w, 5) + 0.0 as slope, "
            "round(my - w * mx, 4) + 0.0 as intercept from w")


@query("fit_linear", f"select cast(0 as double) as alpha, round(regr_slope(y, x), 5) + 0.0 as slope, "
                     f"round(regr_intercept(y, x), 4) + 0.0 as intercept from ({XY_SQL}) xy")
def fit_linear(spark, sf):
    return _fitted(spark, sf, "Linear", [0.0])


@query("fit_ridge", _closed("sxy / (sxx + a)"))
def fit_ridge(spark, sf):
    return _fitted(spark, sf, "Ridge", ALPHAS)


@query("fit_lasso", _closed("sign(sxy) * greatest(abs(sxy) / n - a, 0) / (sxx / n)"))
def fit_lasso(spark, sf):
    return _fitted(spark, sf, "Lasso", ALPHAS)


# --- two features ---------------------------------------------------------------

TWO_SQL = (f"select profundidad_media as x, nspt as z, qadm_kg_cm2 as y from ({geo.CLEAN_SQL}) c "
           "where qadm_kg_cm2 is not null and nspt is not null")
TWO_SUMS = ("select count(*) as n, avg(x) as mx, avg(z) as mz, avg(y) as my, var_pop(x) as xx, var_pop(z) as zz, "
            "covar_pop(x, z) as xz, covar_pop(x, y) as xy, covar_pop(z, y) as zy, var_pop(y) as yy from d")
_ALPHAS = ", ".join(f"(cast({a} as double))" for a in ALPHAS)


def _two(spark, sf, family):
    rows = geo.clean(spark, sf).filter("qadm_kg_cm2 is not null and nspt is not null").selectExpr(
        "profundidad_media as x", "nspt as z", "qadm_kg_cm2 as label", "0 as fold")
    rows = materialise(VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows), "xz")
    gram = linear.total_gram(linear.grams_by_fold(rows))
    out = []
    for a in ALPHAS:
        m = linear.estimator(family, gram, a).fit(rows)
        out.append((a, *(round(float(w), 4) + 0.0 for w in m.coefficients), round(m.intercept, 3)))
    return spark.createDataFrame(out, "alpha double, slope_x double, slope_z double, intercept double")


@query("fit_ridge_two", f"""
with d as ({TWO_SQL}), s as ({TWO_SUMS}),
w as (select a, mx, mz, my, ((zz + a / n) * xy - xz * zy) / ((xx + a / n) * (zz + a / n) - xz * xz) as wx,
  ((xx + a / n) * zy - xz * xy) / ((xx + a / n) * (zz + a / n) - xz * xz) as wz from s, (values {_ALPHAS}) t(a))
select a as alpha, round(wx, 4) + 0.0 as slope_x, round(wz, 4) + 0.0 as slope_z,
  round(my - wx * mx - wz * mz, 3) + 0.0 as intercept from w""")
def fit_ridge_two(spark, sf):
    return _two(spark, sf, "Ridge")


@query("fit_lasso_two", f"""
with d as ({TWO_SQL}), s as ({TWO_SUMS}), sa as (select * from s, (values {_ALPHAS}) t(a)),
c as (  -- the optimum is the best of: one slope alone, and both with given signs
  select sa.*, sign(xy) * greatest(abs(xy) - a, 0) / xx as wx, cast(0 as double) as wz from sa
  union all select sa.*, 0, sign(zy) * greatest(abs(zy) - a, 0) / zz from sa
  union all select sa.*, (zz * (xy - a * sx) - xz * (zy - a * sz)) / (xx * zz - xz * xz),
    (xx * (zy - a * sz) - xz * (xy - a * sx)) / (xx * zz - xz * xz)
  from sa, (values (1, 1), (1, -1), (-1, 1), (-1, -1)) t(sx, sz)),
o as (select *, row_number() over (partition by a order by (yy - 2 * wx * xy - 2 * wz * zy + wx * wx * xx
    + 2 * wx * wz * xz + wz * wz * zz) / 2 + a * (abs(wx) + abs(wz))) as rn from c)
select a as alpha, round(wx, 4) + 0.0 as slope_x, round(wz, 4) + 0.0 as slope_z,
  round(my - wx * mx - wz * mz, 3) + 0.0 as intercept from o where rn = 1""")
def fit_lasso_two(spark, sf):
    return _two(spark, sf, "Lasso")


CV_CLOSED = f"""
with xy as (select *, ntile(5) over (order by md5('42:' || cast(sample_id as string))) - 1 as fold
            from ({XY_SQL}) d),
k as (select distinct fold as k from xy),
s as (select k, count(*) as n, avg(x) as mx, avg(y) as my, covar_pop(x, y) * count(*) as sxy,
        var_pop(x) * count(*) as sxx from xy join k on fold <> k group by k),
w as (
  select 'Linear' as family, 0 as grid_idx, k, mx, my, sxy / sxx as w from s union all
  select 'Ridge', i, k, mx, my, sxy / (sxx + a) from s, (values (0, 0.1), (1, 1.0), (2, 10.0)) t(i, a)
  union all
  select 'Lasso', i, k, mx, my, sign(sxy) * greatest(abs(sxy) / n - a, 0) / (sxx / n)
  from s, (values (0, 0.1), (1, 1.0), (2, 10.0)) t(i, a))
select family, grid_idx, k as fold,
  round(avg(pow(y - (my - w * mx) - w * x, 2)), 4) + 0.0 as mse
from w join xy on fold = k group by family, grid_idx, k"""


@query("grid_search_linear", CV_CLOSED)
def grid_search_linear(spark, sf):
    """All folds and penalties of three families from one scan."""
    rows = split.assign_folds(materialise(_xy(spark, sf), "xy"), ["sample_id"])
    grams = linear.grams_by_fold(rows)
    out = [(r["family"], r["grid_idx"], int(r["fold"]), round(r["mse"], 4))
           for family in ("Linear", "Ridge", "Lasso")
           for r in linear.cross_validate(grams, family, select.grid_points(config.PARAM_GRIDS[family]))]
    return spark.createDataFrame(out, "family string, grid_idx int, fold int, mse double")


# --- support vectors: one slope without an intercept, where the optimum is a crossing of known lines ---

COSTS, TUBE = (1e-5, 1e-4, 1.0), 5.0


@query("fit_svr", f"""
with xy as ({XY_SQL}), c as (select c from (values {", ".join(f"(cast({c} as double))" for c in COSTS)}) t(c)),
-- The loss is half of w squared and C times what each error exceeds the tube by: its slope is w less C times
-- the sum of x, and C times x more at each of (y - tube) / x and (y + tube) / x.
b as (select (y - {TUBE}) / x as v, x from xy union all select (y + {TUBE}) / x, x from xy),
k as (select v, sum(x) as x from b group by v),
r as (select v, sum(x) over (order by v) as held, lag(v) over (order by v) as low, (select sum(x) from xy) as whole, x from k),
w as (select c, least(greatest(c * (whole - (held - x)), coalesce(low, -1e300)), v) as w, row_number() over (partition by c order by v) as n
  from r, c where v + c * (held - whole) >= 0)
select c as cost, round(w, 4) + 0.0 as slope from w where n = 1""")
def fit_svr(spark, sf):
    rows = materialise(_xy(spark, sf).select("features", "label"), "xy-svr")
    solver = svr.Solver(rows, None, kernel="linear", epsilon=TUBE, intercept=False)
    done = solver.fit([svr.Problem(c, 1.0, None) for c in COSTS], rounding=1e-7, gain=1e-13)
    return spark.createDataFrame([(p.c, round(float(p.weights[0]), 4)) for p in done], "cost double, slope double")


# --- stored models ---------------------------------------------------------------

PREDICT_SQL = f"""
with xy as ({XY_SQL}), f as (select regr_slope(y, x) as w, regr_intercept(y, x) as b from xy)
select sample_id, round(b + w * x, 4) + 0.0 as prediction from xy, f"""


_models: dict[tuple[str, str], tuple[str, object]] = {}


def _saved(spark, sf):
    """Train and store once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        _models[key] = _fit_and_save(spark, sf)
    return _models[key]


def _fit_and_save(spark, sf):
    rows = materialise(_xy(spark, sf).drop("features"), "xy")
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"),
              linear.estimator("Linear", None)]
    model = Pipeline(stages=stages).fit(rows)
    root = new_path(spark, "models")
    metrics = evaluate.regression_metrics(model.transform(rows))
    artifacts.save_artifacts(root, "qadm", model, metrics, ["x"])
    return root, rows


@query("model_persist", PREDICT_SQL)
def model_persist(spark, sf):
    root, rows = _saved(spark, sf)
    model = PipelineModel.load(f"{root}/modelo_qadm")
    return model.transform(rows).select("sample_id", F.round("prediction", 4).alias("prediction"))


@query("score_batch", PREDICT_SQL)
def score_batch(spark, sf):
    root, rows = _saved(spark, sf)
    found = artifacts.load_artifacts(spark, root, "qadm")
    return (found.model.transform(rows.select("sample_id", *found.features))
            .select("sample_id", F.round("prediction", 4).alias("prediction")))


@query("metrics_roundtrip",
       "select round(avg(e * e), 4) + 0.0 as mse, round(sqrt(avg(e * e)), 4) + 0.0 as rmse, "
       "round(avg(abs(e)), 4) + 0.0 as mae, "
       "round(1 - sum(e * e) / (var_pop(label) * count(label)), 6) + 0.0 as r2, "
       "'l_quantity,l_tax' as features "
       f"from (select *, label - prediction as e from ({SCORED}) s) s")
def metrics_roundtrip(spark, sf):
    root = new_path(spark, "metrics")
    frame = artifacts.metrics_frame(evaluate.regression_metrics(scored(spark, sf)),
                                    ["l_quantity", "l_tax"])
    artifacts.write_metrics(frame, root, "nspt")
    back = artifacts.read_metrics(spark, root, "nspt")
    return rounded(back.withColumn("features", F.concat_ws(",", "features")), "features")


# --- trees: deep enough, without drawing rows, they predict the mean of each value ------

FULL_DEPTH = {"bootstrap": False, "max_bins": 256}
MEANS = f"select x, round(avg(y), 4) + 0.0 as prediction, count(*) as n from ({XY_SQL}) xy group by x"


def _by_value(spark, sf, family, params):
    rows = materialise(_xy(spark, sf).select("x", "features", "label"), "xy")
    scored_ = trees.estimator(family, params).fit(rows).transform(rows)
    return scored_.groupBy("x").agg(F.round(F.avg("prediction"), 4).alias("prediction"), F.count("*").alias("n"))


@query("fit_random_forest", MEANS)
def fit_random_forest(spark, sf):
    return _by_value(spark, sf, "RandomForest", {"n_estimators": 3, "max_depth": None, **FULL_DEPTH})


@query("fit_gbt", MEANS)
def fit_gbt(spark, sf):
    """The first tree counts in full, and leaves nothing to the second."""
    return _by_value(spark, sf, "GradientBoosting", {"n_estimators": 2, "max_depth": 20, "max_bins": 256})


@query("feature_importance", "select 'x' as feature, cast(count(distinct x) > 1 as int) * 1.0::double as importance "
                             f"from ({XY_SQL}) xy union all select 'k', 0.0")
def feature_importance(spark, sf):
    """A feature that tells all and a constant one."""
    rows = VectorAssembler(inputCols=["x", "k"], outputCol="both").transform(
        _xy(spark, sf).withColumn("k", F.lit(1.0)))
    model = trees.estimator("RandomForest", {"n_estimators": 3, "max_depth": 6}, features="both").fit(
        materialise(rows.select("both", "label"), "xk"))
    return evaluate.feature_importance(spark, model, ["x", "k"])


#: Every axis of the full grids, with few trees: the values do not change the result.
AXES = {
    "RandomForest": {"n_estimators": [1, 2], "max_depth": [None, 10, 30], "min_samples_split": [2, 3], "bootstrap": [False]},
    "GradientBoosting": {"n_estimators": [1, 2, 3], "learning_rate": [0.1, 0.2], "max_depth": [5, 7]},
}
POINTS = {family: len(select.grid_points(grid)) for family, grid in AXES.items()}


@query("grid_search_trees", f"""
with xy as (select sample_id, sample_id % 5 as x, y,
    ntile(5) over (order by md5('42:' || cast(sample_id as string))) - 1 as fold from ({XY_SQL}) d),
m as (select a.fold, a.x, sum(b.s) / sum(b.n) as mean
  from (select distinct fold, x from xy) a
  join (select fold, x, sum(y) as s, count(*) as n from xy group by fold, x) b on b.x = a.x and b.fold <> a.fold
  group by a.fold, a.x),
e as (select xy.fold, avg(pow(y - mean, 2)) as mse from xy join m on m.fold = xy.fold and m.x = xy.x group by xy.fold)
select family, cast(i as int) as grid_idx, cast(fold as int) as fold, round(mse, 4) + 0.0 as mse
from e, (select 'RandomForest' as family, unnest(range({POINTS['RandomForest']})) as i
  union all select 'GradientBoosting', unnest(range({POINTS['GradientBoosting']}))) g""")
def grid_search_trees(spark, sf):
    rows = _xy(spark, sf).select("sample_id", (F.col("sample_id") % 5).cast("double").alias("v"), "label")
    rows = VectorAssembler(inputCols=["v"], outputCol="features").transform(rows)
    folds = materialise(split.assign_folds(materialise(rows, "v"), ["sample_id"]), "v-folds")
    out = []
    for family, grid in AXES.items():
        out += trees.cross_validate(folds, family, select.grid_points(grid), parallelism=4)
    return plan.cv_frame(spark, out).select("family", "grid_idx", "fold", F.round("mse", 4).alias("mse"))


# --- whole runs ------------------------------------------------------------------------

#: A target that a line meets exactly, and too many values of it for shallow trees.
LINE = "3 * profundidad_media + 10"
SHALLOW = {**config.PARAM_GRIDS,
           "RandomForest": {"n_estimators": [1, 2], "max_depth": [2, 3], "min_samples_split": [2, 10]},
           "GradientBoosting": {"n_estimators": [1, 2], "learning_rate": [0.1, 0.2], "max_depth": [1, 2]},
           "SVR": {"C": [0.1, 1], "gamma": ["scale"]}}
RUN_SQL = f"""
with n as (select count(*) as n from ({geo.CLEAN_SQL}) c)
select family, cast(position as int) as family_order, family = 'Linear' as chosen,
  cast(ceil(n * 0.25) as bigint) as test_rows, cast(0 as double) as test_mse
from n, (values {", ".join(f"('{f}', {i})" for i, f in enumerate(config.FAMILIES))}) t(family, position)"""


def _run(spark, sf, select_by):
    rows = geo.clean(spark, sf).withColumn("qadm_kg_cm2", F.expr(LINE))
    done = plan.train_target(rows, config.QADM, ["sample_id"], grids=SHALLOW, select_by=select_by,
                             parallelism=4, save_to=new_path(spark, "models"))
    metrics = done.metrics.select(F.col("n").alias("test_rows"), (F.round("mse", 6) + 0.0).alias("test_mse"))
    board = done.search.leaderboard(spark).select("family", "family_order", (F.col("family") == done.best.family).alias("chosen"))
    return board.crossJoin(metrics)


@query("train_target", RUN_SQL)
def train_target(spark, sf):
    """The whole run: guards, split, preprocessing, search, refit, evaluation, storage."""
    return _run(spark, sf, "train")


@query("model_select_cv", RUN_SQL)
def model_select_cv(spark, sf):
    """The same, chosen by cross-validated error, families without a grid included."""
    return _run(spark, sf, "cv")
