import json
import pathlib
import random

import pytest

from estrato import __main__ as cli
from estrato import config
from estrato.operators import evaluate, explore, predict, select, split, trees
from estrato.plans import ingest, train
from estrato.plans import predict as predict_plan
from estrato.sources import artifacts, tables
from estrato.sources.requests import parse_requests

HEADER = "Ítem;Norte;Este;De;Hasta;Vs (m/s);Nspt;(N1)60;Gravas;Arenas;Finos;SUCS;Qadm. (kg/cm2);Vp (m/s)"
GRIDS = {"RandomForest": {"n_estimators": [5], "max_depth": [3, 6]},
         "GradientBoosting": {"n_estimators": [3], "max_depth": [3]},
         "Linear": {}, "Ridge": {"alpha": [0.1, 10.0]}, "Lasso": {"alpha": [0.1, 10.0]}}


@pytest.fixture(scope="module")
def work(tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    raw = root / "raw"
    raw.mkdir()
    rng = random.Random(5)
    for site in range(3):
        lines = [HEADER]
        for i in range(120):
            top = i % 30
            nspt = 5 + 2 * top + rng.random()
            lines.append(f"SPT-{i};1;2;{top};{top + 1};{'-' if i % 9 == 0 else 200 + 5 * top};{nspt:.3f};"
                         f"{nspt * 0.8:.3f};{i % 50};{i % 40};10;{['SM', 'CL'][i % 2]};"
                         f"{0.1 * nspt + 0.01 * top:.4f};-")
        (raw / f"Colegio_{site}.csv").write_bytes("\n".join(lines).encode("latin1"))
    (raw / "Malo.csv").write_text("a,b\n1,2\n")
    return root


@pytest.fixture(scope="module")
def cleaned(spark, work):
    return ingest.ingest_directory(spark, f"file:{work}/raw", f"file:{work}/clean",
                                   csv_out=f"file:{work}/csv")


@pytest.fixture(scope="module")
def trained(spark, work, cleaned):
    return train.train_target(cleaned.df, config.NSPT, [ingest.ROW_ID], grids=GRIDS,
                              save_to=f"file:{work}/models")


@pytest.fixture(scope="module")
def models(spark, work, cleaned, trained):
    train.train_target(cleaned.df, config.QADM, [ingest.ROW_ID], families=["Linear", "Ridge"],
                       grids=GRIDS, save_to=f"file:{work}/models")
    return f"file:{work}/models"


def test_ingest(spark, work, cleaned):
    assert cleaned.df.count() == 360 and cleaned.dropped == ["vp_m_s"]
    audit = {r["archivo"]: (r["n_rows"], r["reason"]) for r in cleaned.audit().collect()}
    assert audit[None] == (360, "1")
    stored = tables.load_table(spark, f"file:{work}/clean")
    assert "vp_m_s" not in stored.columns and stored.columns == cleaned.df.columns
    assert audit["Colegio_0.csv"] == (120, None) and audit["Malo.csv"] == (0, "fewer than two columns")
    assert cleaned.df.select(ingest.ROW_ID).distinct().count() == 360
    head = spark.read.csv(f"file:{work}/csv", header=True).columns
    assert "Vs (m/s)" in head and "Qadm. (kg/cm2)" in head and "Vp (m/s)" not in head


def test_missing_table(spark, tmp_path):
    with pytest.raises(tables.MissingTableError):
        tables.load_table(spark, f"file:{tmp_path}/none")


def test_search_and_evaluation(spark, trained):
    done = trained
    board = {r["family"]: r for r in done.search.leaderboard(spark).collect()}
    assert list(board) == list(config.FAMILIES)
    assert all(r["train_r2"] > 0.3 for f, r in board.items() if f != "GradientBoosting")
    assert board["Linear"]["cv_mse"] is not None and board["Linear"]["train_r2"] > 0.98
    assert done.search.cv_frame(spark).count() == 5 * (2 + 1 + 1 + 2 + 2 + 1)
    assert board["RandomForest"]["depth"] in (3, 6) and board["Linear"]["depth"] is None
    top = max(r["train_r2"] for r in board.values())
    assert board[done.best.family]["train_r2"] == top
    by_cv = done.search.best(spark, "cv")
    assert by_cv.cv_mse == min(r["cv_mse"] for r in board.values())
    m = done.metrics.first()
    assert m["n"] == 90 and m["rmse"] == pytest.approx(m["mse"] ** 0.5) and m["r2"] > 0.9
    chosen = {r["family"]: r["grid_idx"] for r in
              select.best_grid_point(done.search.cv_frame(spark)).collect()}
    points = select.grid_points(GRIDS["Ridge"])
    ridge = next(c for c in done.search.candidates if c.family == "Ridge")
    assert points[chosen["Ridge"]] == ridge.params
    weights = {r["feature"]: r["importance"] for r in done.importance().collect()}
    if weights:
        assert sum(weights.values()) == pytest.approx(1) and "sucs" in weights


def test_importance_sums_slots(spark, trained):
    forest = next(c for c in trained.search.candidates if c.family == "RandomForest")
    slots = trained.preprocessor.slots
    weights = {r["feature"]: r["importance"]
               for r in evaluate.feature_importance(spark, forest.model, slots).collect()}
    assert set(weights) == set(trained.preprocessor.numeric + trained.preprocessor.categorical)
    assert sum(weights.values()) == pytest.approx(1)
    linear = next(c for c in trained.search.candidates if c.family == "Linear")
    assert evaluate.feature_importance(spark, linear.model, slots).count() == 0


def test_chained_profiles(spark, work, models):
    requests = spark.createDataFrame(
        [(1, "9457265", "535010", "50"), (2, "", "", ""), (3, "abc", "535010", "30"),
         (4, "1", None, "20"), (5, "1", "2", "x"), (6, " 12.5 ", "1e8", " 7 ")],
        "request_id bigint, north string, east string, max_depth string")
    parsed = {r["request_id"]: r for r in parse_requests(requests).collect()}
    assert parsed[1]["location"] == "Norte 9457265.0 Este 535010.0"
    assert parsed[2]["location"] == config.DEFAULT_LOCATION and parsed[2]["max_depth"] == 50
    assert (parsed[3]["norte"], parsed[4]["este"]) == (config.DEFAULT_NORTH, config.DEFAULT_EAST)
    assert parsed[5]["error"] == "invalid max_depth" and parsed[5]["max_depth"] is None
    assert parsed[6]["location"] == "Norte 12.5 Este 100000000.0"
    done = predict_plan.predict_requests(spark, requests, models)
    assert [tuple(r)[::2] for r in done.errors.collect()] == [(5, "invalid max_depth")]
    assert {tuple(r) for r in done.defaults.collect()} == {("nspt", "vs_m_s")}
    out = done.profiles
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    rows = out.collect()
    assert len(rows) == 500
    for k, depth in ((1, 50.0), (3, 30.0), (6, 7.0)):
        part = sorted((r for r in rows if r["request_id"] == k), key=lambda r: r["depth_idx"])
        assert part[0]["profundidad"] == 0 and part[-1]["profundidad"] == depth
        assert all(r["NSPT_prediccion"] is not None and r["Qadm_prediccion"] is not None for r in part)
    predict_plan.export_requests(spark, requests, models, f"file:{work}/profiles", by_folder=True)
    names = {p.name for p in (work / "profiles").iterdir() if p.is_dir()}
    assert any(n.startswith("location=Norte_9457265.0_Este") for n in names)


def test_one_model_is_enough(spark, models):
    found = artifacts.load_artifacts(spark, models, "qadm")
    assert artifacts.load_artifacts(spark, models, "nope") is None
    requests = parse_requests(spark.createDataFrame(
        [(1, "", "", "")], "request_id bigint, north string, east string, max_depth string"))
    out = predict.predict_chain(predict.profile_grid(requests), None,
                                (found.features, found.model.transform))
    assert out.filter("NSPT_prediccion is null and Qadm_prediccion is not null").count() == 100
    with pytest.raises(ValueError):
        predict.predict_chain(predict.profile_grid(requests), None, None)
    with pytest.raises(FileNotFoundError):
        predict_plan.predict_requests(spark, requests, models + "-none")


def test_metric_file_layout(spark, work, models):
    text = next((work / "models" / "metricas_nspt").glob("part-*.json")).read_text()
    doc = json.loads(text)
    assert list(doc) == ["mse", "rmse", "mae", "r2", "features"]
    assert doc["features"][0] == "profundidad_media"


def test_metrics_of_constant_labels(spark):
    def r2(rows):
        df = spark.createDataFrame(rows, "label double, prediction double")
        return evaluate.regression_metrics(df).first()["r2"]

    assert r2([(1.0, 1.0), (1.0, 1.0)]) == 1.0
    assert r2([(1.0, 2.0), (1.0, 1.0)]) == 0.0
    assert r2([(1.0, 2.0)]) is None


def test_tree_settings():
    deep = trees.estimator("RandomForest", {"max_depth": None, "min_samples_split": 10})
    assert deep.getMaxDepth() == 30 and deep.getMinInstancesPerNode() == 5
    assert len(select.grid_points(config.PARAM_GRIDS["RandomForest"])) == 36
    assert len(select.grid_points(config.PARAM_GRIDS["GradientBoosting"])) == 27


def test_depth_profile_series(spark, cleaned):
    df = cleaned.df
    by_type = explore.profile_summary(explore.depth_profile(df, "vs_m_s")).collect()
    assert [(r["series"], r["points"]) for r in by_type] == [("SPT", df.filter("vs_m_s is not null").count())]
    one = explore.depth_profile(df.drop("tipo_ensayo", "item"), "nspt")
    assert explore.series_count(one).first()["legend"] is False
    made = explore.depth_profile(df.drop("profundidad_media"), "nspt")
    assert made.count() == 360
    with pytest.raises(ValueError):
        explore.depth_profile(df.drop("nspt"), "nspt")


def test_command_line(spark, work, cleaned, capsys):
    root = f"file:{work}"
    cli.main(["inventory", f"{root}/raw", f"{root}/listed"])
    cli.main(["ingest", f"{root}/raw", f"{root}/clean2"])
    cli.main(["train", f"{root}/clean2", f"{root}/models2", "--target", "nspt", "--family", "Linear", "Ridge"])
    (work / "requests.csv").write_text("request_id,north,east,max_depth\n1,1,2,10\n2,,,\n")
    cli.main(["predict", f"{root}/requests.csv", f"{root}/models2", f"{root}/out", "--format", "parquet"])
    cli.main(["explore", f"{root}/clean2", f"{root}/explored"])
    assert spark.read.parquet(f"{root}/out").count() == 200
    shown = capsys.readouterr().out
    assert "files rejected: 1" in shown and "nspt: " in shown
    assert spark.read.parquet(f"{root}/listed").count() == 4
    report = spark.read.parquet(f"{root}/clean2-report")
    assert report.filter("archivo = 'Malo.csv'").first()["reason"] and report.filter("kind = 'total'").first()["n_rows"] == 360
    assert spark.read.parquet(f"{root}/out-errors").count() == 0 and spark.read.parquet(f"{root}/out-defaults").count() > 0
    assert spark.read.parquet(f"{root}/models2/leaderboard_nspt").count() == 2
    assert spark.read.parquet(f"{root}/explored/correlation_square").count() > 3


def test_the_same_files_give_the_same_split(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for site in range(5):
        rows = [f"SPT-{i % 9};{i % 30};{i % 30 + 1};{i * 7 % 50}" for i in range(200)] + ["SPT-1;1;2;3"] * 25
        (raw / f"S_{site}.csv").write_text("Ítem;De;Hasta;Nspt\n" + "\n".join(rows))
    got = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000000", "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = ingest.ingest_directory(spark, f"file:{raw}", f"file:{tmp_path}/clean{size}").df
            assert df.count() == df.select(ingest.ROW_ID).distinct().count() == 1125
            both = split.split_and_folds(df.select(ingest.ROW_ID), [ingest.ROW_ID])
            got.append(sorted(map(tuple, both.collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got[0] == got[1]


def test_many_files_and_headers_are_one_scan(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for k in range(1050):
        (raw / f"S_{k}.csv").write_text(f"Ítem;De;Hasta;extra{k % 40}\nA-{k};0;{k};{k}\nB;1;2;;\n")
    done = ingest.site_files.read_site_files(spark, f"file:{raw}")
    plan = done.table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" text") == 1 and " csv" not in plan
    rows = done.table
    assert rows.count() == 2100 and len(rows.columns) == 4 + 40
    assert done.files.count() == 1050 and done.quarantine().count() == 0
    assert rows.filter("item = 'A-41'").select("extra1", "extra2", "colegio").first() == ("41", None, "S 41")


def test_intermediates_are_released(spark):
    from estrato import session
    kept, spark._estrato_made = getattr(spark, "_estrato_made", []), []
    try:
        frame = session.materialise(spark.range(3), "x")
        path = spark._estrato_made[0].removeprefix("file:")
        assert frame.count() == 3 and pathlib.Path(path).exists() and session.release(spark) == 1
        assert not pathlib.Path(path).exists()
    finally:
        spark._estrato_made = kept


def test_equal_rows_are_numbered_in_bounded_lots(spark, monkeypatch):
    """A row in most of a table: no lot holds more than its share, keys are unique and the same."""
    monkeypatch.setattr(ingest, "LOT_ROWS", 10)
    rows = [("f", "same")] * 700 + [("f", f"own {k}") for k in range(50)] + [("g", "twice")] * 2
    df = spark.createDataFrame(rows, "archivo string, item string").repartition(5)
    keys = [r[0] for r in ingest.add_row_id(df).select(ingest.ROW_ID).collect()]
    assert len(keys) == len(set(keys)) == len(rows)
    assert sorted(keys) == sorted(r[0] for r in ingest.add_row_id(df.repartition(2)).select(ingest.ROW_ID).collect())
    suffixes = sorted(int(k.split("-")[1]) for k in keys if "-" in k)
    assert suffixes == sorted([*range(1, 701), 1, 2])
