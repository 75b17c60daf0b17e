from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from estrato import config
from estrato.operators import features


@pytest.fixture(scope="module")
def soil(spark):
    rows = [(i, float(i % 40), float(i % 7) if i % 5 else None, None, 3.0,
             ["SM", "CL", "ML"][i % 3] if i % 4 else None, f"SPT-{i}", float(i)) for i in range(60)]
    return spark.createDataFrame(
        rows, "id int, de double, vs_m_s double, lp double, gravas double, sucs string, "
              "item string, nspt double").withColumn("hasta", F.col("de") + 2)


def test_feature_frame_derives_and_orders(soil):
    frame = features.feature_frame(soil, config.NSPT, ["id"])
    assert frame.numeric == ["profundidad_media", "vs_m_s", "gravas", "lp"]
    assert frame.categorical == ["sucs", "tipo_ensayo"]
    assert frame.df.columns == ["id", *frame.features, "label"]


@pytest.mark.parametrize("change,reason", [
    (dict(target="absent"), "no target column absent"),
    (dict(numeric=("profundidad_media", "vs_m_s")), "too few numeric features"),
    (dict(required=("profundidad_media", "nspt")), "missing required features: nspt"),
    (dict(target="lp"), "too few rows with a target"),
])
def test_guards(soil, change, reason):
    with pytest.raises(features.InsufficientData, match=reason):
        features.feature_frame(soil, replace(config.NSPT, **change))


def test_no_rows(soil):
    assert features.check_features(soil.limit(0), config.NSPT) == "no rows"


def test_preprocessor(spark, soil):
    frame = features.feature_frame(soil, config.NSPT, ["id"])
    train = frame.df.filter("id < 45")
    pre = features.fit_preprocessor(train, frame.numeric, frame.categorical)
    assert pre.dropped == ["lp"]
    assert pre.levels == {"sucs": ["CL", "ML", "SM"], "tipo_ensayo": ["SPT"]}
    assert pre.slots == ["profundidad_media", "vs_m_s", "gravas", "sucs", "sucs", "sucs", "tipo_ensayo"]
    unseen = frame.df.withColumn("sucs", F.when(F.col("id") == 1, "GW").otherwise(F.col("sucs")))
    out = pre.transform(unseen)
    assert out.columns == [*frame.df.columns, "features"]
    rows = {r["id"]: np.array(r["v"]) for r in
            out.select("id", vector_to_array("features").alias("v")).collect()}
    x = np.array([rows[i] for i in range(45)])
    assert np.allclose(x[:, :3].mean(0), 0) and np.allclose(x[:, :2].std(0), 1)
    assert (x[:, 2] == 0).all()                        # constant column
    assert rows[1][3:6].sum() == 0                     # unseen level
    hot = np.array([rows[i][3:6] for i in range(60) if i != 1])
    assert (hot.sum(1) == 1).all()


def test_saved_preprocessor_needs_no_package(spark, soil, tmp_path):
    from pyspark.ml import PipelineModel

    frame = features.feature_frame(soil, config.NSPT, ["id"])
    pre = features.fit_preprocessor(frame.df, frame.numeric, frame.categorical)
    pre.model.write().overwrite().save(f"file:{tmp_path}/pre")
    back = PipelineModel.load(f"file:{tmp_path}/pre")
    assert back.transform(frame.df).orderBy("id").collect() == pre.transform(frame.df).orderBy("id").collect()
    for stage in back.stages:
        assert type(stage).__module__.startswith("pyspark.")


def test_no_categorical_feature(soil):
    frame = features.feature_frame(soil.drop("sucs", "item"), config.NSPT, ["id"])
    pre = features.fit_preprocessor(frame.df, frame.numeric, [])
    assert pre.slots == ["profundidad_media", "vs_m_s", "gravas"]


def test_quotes_in_levels(spark):
    df = spark.createDataFrame([("it's", 1.0), ("a\\b", 2.0), ("it's", 3.0), (None, 4.0)],
                               "`odd ``name` string, x double")
    pre = features.fit_preprocessor(df, ["x"], ["odd `name"])
    assert pre.levels == {"odd `name": ["a\\b", "it's"]}
    v = [r[0] for r in pre.transform(df).select(vector_to_array("features")).collect()]
    assert [x[1:] for x in v] == [[0, 1], [1, 0], [0, 1], [0, 1]]


def test_a_category_with_too_many_levels_is_left_out(spark):
    df = spark.createDataFrame([(float(i), f"v{i}", "ab"[i % 2]) for i in range(30)], "x double, wide string, narrow string")
    pre = features.fit_preprocessor(df, ["x"], ["wide", "narrow"], max_levels=20)
    assert pre.categorical == ["narrow"] and pre.dropped == ["wide"] and pre.slots == ["x", "narrow", "narrow"]


def test_category_of_any_width_is_kept(spark):
    df = spark.range(100_001).selectExpr("cast(id as double) as x", "concat('v', id) as wide")
    pre = features.fit_preprocessor(df, ["x"], ["wide"])
    assert pre.categorical == ["wide"] and pre.dropped == [] and len(pre.slots) == 100_002
    row = pre.transform(df.where("wide = 'v100000'")).first()
    assert row["features"].size == 100_002 and row["features"][1 + pre.levels["wide"].index("v100000")] == 1.0
