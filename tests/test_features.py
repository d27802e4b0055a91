import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from packetloom.functions import columns as c
from packetloom.operators import features


def test_extractor_replaces_length(spark):
    df = spark.createDataFrame([(1, "1.1.1.1", "TCP", 100)], "timestamp bigint, src_ip string, protocol string, length bigint")
    model = features.PacketFeatures().fit(df)
    got = model.transform(df)
    assert "length" not in got.columns and got.first()["length_log"] == pytest.approx(np.log(101))
    assert model.mean_length == {"TCP": 100.0}


def test_scaler(spark):
    df = spark.createDataFrame([(1,), (0,), (1,)], "length_log bigint")
    got = features.NumericScaler(inputCols=["length_log"]).fit(df).transform(df).toPandas()
    assert got.shape == (3, 1) and abs(got["length_log"].mean()) < 1e-9 and got["length_log"].std(ddof=0) == pytest.approx(1)


def test_scaler_imputes_the_median_and_survives_constants(spark):
    x = [5.0, 1.0, None, float("nan"), 2.0]
    df = spark.createDataFrame([(v, 3.0, None) for v in x], "x double, same double, nothing double")
    got = features.NumericScaler(inputCols=["x", "same", "nothing"]).fit(df).transform(df).toPandas()
    filled = np.array([5.0, 1.0, 2.0, 2.0, 2.0])
    assert got["x"].tolist() == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert got["same"].tolist() == [0.0] * 5 and got["nothing"].tolist() == [0.0] * 5


def test_encoder_unknown_and_missing(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "kind string")
    model = features.CategoryEncoder(inputCols=["kind"]).fit(train)
    assert model.output_names == ["kind_a", "kind_b", "kind_missing"]
    got = model.transform(spark.createDataFrame([("a",), ("zzz",), (None,)], "kind string"))
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 1)]


def test_encoder_refuses_wide_columns(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("kind"))
    with pytest.raises(ValueError):
        features.CategoryEncoder(inputCols=["kind"], maxCategories=29).fit(df)
    assert features.sparse_categories(df, "kind", ["kind"]).count() == 30


def test_fitted_steps_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([(100, 1.5, "TCP"), (50, None, "UDP")], "length bigint, x double, protocol string")
    model = features.fit_preprocessing(df)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).collect() == model.transform(df).collect()


def test_selection_and_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, 4)], "a int, `id.resp_p` double, s string, label int, _row int")
    assert features.numeric_feature_names(df) == ["a", "id.resp_p", "_row"]
    assert features.anomaly_feature_names(df) == ["a", "id.resp_p"]
    assert features.align_columns(df, ["z", "id.resp_p"]).first().asDict() == {"z": 0.0, "id.resp_p": 2.0}
    with pytest.raises(ValueError):
        features.strict_select(df, ["z"])
    assert features.drop_leakage(spark.createDataFrame([(1, 2)], "ts int, a int")).columns == ["a"]


def test_labels(spark):
    df = spark.createDataFrame([("Normal",), ("BENIGN",), ("DoS",), (None,), ("0",), ("1",)], "attack_type string")
    assert [r["y"] for r in features.with_binary_label(df).collect()] == [0, 0, 1, None, 0, 1]
    numeric = spark.createDataFrame([(0,), (1,)], "label int")
    assert [r["y"] for r in features.with_binary_label(numeric).collect()] == [0, 1]
    with pytest.raises(ValueError):
        features.require_classes(numeric.where("label = 1"), "label")
    with pytest.raises(ValueError):
        features.with_binary_label(spark.range(1))


def test_column_functions(spark):
    row = spark.createDataFrame([(6, "SAF", float("inf"), "1704067200.5", "junk", "2024-01-02 03:04:05")],
                                "p int, f string, x double, a string, b string, d string")
    got = row.select(
        c.protocol_name(F.col("p")).alias("name"),
        c.protocol_name(F.lit(99)).alias("other"),
        c.protocol_name(F.lit(99), None).alias("number"),
        c.flag_names(F.col("f")).alias("flags"),
        c.finite_or_zero(F.col("x")).alias("x"),
        c.event_time(F.col("a")).cast("string").alias("a"),
        c.event_time(F.col("b")).alias("b"),
        c.event_time(F.col("d")).cast("string").alias("d"),
        c.ratio_or_zero(F.lit(1), F.lit(0)).alias("r"),
    ).first()
    assert got.asDict() == {
        "name": "TCP", "other": "OTHER", "number": "99", "flags": ["SYN", "ACK", "FIN"], "x": 0.0,
        "a": "2024-01-01 00:00:00.5", "b": None, "d": "2024-01-02 03:04:05", "r": 0.0,
    }


def test_many_protocols_are_not_cut(spark):
    rows = spark.range(2500).selectExpr("concat('p', id) AS protocol", "cast(id AS int) AS length")
    model = features.PacketFeatures().fit(rows)
    with pytest.raises(ValueError):
        model.mean_length
    assert features.mean_lengths(rows).count() == 2500
    assert "length_log" in model.transform(rows).columns


def test_hot_class_among_many_gets_its_number(spark):
    rows = spark.range(60_000).selectExpr("concat('c', CASE WHEN id % 3 = 0 THEN 7 ELSE id END) AS c", "id").unionByName(
        spark.range(5).selectExpr("cast(NULL AS string) AS c", "id")
    )
    names = sorted(r["c"] for r in rows.where("c IS NOT NULL").select("c").distinct().collect())
    got = {(r["c"], r["y"]) for r in features.with_label_index(rows, "c", limit=10).select("c", "y").distinct().collect()}
    assert got == {(n, i) for i, n in enumerate(names)} | {(None, None)}
    assert features.with_label_index(rows, "c", limit=10).count() == 60_005
