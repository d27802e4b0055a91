import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from packetloom.operators import evaluation, explain, features, isolation, learners
from packetloom.plans import detection, retraining

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3))
    pdf = pd.DataFrame(x, columns=FEATURES)
    pdf["y"] = (2 * pdf["a"] + pdf["b"] > 0.5).astype(int)
    pdf["id"] = np.arange(len(pdf)).astype(str)
    return spark.createDataFrame(pdf).repartition(4).cache()


@pytest.fixture(scope="module")
def small_model(data):
    return learners.train("wide", data, FEATURES, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3})


def test_ensemble_separates(spark, data):
    params = {"deep": {"maxIter": 4, "maxDepth": 4}, "wide": {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3}}
    models, report = learners.train_ensemble(data, data, FEATURES, params)
    rows = {r["Model"]: r for r in report.collect()}
    assert set(rows) == {"deep", "wide", "Ensemble"} and rows["Ensemble"]["F1_Score"] > 0.9
    assert learners.feature_importance(models[0], spark, 1).first()["feature"] == "a"
    scored = models[0].with_probability(data, "p")
    assert evaluation.roc_auc(scored, "p").first()["auc"] > 0.95


def test_multiclass(spark, data):
    three = data.withColumn("y", F.when(F.col("a") < -0.5, 0).when(F.col("a") < 0.5, 1).otherwise(2))
    model = learners.train("wide", three, FEATURES, {"maxIter": 2, "maxDepth": 3}, task="multiclass")
    assert learners.evaluate(model, three, "multiclass").first()["F1_Score"] > 0.9


def test_search(data):
    model, params, f1 = learners.tune(data, FEATURES, {"maxIter": (2, 4), "maxDepth": (2, 3)}, trials=2)
    assert 2 <= params["maxIter"] <= 4 and f1 > 0.8 and model.features == FEATURES


def test_selection(data):
    assert learners.select_features(data, FEATURES, 2, params={"numTrees": 10}) == ["a", "b"]


def test_batch_scoring_keeps_all_rows(data, small_model):
    scored = learners.score_batch(small_model, data.select("id", *FEATURES))
    assert scored.count() == 900 and scored.agg(F.min("confidence")).first()[0] >= 0.5
    with pytest.raises(ValueError):
        small_model.transform(data.drop("a"))


def test_isolation_forest(spark, data, tmp_path):
    odd = spark.createDataFrame([("odd", 9.0, -9.0, 9.0)], "id string, a double, b double, c double")
    forest = isolation.fit_forest(data, FEATURES, ["id"], contamination=0.01)
    scored = forest.score(data.select("id", *FEATURES).unionByName(odd))
    lowest = scored.orderBy("anomaly_score").first()
    assert lowest["id"] == "odd" and lowest["anomaly_score"] < 0
    below = scored.where("id <> 'odd' and anomaly_score < 0").count()
    assert 5 <= below <= 13
    forest.save(spark, str(tmp_path / "forest"))
    again = isolation.Forest.load(spark, str(tmp_path / "forest")).score(odd).first()["anomaly_score"]
    assert again == pytest.approx(lowest["anomaly_score"])


@pytest.mark.parametrize("rows", [100, 3000, 50_000])
def test_every_tree_draws_its_own_rows_at_any_size(spark, rows):
    table = spark.range(rows).select(F.col("id").cast("string").alias("id"), (F.col("id") % 97).cast("double").alias("a"))
    drawn = isolation._tree_rows(table, ["id"], rows, trees=10, sample_size=64, salt="s").cache()
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {64}
    assert drawn.select("tree", "id").distinct().count() == 640
    assert drawn.select("id").distinct().count() < 640 or rows > 3000


def test_average_path():
    assert isolation.average_path(1) == 0 and isolation.average_path(2) == 1
    assert float(isolation.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_shapley_sums_to_the_difference(data, small_model):
    rows = explain.take_by_hash(data, ["id"], 10)
    background = data.limit(1)
    score = lambda df: small_model.with_probability(df, "score")
    got = explain.sampled_shapley(rows, "id", FEATURES, background, score, permutations=5)
    total = {r["id"]: r["s"] for r in got.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    base = score(background).first()["score"]
    for r in score(rows).collect():
        assert total[r["id"]] == pytest.approx(r["score"] - base, abs=1e-9)


def test_shapley_of_a_linear_model_is_exact(data):
    weights = {"a": 2.0, "b": -1.0, "c": 0.0}
    rows, background = data.limit(5), data.limit(1)
    linear = lambda df: df.withColumn("score", 2 * F.col("a") - F.col("b"))
    sampled = explain.sampled_shapley(rows, "id", FEATURES, background, linear, permutations=3)
    means = {f: background.first()[f] for f in FEATURES}
    exact = explain.unnest(explain.linear_attribution(rows, "id", weights, means), "id")
    left = {(r["id"], r["feature"]): r["attribution"] for r in sampled.collect()}
    for r in exact.collect():
        assert left[r["id"], r["feature"]] == pytest.approx(r["attribution"], abs=1e-9)
    nested = explain.nest(sampled, "id")
    assert explain.top_features(nested, "id", 2).count() == 10


def test_explanation_texts(spark):
    df = spark.createDataFrame([("r", 3.0, 1.0)], "id string, a double, b double")
    nested = explain.linear_attribution(df, "id", {"a": 1.0, "b": 2.0}, {"a": 1.0, "b": 1.5})
    row = explain.local_explanations(nested, "id", 0.25).first()
    assert row["explanation_text"] == "Base risk was 0.25. a (Risk Increase) b (Risk Decrease)"
    assert row["top_features"][1]["impact_direction"] == "Risk Decrease" and row["top_features"][0]["abs_impact"] == 2.0
    document = explain.explanation_documents(nested, "id").first()["top_features"]
    assert [(e["feature"], e["impact"]) for e in document] == [("a", "Positive"), ("b", "Negative")]
    classes = spark.createDataFrame([("r", "a", 1.0, -2.0, 0), ("r", "a", 1.0, 1.0, 1)], "id string, feature string, value double, attribution double, class int")
    assert explain.combine_classes(classes, "id").first()["attribution"] == 3.0


def test_background_bound(data):
    with pytest.raises(ValueError):
        explain.sampled_shapley(data, "id", FEATURES, data.limit(0), lambda df: df)


def test_retraining(spark, data):
    def part(low, high):
        return data.where((F.col("id").cast("int") >= low) & (F.col("id").cast("int") < high)).withColumn(
            "attack_type", F.when(F.col("y") == 1, "dos").otherwise("normal")
        ).drop("y").withColumn("__timestamp", F.lit(0.0))

    champion = spark.createDataFrame([(0.5, 0.5)], "f1 double, far double")
    small = {"deep": {"maxIter": 2, "maxDepth": 3}, "wide": {"maxIter": 2, "maxDepth": 3}, "forest": {"numTrees": 5}}
    result = retraining.retrain(
        part(0, 400), part(400, 600), part(600, 800), data, ["id"], 1000.0, champion, canary=data, top_k=3, params=small,
        max_samples=500,
    )
    assert result.gate.first()["promoted"] is True and result.comparison.count() == 3
    assert result.dataset_report.first()["zero_day_holdout"] is None and result.zero_day is None
    assert result.drift.count() == 0  # none of the monitored columns is there


def test_retraining_judges_the_held_out_class(spark, data):
    from packetloom.plans import retraining

    kind = F.when(F.col("y") == 0, "normal").when(F.crc32("id") % 3 == 0, "worm").otherwise("dos")
    rows = data.withColumn("attack_type", kind).drop("y").withColumn("__timestamp", F.lit(0.0)).withColumn("duration", F.col("a"))
    small = {k: {"maxIter": 2, "maxDepth": 3} for k in ("deep", "wide")} | {"forest": {"numTrees": 5}}
    champion = spark.createDataFrame([], "f1 double, far double")
    result = retraining.retrain(rows, rows, rows, data.withColumn("duration", F.col("a")), ["id"], 1000.0, champion, top_k=3, params=small, max_samples=900)
    assert result.dataset_report.first()["zero_day_holdout"] == "worm"
    judged = result.zero_day.first()
    assert judged["n"] > 0 and 0 <= judged["recall"] <= 1
    assert [r["feature"] for r in result.drift.collect()] == ["duration"]


def test_multiclass_models_vote_and_score(spark):
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("int").alias("y"),
        *[((F.col("id") % 3 == i).cast("double") * 4 + F.rand(i)).alias(f"f{i}") for i in range(3)],
    ).cache()
    names = ["f0", "f1", "f2"]
    params = {k: {"maxIter": 2, "maxDepth": 2} for k in ("deep", "wide")}
    models, report = learners.train_ensemble(rows, rows, names, params, task="multiclass")
    assert {r["Model"] for r in report.where("Accuracy > 0.95").collect()} == {"deep", "wide", "Ensemble"}
    scored = learners.score_batch(models[0], rows)
    assert scored.where("class = y AND confidence BETWEEN 0.33 AND 1").count() > 285
    assert learners.feature_importance(models[0], spark).agg(F.sum("importance")).first()[0] == pytest.approx(1)
    svc = learners.train("svc", rows.where("y < 2"), names)
    with pytest.raises(ValueError):
        learners.feature_importance(svc, spark)
    best, found, f1 = learners.tune(rows, names, {"maxIter": (1, 2), "maxDepth": (2, 3)}, trials=2, task="multiclass", key=["id"])
    assert f1 > 0.9 and best.transform(rows).count() == 300


def test_detection_with_fitted_models(spark, data, small_model):
    forest = isolation.fit_forest(data, FEATURES, ["id"], trees=10)
    score = learners.scorer(small_model, forest.score)
    flows = data.select(
        *FEATURES, F.lit(1.0).alias("timestamp"), F.lit("s").alias("src_ip"), F.lit("d").alias("dst_ip"), F.lit("TCP").alias("protocol")
    )
    alerts = detection.to_alerts(score(flows))
    assert alerts.count() == 900 and alerts.where("alert_level = 'LOW'").count() < 900
    assert detection.to_alerts(score(flows), min_level="HIGH").where("alert_level = 'LOW'").count() == 0


def test_detector_round_trip(spark, tmp_path):
    from packetloom.plans import supervised
    from packetloom.sources import writers

    kind = F.when(F.col("id") % 3 == 0, "UDP").otherwise("TCP")
    packets = spark.range(600).select(
        F.col("id").alias("packet_id"), F.lit("1.1.1.1").alias("src_ip"), kind.alias("protocol"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("S")).alias("flags"), (F.col("id") % 90 + 40).cast("int").alias("length"),
    ).withColumn("label", ((F.col("protocol") == "UDP") & (F.col("length") > 80)).cast("int"))
    detector = supervised.fit_detector(packets, ["packet_id"], params={"maxIter": 3, "maxDepth": 3})
    assert {r["class"]: r["f1"] for r in detector.report.collect()}["1"] > 0.95
    writers.save_fitted(detector.model, str(tmp_path / "detector"))
    requests = packets.drop("label").unionByName(packets.drop("label").limit(1).withColumn("protocol", F.lit("GRE")))
    scored = supervised.predict(writers.load_fitted(str(tmp_path / "detector")), requests)
    assert scored.columns == [*requests.columns, "class", "confidence"] and scored.count() == 601
    assert scored.where("class = 1").count() == packets.where("label = 1").count()


def test_feature_names_may_hold_dots(data):
    dotted = data.withColumnRenamed("a", "id.a")
    model = learners.train("logistic", dotted, ["id.a", "b"])
    assert learners.evaluate(model, dotted).first()["Accuracy"] > 0.95


def test_anomaly_training_finds_odd_rows(spark, data):
    from packetloom.plans import anomaly

    normal = data.select("id", *FEATURES)
    odd = normal.limit(200).select(
        F.concat(F.lit("odd-"), "id").alias("id"), *[(F.col(f) * 0.3 + 6).alias(f) for f in FEATURES]
    )
    mixed = normal.withColumn("label", F.lit(0)).unionByName(odd.withColumn("label", F.lit(1)))
    detector = anomaly.train_and_tune(normal, mixed, ["id"], trees=40)
    assert detector.test.first()["f1"] > 0.9
    assert detector.flag(odd).where("prediction = 1").count() > 180
    forest, threshold = anomaly.retrain_on_normal(normal, ["id"])
    assert abs(threshold) < 0.01 and forest.features == FEATURES


def test_anomaly_training_uses_a_wide_text_column_and_comes_back(spark, data, tmp_path):
    from packetloom.plans import anomaly

    normal = data.select("id", *FEATURES).withColumn("service", F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(1001))))
    assert normal.select("service").distinct().count() > 10
    mixed = normal.withColumn("label", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int"))
    for categories in (5, 100_000):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(anomaly, "fit_preprocessing", lambda df, **options: features.fit_preprocessing(df, max_categories=categories, **options))
            detector = anomaly.train_and_tune(normal, mixed, ["id"], trees=5, sample_size=64)
        used = [f for f in detector.forest.features if f.startswith("service")]
        assert used == ["service_frequency"] if categories == 5 else len(used) > 100
        if categories == 5:
            detector.save(spark, str(tmp_path / "detector"))
            again = anomaly.AnomalyDetector.load(spark, str(tmp_path / "detector"))
            assert again.threshold == detector.threshold and again.forest.features == detector.forest.features
            new = normal.limit(50).withColumn("service", F.lit("never seen"))
            assert detector.flag(new).exceptAll(again.flag(new)).count() == 0
            assert again.test.collect() == detector.test.collect()


def test_retraining_needs_more_than_the_threshold(spark):
    report = spark.createDataFrame([(0.5,)], "final_score double")
    assert retraining.retrain_needed(report) is False
    assert retraining.retrain_needed(report, 0.4) is True
