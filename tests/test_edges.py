"""Rows that an oracle on the sample tables never meets: NaN, empty sides, repeated keys, many classes, whole numbers."""

import math
import re

import pytest
from pyspark.sql import functions as F

from packetloom.operators import evaluation, features, labels, sampling
from packetloom.plans import supervised

NAN, INF = float("nan"), float("inf")


def test_one_nan_does_not_switch_the_outlier_filter_off(spark):
    rows = [(float(i % 10), "local_normal") for i in range(500)] + [(1e6, "local_normal"), (NAN, "local_normal"), (None, "local_attack")]
    kept = sampling.drop_outliers(spark.createDataFrame(rows, "duration double, source_type string"))
    values = [r["duration"] for r in kept.collect()]
    assert len(values) == 502 and 1e6 not in values and None in values and any(v is not None and math.isnan(v) for v in values)


def test_histogram_leaves_out_what_has_no_place(spark):
    rows = [(float(i), i % 2) for i in range(100)] + [(NAN, 0), (INF, 1), (-INF, 0), (None, 1)]
    found = evaluation.score_histogram(spark.createDataFrame(rows, "s double, y int"), "s", bins=10)
    assert found.agg(F.sum("count")).first()[0] == 100 and found.select("bin").distinct().count() == 10


def metrics(spark, rows):
    return spark.createDataFrame(rows, "f1 double, far double")


@pytest.mark.parametrize(
    ("new", "old", "canary", "promoted"),
    [
        ([], [(0.5, 0.1)], None, False),
        ([], [], None, False),
        ([(0.9, 0.1)], [], None, True),
        ([(0.9, 0.1)], [(0.5, 0.1)], [], False),
        ([(0.9, 0.1)], [(0.5, 0.1)], [(0.95, 0.0)], True),
        ([(0.9, 0.1)], [(0.5, 0.1)], None, True),
    ],
)
def test_gate_needs_evidence(spark, new, old, canary, promoted):
    checked = None if canary is None else metrics(spark, canary)
    gate = evaluation.promotion_gate(metrics(spark, new), metrics(spark, old), checked)
    assert gate.first()["promoted"] is promoted


def test_binary_label_of_odd_numbers(spark):
    df = spark.createDataFrame([("2",), ("0",), ("nan",), ("inf",), ("-1",), (None,), ("BENIGN",), ("1.0",)], "label string")
    assert [r["y"] for r in features.with_binary_label(df).collect()] == [1, 0, None, 1, 1, None, 0, 1]


def test_upsert_keeps_one_row_per_key(spark):
    store = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], "flow_id string, label string, at int")
    changes = spark.createDataFrame([("a", "z", 2), ("a", "q", 3), ("c", "n", 1), ("c", "n", 1)], "flow_id string, label string, at int")
    got = {r["flow_id"]: r["label"] for r in labels.upsert(store, changes, order=["at"]).collect()}
    assert got == {"a": "q", "b": "y", "c": "n"} and labels.upsert(store, changes).count() == 3


def test_newest_verdict_counts(spark):
    store = spark.createDataFrame([("a", "x")], "flow_id string, label string").withColumn("label_status", F.lit("UNLABELED"))
    verdicts = spark.createDataFrame(
        [("a", "Zeta", "p", "2024-01-01"), ("a", "Alpha", "q", "2024-01-02")], "flow_id string, new_label string, annotator_id string, t string"
    ).withColumn("verdict_time", F.col("t").cast("timestamp"))
    assert labels.update_labels(store, verdicts, at="now").first()["label"] == "Alpha"
    assert labels.update_labels(store, verdicts.drop("verdict_time"), at="now").first()["label"] == "Zeta"


def test_any_number_of_classes(spark):
    df = spark.range(5000).select((F.col("id") % 2500).cast("string").alias("c"))
    few, many = features.with_label_index(df, "c", limit=3000), features.with_label_index(df, "c", limit=10)
    assert few.exceptAll(many).count() == 0 and many.agg(F.max("y")).first()[0] == 2499
    assert evaluation.class_balance(df, "c").count() == 2500
    assert evaluation.with_class_weight(df, "c").agg(F.sum("weight")).first()[0] == pytest.approx(5000)


def test_whole_numbers_and_wide_columns_reach_the_model(spark):
    rows = spark.range(400).select(
        F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 2 * 5 + F.col("id") % 3).cast("int").alias("hits"),
        (F.col("id") % 7).cast("smallint").alias("ttl"), F.lit(2).cast("decimal(8,2)").alias("price"), F.concat(F.lit("v"), F.col("id") % 40).alias("service"),
    )
    assert features.split_types(rows, ["key", "label"]) == (["hits", "ttl", "price"], ["service"])
    steps = features.fit_preprocessing(rows, exclude=["key", "label"], max_categories=10)
    inputs = features.model_inputs(steps.transform(rows), ["key", "label"])
    assert inputs == ["hits", "ttl", "price", "service_sparse"]
    unseen = steps.transform(rows.limit(1).withColumn("service", F.lit("new"))).first()
    assert unseen["service_sparse"].numNonzeros() == 1
    detector = supervised.fit_detector(rows, ["key"], params={"maxIter": 3, "maxDepth": 2})
    report = {r["class"]: r["f1"] for r in detector.report.collect()}
    assert report["macro avg"] > 0.95


def test_class_label_never_moves_the_large_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("attack"))
        for result in (sampling.stratified_split(df, "attack", ["k"]), sampling.oversample_small_classes(df, "attack", ["k"], 100)):
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and not re.search(r"SortMergeJoin \[attack#\d+\]", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_concurrent_saves_and_pruning(spark, tmp_path):
    from packetloom.schemas import record
    from packetloom.sources.writers import SaveConflict, SnapshotTable

    path = str(tmp_path / "store")
    table = SnapshotTable(spark, path, record(a="int"))
    rows = lambda x: spark.createDataFrame([(x,)], "a int")
    first = table.save(rows(1))
    second = table.save(rows(2), base=first)
    with pytest.raises(SaveConflict):
        table.save(rows(3), base=first)
    # a save that is overtaken while it writes
    other = SnapshotTable(spark, path, record(a="int"))
    seen = iter([[first, second], [first, second, "version-000003-other"]])
    other.versions = lambda: next(seen)
    with pytest.raises(SaveConflict):
        other.save(rows(4))
    third = table.save(rows(5))
    assert table.load().first()["a"] == 5 and table.versions() == [first, second, third]
    assert table.prune(keep=1) == [first, second]
    assert table.versions() == [third] and table.load().first()["a"] == 5
    assert table.save(rows(6)).startswith("version-000004-")


def test_settled_tables_go_with_their_scope(spark, tmp_path):
    from pathlib import Path

    from packetloom.session import scratch, settle, shared_root

    root = Path(shared_root(spark).removeprefix("file:"))
    kept = settle(spark.range(3), "kept")
    before = set(root.iterdir())
    with scratch(spark):
        inner = settle(spark.range(5), "inner")
        with scratch(spark):
            settle(spark.range(7), "innermost")
        assert len(set(root.iterdir()) - before) == 1
        inner.write.parquet(str(tmp_path / "result"))
    assert set(root.iterdir()) == before and kept.count() == 3
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5
