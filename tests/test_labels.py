from pyspark.sql import functions as F

from packetloom.operators import labels

AT = "2024-01-01T00:00:00"


def store(spark):
    alerts = spark.createDataFrame(
        [("1", "10.0.0.1", 0.0), ("2", "b", 50.0), ("3", "c", 100.0), ("4", "d", 30.0)], "timestamp string, src string, risk_score double"
    )
    return labels.auto_label(labels.import_alerts(alerts), at=AT)


def test_import_ids_are_stable_and_unique(spark):
    first, second = store(spark), store(spark).repartition(3)
    ids = lambda df: sorted(r["flow_id"] for r in df.collect())
    assert ids(first) == ids(second) and len(set(ids(first))) == 4
    assert labels.duplicate_keys(first).count() == 0


def test_import_without_risk(spark):
    df = spark.createDataFrame([("1", "a")], "timestamp string, src string")
    assert labels.import_alerts(df).first()["model_score"] == 0.5


def test_auto_label_writes_the_audit_log(spark):
    rows = {r["timestamp"]: r for r in store(spark).collect()}
    assert (rows["1"]["label"], rows["1"]["label_status"], rows["1"]["annotator_id"]) == ("NORMAL", "PSEUDO_LABELED", "RULE_WHITELIST")
    assert rows["1"]["audit_log"][0].asDict() == {
        "ts": AT, "action": "AUTO_LABEL", "old_label": None, "new_label": "NORMAL", "by": "RULE_WHITELIST"
    }
    assert (rows["2"]["label"], rows["2"]["label_confidence"], rows["2"]["audit_log"]) == (None, 0.0, [])
    assert rows["3"]["label"] == "Attack"


def test_auto_label_keeps_a_foreign_annotator(spark):
    df = spark.createDataFrame([("x", "b", 0.5, "someone")], "flow_id string, src string, model_score double, annotator_id string")
    assert labels.auto_label(df, AT).first()["annotator_id"] == "someone"


def test_human_updates(spark):
    base = store(spark)
    target = base.where("timestamp = '1'").first()["flow_id"]
    updates = spark.createDataFrame([(target, "DoS", "eve"), ("nobody", "DoS", "eve")], "flow_id string, new_label string, annotator_id string")
    got = {r["timestamp"]: r for r in labels.update_labels(base, updates, AT).collect()}
    assert len(got) == 4 and got["2"]["label_status"] == "UNLABELED"
    assert (got["1"]["label"], got["1"]["label_status"], got["1"]["label_confidence"]) == ("DoS", "VERIFIED", 1.0)
    assert [(e["action"], e["old_label"], e["new_label"]) for e in got["1"]["audit_log"]] == [
        ("AUTO_LABEL", None, "NORMAL"), ("MANUAL_UPDATE", "NORMAL", "DoS")
    ]


def test_repeated_verdicts_do_not_multiply_rows(spark):
    base = store(spark)
    target = base.where("timestamp = '2'").first()["flow_id"]
    updates = spark.createDataFrame([(target, "DoS", "a"), (target, "Malware", "b")], "flow_id string, new_label string, annotator_id string")
    got = labels.update_labels(base, updates, AT)
    assert got.count() == 4 and got.where("timestamp = '2'").first()["label"] == "Malware"


def test_update_of_a_store_without_audit_column(spark):
    base = spark.createDataFrame([("a", "NORMAL", "UNLABELED")], "flow_id string, label string, label_status string")
    updates = spark.createDataFrame([("a", "DoS", "eve")], "flow_id string, new_label string, annotator_id string")
    assert len(labels.update_labels(base, updates, AT).first()["audit_log"]) == 1


def test_upsert(spark):
    base = spark.createDataFrame([("a", "x"), ("b", "y")], "flow_id string, label string")
    changes = spark.createDataFrame([("b", "z", 1), ("c", "w", 2)], "flow_id string, label string, extra int")
    got = {r["flow_id"]: r["label"] for r in labels.upsert(base.withColumn("extra", F.lit(0)), changes).collect()}
    assert got == {"a": "x", "b": "z", "c": "w"}


def test_hard_samples_and_marking(spark):
    base = store(spark)
    assert [r["timestamp"] for r in labels.select_hard_samples(base, 1).collect()] == ["2"]
    marked = labels.mark_for_review(base, 2)
    assert marked.count() == 4 and labels.by_status(marked, "HUMAN_REVIEW_NEEDED").count() == 2
    assert labels.review_queue(marked, first=1).count() == 1
    stats = labels.label_stats(marked).first()
    assert (stats["total"], stats["pending_review"]) == (4, 2)


def test_first_per_key_and_audit_text(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, None)], "k string, n int, v string")
    assert {(r["k"], r["v"]) for r in labels.first_per_key(df, ["k"], ["n"]).collect()} == {("a", "early"), ("b", None)}
    text = spark.createDataFrame([('[{"ts": "t", "action": "X", "new_label": "n", "by": "b"}]',)], "log string")
    assert text.select(labels.parse_audit_text(F.col("log")).alias("l")).first()["l"][0]["action"] == "X"
