import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.operators import labels
from packetloom.schemas import LABEL_ROW, record
from packetloom.session import names_in, shared_path
from packetloom.sources.buckets import BucketTable
from packetloom.sources.writers import SaveConflict

SCHEMA = T.StructType(record(flow_id="string", x="int").fields)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def content(table, version=None):
    return {r["flow_id"]: r["x"] for r in table.load(version).collect()}


@pytest.fixture
def table(spark):
    found = BucketTable(spark, shared_path(spark, "store"), SCHEMA, buckets=8)
    found.save(rows(spark, [(f"f{i}", i) for i in range(200)]))
    return found


def test_one_key_rewrites_one_bucket(spark, table):
    before = table.manifest()["folders"]
    assert len(before) == 8
    table.upsert(rows(spark, [("f7", -7)]))
    after = table.manifest()["folders"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert content(table) == {f"f{i}": i for i in range(200)} | {"f7": -7}
    assert content(table, 1)["f7"] == 7


def test_new_keys_no_changes_and_null_keys(spark, table):
    assert table.upsert(rows(spark, [])) == 1
    table.upsert(rows(spark, [("new", 1), (None, 2), ("f1", None)]))
    assert content(table)["new"] == 1 and content(table)[None] == 2 and content(table)["f1"] is None
    table.rewrite(rows(spark, [("new", 0)]), lambda old, gone: old.join(gone, "flow_id", "left_anti"))
    assert "new" not in content(table) and len(content(table)) == 201


def test_keys_must_be_unique(spark, table):
    with pytest.raises(ValueError):
        table.save(rows(spark, [("a", 1), ("a", 2)]))
    with pytest.raises(ValueError):
        table.rewrite(rows(spark, [("f1", 1)]), lambda old, new: old.unionByName(new))
    assert table.versions() == [1] and len(content(table)) == 200
    assert len(names_in(spark, f"{table.path}/data")) == 1


def test_changes_at_the_same_time_conflict(spark, table):
    def slow(old, new):
        table.upsert(rows(spark, [("f3", 33)]))
        return labels.upsert(old, new)

    with pytest.raises(SaveConflict):
        table.rewrite(rows(spark, [("f3", 3)]), slow)
    assert content(table)["f3"] == 33


def test_prune_keeps_what_the_newest_versions_name(spark, table):
    for i in range(4):
        table.upsert(rows(spark, [(f"f{i}", -i)]))
    assert table.prune(keep=2) == [1, 2, 3]
    assert content(table, 4)["f2"] == -2 and content(table) == {f"f{i}": -i if i < 4 else i for i in range(200)}


def test_empty_table_and_other_bucket_counts(spark):
    table = BucketTable(spark, shared_path(spark, "store"), SCHEMA)
    assert table.load().count() == 0
    table.upsert(rows(spark, [("a", 1)]))
    table.save(table.load(), buckets=3)
    table.upsert(rows(spark, [(f"b{i}", i) for i in range(20)]))
    assert table.manifest()["buckets"] == 3 and len(content(table)) == 21


def test_verdicts_in_buckets_equal_verdicts_on_the_whole(spark):
    store = spark.range(100).select(F.concat(F.lit("f"), "id").alias("flow_id"), F.lit("NORMAL").alias("label"))
    verdicts = spark.createDataFrame([("f5", "Attack", "ann"), ("absent", "Attack", "ann")], "flow_id string, new_label string, annotator_id string")
    table = BucketTable(spark, shared_path(spark, "store"), LABEL_ROW)
    table.save(store)
    table.rewrite(verdicts, lambda old, new: labels.update_labels(old, new, at="2024-01-01"))
    got = {(r["flow_id"], r["label"], r["label_status"]) for r in table.load().collect()}
    whole = labels.update_labels(store.withColumn("label_status", F.lit(None).cast("string")), verdicts, at="2024-01-01")
    assert got == {(r["flow_id"], r["label"], r["label_status"]) for r in whole.collect()}
