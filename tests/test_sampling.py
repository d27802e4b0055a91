import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.functions.hashing import fingerprint, hash_uniform
from packetloom.operators import sampling

NOW = 1_700_000_000.0


@pytest.fixture(scope="module")
def rows(spark):
    kind = F.when(F.col("id") < 40, "rare").when(F.col("id") < 4000, "some").otherwise("hot")
    return spark.range(12_000).select(F.col("id").cast("string").alias("key"), kind.alias("kind")).repartition(8).cache()


def keys(df):
    return sorted(r["key"] for r in df.select("key").collect())


WAYS = [{"top_k_rows": 0}, {"top_k_rows": 0, "merge_rows": 50}, {"top_k_rows": 0, "merge_rows": 0}]


@pytest.mark.parametrize("how", WAYS)
@pytest.mark.parametrize("n", [1, 3000, 11_999, 12_000, 50_000])
def test_large_samples_equal_top_k(rows, n, how):
    weight = F.when(F.col("kind") == "rare", 5.0).otherwise(1.0)
    top_k = sampling.weighted_sample(rows, ["key"], weight, n, top_k_rows=100_000)
    assert keys(sampling.weighted_sample(rows, ["key"], weight, n, **how)) == keys(top_k)
    assert top_k.count() == min(n, 12_000)


@pytest.mark.parametrize("how", WAYS)
def test_samples_with_repeated_order_values(rows, how):
    order = F.when(F.col("kind") == "hot", 1.0).otherwise(F.length("key").cast("double"))
    want = keys(rows.orderBy(order, "key").limit(5000))
    assert keys(sampling.smallest(rows, order, ["key"], 5000, **how)) == want


def test_uniform_numbers(rows):
    u = np.array([r[0] for r in rows.select(hash_uniform(F.col("key"), "s")).collect()])
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02


def test_weighted_sample_prefers_heavy_rows(rows):
    weight = F.when(F.col("kind") == "rare", 1000.0).otherwise(1.0)
    got = sampling.weighted_sample(rows, ["key"], weight, 100)
    assert got.where("kind = 'rare'").count() >= 39


def test_weights(spark):
    df = spark.createDataFrame(
        [(NOW, "VERIFIED", 2.0), (NOW - 864000, None, float(np.exp(-1.0))), (NOW + 5, "HUMAN_REVIEW_NEEDED", 3.0), (0.0, "x", 0.001)],
        "__timestamp double, label_status string, expected double",
    )
    for r in df.select("expected", sampling.sample_weight(df, NOW).alias("w")).collect():
        assert r["w"] == pytest.approx(r["expected"])


@pytest.mark.parametrize("how", [{}, {"cells": 4}, {"cells": 16, "cell_rows": 1}])
def test_stratified_split_sizes(rows, how):
    got = sampling.stratified_split(rows, "kind", ["key"], **how).groupBy("kind").agg(F.count_if("is_test"), F.count("*")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {"rare": (8, 40), "some": (792, 3960), "hot": (1600, 8000)}


def test_stratified_split_of_tiny_classes(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y"), ("d", "y"), ("e", None)], "key string, kind string")
    got = sampling.stratified_split(df, "kind", ["key"]).collect()
    assert len(got) == 4 and sum(r["is_test"] for r in got) == 1


def test_oversampling(rows):
    got = sampling.oversample_small_classes(rows, "kind", ["key"], least=100)
    sizes = {r["kind"]: r["count"] for r in got.groupBy("kind").count().collect()}
    assert sizes == {"rare": 100, "some": 3960, "hot": 8000}
    assert got.where("kind = 'rare' and __draw = 0").count() == 0
    assert got.where("kind = 'hot' and __draw <> 0").count() == 0


def test_oversampling_drops_null_classes(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "key string, kind string")
    assert sampling.oversample_small_classes(df, "kind", ["key"], 5).count() == 5


def test_stratified_split_is_the_same_for_all_cell_sizes(rows):
    fine = sampling.stratified_split(rows, "kind", ["key"], cells=16, cell_rows=1).where("is_test")
    assert keys(fine) == keys(sampling.stratified_split(rows, "kind", ["key"]).where("is_test"))


def test_replacement_from_an_empty_pool(rows):
    got = sampling.weighted_sample_with_replacement(rows.limit(0), ["key"], F.lit(1.0), 5)
    assert got.count() == 0 and got.columns[-1] == "__draw"


def test_sampling_with_replacement(rows):
    rare = rows.where("kind = 'rare'")
    weight = F.when(F.col("key") == "7", 40.0).otherwise(1.0)
    got = sampling.weighted_sample_with_replacement(rare, ["key"], weight, 4000)
    assert got.count() == 4000
    assert abs(got.where("key = '7'").count() / 4000 - 40 / 79) < 0.04


def local(spark, values, source="local_normal"):
    return spark.createDataFrame([(float(x), source) for x in values], "duration double, source_type string")


def test_outliers_need_more_than_100_rows(spark):
    values = [1.0, 2.0] * 49 + [1e6]
    assert sampling.drop_outliers(local(spark, values + [1.0])).count() == 100
    assert sampling.drop_outliers(local(spark, values + [1.0, 2.0])).count() == 100
    assert sampling.drop_outliers(local(spark, [3.0] * 200)).count() == 200
    trusted = local(spark, values + [1.0, 2.0], "benchmark")
    assert sampling.drop_outliers(trusted).count() == 101


def test_weak_pseudo_labels(spark):
    df = spark.createDataFrame(
        [("PSEUDO_LABELED", 0.5), ("PSEUDO_LABELED", 0.9), ("PSEUDO_LABELED", None), ("VERIFIED", 0.1), (None, 0.1)],
        "label_status string, model_score double",
    )
    assert sampling.drop_weak_pseudo_labels(df).count() == 4
    assert sampling.drop_weak_pseudo_labels(df.drop("model_score")).count() == 5


def test_zero_day_needs_two_attack_classes(spark):
    rows = [("Normal",)] * 60 + [("dos",)] * 60 + [("scan",)] * 51 + [("worm",)] * 50
    df = spark.createDataFrame(rows, "attack_type string")
    split = sampling.zero_day_split(df)
    assert (split.held_out_class, split.held_out.count(), split.train.count()) == ("scan", 51, 170)
    one = sampling.zero_day_split(df.where("attack_type <> 'scan'"))
    assert (one.held_out_class, one.held_out.count(), one.train.count()) == (None, 0, 170)
    numeric = sampling.zero_day_split(spark.createDataFrame([(1,)] * 60, "label int"))
    assert numeric.held_out_class is None and numeric.report.first()["zero_day_holdout"] is None


def test_retrain_set_targets(spark):
    def pool(n, **cols):
        df = spark.range(n).select(F.concat(F.lit(str(cols)), F.col("id").cast("string")).alias("key"), F.lit(NOW).alias("__timestamp"))
        return df.withColumns({k: F.lit(x) for k, x in cols.items()})

    attack = pool(30, label="dos").unionByName(pool(500, label="scan"))
    got = sampling.build_retrain_set(pool(900, label="n"), pool(50, label="n"), attack, ["key"], NOW, max_samples=1000)
    sizes = {r["source_type"]: r["count"] for r in got.groupBy("source_type").count().collect()}
    assert sizes == {"benchmark": 500, "local_normal": 50, "local_attack": 200}
    assert {"__timestamp", "source_type", "__draw"}.isdisjoint(sampling.finish_retrain_set(got).columns)
    plain = sampling.build_retrain_set(
        pool(900), pool(900), pool(30), ["key"], NOW, max_samples=1000, max_new_ratio=0.4
    )
    sizes = {r["source_type"]: r["count"] for r in plain.groupBy("source_type").count().collect()}
    assert sizes == {"benchmark": 500, "local_normal": 240, "local_attack": 160}


def test_fingerprint_ignores_order(rows):
    first = fingerprint(rows).first()
    assert fingerprint(rows.repartition(3).orderBy(F.rand(1))).first() == first
    assert fingerprint(rows.where("key <> '5'")).first() != first
