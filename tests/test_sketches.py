import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators import sketches


def split(table, hour):
    late = F.col("hour") >= F.lit(hour).cast("timestamp")
    return table.where(~late), table.where(late)


def bucket(x, width=sketches.WIDTH):
    if abs(x) < 1e-9:
        return 0
    return math.copysign(math.floor(math.log(abs(x)) / math.log1p(width)) + 100_000, x)


def index(reference, current, bins=10):
    """The index with bins that end at the nearest-rank quantiles of the reference."""
    r, c = np.sort(reference), np.asarray(current)
    edges = [r[math.ceil(round(i / bins * len(r), 6)) - 1] for i in range(1, bins)]
    ranks = lambda v: np.diff([0.0, *[(v <= e).mean() for e in edges], 1.0])
    pairs = [(x, y) for x, y in zip(ranks(r), ranks(c)) if x or y]
    return float(sum((e - a) * math.log(e / a) for e, a in ((x or 1e-4, y or 1e-4) for x, y in pairs)))


def test_index_is_exact_for_the_buckets(spark):
    rng = np.random.default_rng(1)
    rows, values = [], {}
    for seg, shift in (("a", 0.0), ("b", 0.7), (None, 2.0)):
        for late in (False, True):
            x = rng.normal(shift * late, 1, 400).round(2)
            values[seg, late] = [bucket(v) for v in x]
            rows += [(f"2024-01-0{2 if late else 1} 0{i % 9}:00:00", seg, float(v), None) for i, v in enumerate(x)]
    rows += [("2024-01-01 00:00:00", "a", float("nan"), None), ("2024-01-01 00:00:00", "a", float("inf"), None), (None, "a", 1.0, None)]
    df = spark.createDataFrame(rows, "t string, seg string, x double, y double").withColumn("ts", F.to_timestamp("t"))
    stored = sketches.hourly_sketches(df, ["x", "y"], "seg")
    assert stored.where("feature = 'y'").count() == 0 and stored.agg(F.sum("n")).first()[0] == 2400
    got = {r["segment"]: r for r in sketches.segment_psi(*split(stored, "2024-01-02")).collect()}
    assert set(got) == {"a", "b", None}
    for seg, r in got.items():
        assert r["psi"] == pytest.approx(index(values[seg, False], values[seg, True]), abs=1e-12)
        assert (r["n_reference"], r["n_current"]) == (400, 400) and r["drift"] == (r["psi"] > 0.2)


def test_quantiles_are_within_a_bucket_and_merge_in_any_order(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(3, 2, 3000), -rng.lognormal(0, 1, 1500), np.zeros(500)])
    rows = [(f"2024-01-01 {i % 24:02d}:00:00", "s", float(x), 0.0) for i, x in enumerate(rng.permutation(values))]
    df = spark.createDataFrame(rows, "t string, seg string, x double, y double").withColumn("ts", F.to_timestamp("t"))
    stored = sketches.hourly_sketches(df, ["x"], "seg")
    shares = [0.0, 0.05, 0.25, 0.35, 0.5, 0.9, 1.0]
    found = {r["share"]: r["value"] for r in sketches.sketch_quantiles(stored, shares).collect()}
    again = {r["share"]: r["value"] for r in sketches.sketch_quantiles(stored.orderBy(F.rand(1)), shares).collect()}
    ordered = np.sort(values)
    for share in shares:
        exact = ordered[max(0, math.ceil(round(share * len(ordered), 6)) - 1)]
        assert abs(found[share] - exact) <= sketches.WIDTH * abs(exact) + 1e-9
    assert found == again


def test_one_sided_segments_are_left_out(spark):
    rows = [("2024-01-01 00:00:00", "a", 1.0, 1.0), ("2024-01-02 00:00:00", "b", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "t string, seg string, x double, y double").withColumn("ts", F.to_timestamp("t"))
    stored = sketches.hourly_sketches(df, ["x"], "seg")
    assert sketches.segment_psi(*split(stored, "2024-01-02")).count() == 0
    assert sketches.segment_psi(*split(stored.limit(0), "2024-01-02")).count() == 0
