import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from packetloom.operators import ordering


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=12_000), np.full(9_000, 0.25), np.full(6_000, -1.5), rng.integers(0, 5, 3_000)])
    rng.shuffle(x)
    pdf = pd.DataFrame({"x": x, "y": rng.exponential(size=len(x)), "pos": (rng.random(len(x)) < 0.3).astype(int)})
    return pdf, spark.createDataFrame(pdf).repartition(8).cache()


@pytest.mark.parametrize("budget", [1_000_000, 500, 40])
def test_exact_quantiles_equal_numpy(values, budget):
    pdf, df = values
    probabilities = [0.0, 0.001, 0.1, 1 / 3, 0.5, 0.77, 0.999, 1.0]
    found = ordering.exact_quantiles(df, {"x": probabilities, "y": probabilities}, exact_values=budget)
    for c in ("x", "y"):
        assert found[c] == pytest.approx(np.quantile(pdf[c], probabilities).tolist(), abs=1e-12)


def test_exact_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "a double, b double")
    assert ordering.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}


def test_order_statistics_with_one_repeated_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    found = ordering.order_statistics(df, {"x": [0, 3999, 4000, 4999]}, {"x": 5000}, exact_values=10)
    assert [found["x", r] for r in (0, 3999, 4000, 4999)] == [7.0, 7.0, 4000.0, 4999.0]


@pytest.mark.parametrize("slice_rows", [10_000_000, 1_000])
def test_running_totals(values, slice_rows):
    pdf, df = values
    got = ordering.running_totals(
        df, "x", {"n": F.count(F.lit(1)), "p": F.sum("pos")}, slice_rows
    ).toPandas().sort_values("x").reset_index(drop=True)
    want = pdf.groupby("x").agg(n=("pos", "size"), p=("pos", "sum")).reset_index()
    assert got["n"].tolist() == want["n"].tolist()
    assert got["n_before"].tolist() == (want["n"].cumsum() - want["n"]).tolist()
    assert got["p_before"].tolist() == (want["p"].cumsum() - want["p"]).tolist()


def test_slices_are_balanced(values):
    _, df = values
    bounds = ordering.slice_bounds(df, F.col("y"), slice_rows=1_000)
    sizes = [r["count"] for r in ordering.with_slice(df, F.col("y"), bounds).groupBy(ordering.SLICE).count().collect()]
    assert len(sizes) == 30 and max(sizes) < 1_300
