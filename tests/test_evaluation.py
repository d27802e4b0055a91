import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from packetloom.operators import evaluation


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(9)
    y = (rng.random(4000) < 0.3).astype(int)
    s = np.round(rng.normal(size=4000) - 0.8 * y, 2) + 0.0  # no negative zero, which MLlib counts apart
    pdf = pd.DataFrame({"y": y, "s": s})
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


def test_empty_bases_give_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, prediction int")
    row = evaluation.binary_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["far"], row["dr"]) == (1, 0, 0, 0, 0, 0)


def test_macro_counts_classes_of_both_sides(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 2)], "y int, prediction int")
    row = evaluation.macro_metrics(df).first()
    assert row["precision"] == pytest.approx(0.5 / 3) and row["recall"] == pytest.approx(1 / 3)
    report = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert report["2"]["support"] == 0 and report["weighted avg"]["recall"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("slice_rows", [10_000_000, 100])
def test_auc_equals_rank_formula_and_mllib(scored, slice_rows):
    pdf, df = scored
    rank = pdf["s"].rank()
    pos, neg = (pdf["y"] == 1).sum(), (pdf["y"] == 0).sum()
    want = (rank[pdf["y"] == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    assert evaluation.roc_auc(df, "s", slice_rows=slice_rows).first()["auc"] == pytest.approx(want, abs=1e-12)
    assert BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("exact_values", [10_000_000, 100])
def test_sweep_equals_a_loop_over_thresholds(scored, exact_values):
    pdf, df = scored
    thresholds = np.percentile(pdf["s"], np.linspace(0.1, 50, 200))
    got = evaluation.threshold_sweep(df, "s", exact_values=exact_values).toPandas().sort_values("step")
    assert got["step"].tolist() == list(range(200))
    best, best_f1 = None, -1.0
    for i, t in enumerate(thresholds):
        flagged = pdf["s"] < t
        tp, fp = int((flagged & (pdf["y"] == 1)).sum()), int((flagged & (pdf["y"] == 0)).sum())
        row = got.iloc[i]
        assert row["threshold"] == pytest.approx(t, abs=1e-12) and (row["tp"], row["fp"]) == (tp, fp)
        f1 = 2 * tp / (2 * tp + fp + (int(pdf["y"].sum()) - tp))
        if f1 > best_f1 + 1e-15:
            best, best_f1 = i, f1
    assert evaluation.best_threshold(df, "s").first()["step"] == best


def metrics(spark, f1, far):
    return spark.createDataFrame([(f1, far)], "f1 double, far double")


@pytest.mark.parametrize(
    "new, old, canary, strict, promoted",
    [
        ((0.90, 0.010), (0.90, 0.010), None, False, True),
        ((0.90, 0.010), (0.90, 0.010), None, True, False),
        ((0.95, 0.020), (0.90, 0.010), None, False, False),
        ((0.95, 0.010), (0.90, 0.010), (0.89, 0.0), False, False),
        ((0.95, 0.010), (0.90, 0.010), (0.90, 0.0), False, True),
        ((0.10, 0.500), None, None, False, True),
        ((0.10, 0.500), None, (0.5, 0.0), False, False),
    ],
)
def test_promotion_gate(spark, new, old, canary, strict, promoted):
    champion = metrics(spark, *old) if old else metrics(spark, 0.0, 0.0).limit(0)
    checked = metrics(spark, *canary) if canary else None
    assert evaluation.promotion_gate(metrics(spark, *new), champion, checked, strict=strict).first()["promoted"] is promoted


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    weights = {r["y"]: r["weight"] for r in evaluation.with_class_weight(df).distinct().collect()}
    assert weights == {0: pytest.approx(4 / 6), 1: 2.0}
    assert evaluation.class_balance(df).first()["neg_pos_ratio"] == 3.0


def test_soft_vote_ties(spark):
    df = spark.createDataFrame([(0.4, 0.6, [0.5, 0.5], [0.5, 0.5])], "a double, b double, x array<double>, z array<double>")
    assert evaluation.soft_vote(df, ["a", "b"]).first()["prediction"] == 1
    assert evaluation.soft_vote_classes(df, ["x", "z"]).first()["prediction"] == 0


def test_zero_day_recall(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "prediction int")
    row = evaluation.zero_day_recall(df).first()
    assert (row["recall"], row["missed"]) == (0.25, False)
    assert evaluation.zero_day_recall(df.limit(0)).first()["missed"] is True


def test_histogram_of_equal_scores(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1)], "s double, y int")
    assert {r["bin"] for r in evaluation.score_histogram(df, "s").collect()} == {0}


def test_missing_scores_are_left_out(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, float("nan"))], "y int, s double")
    assert evaluation.roc_auc(df, "s", slice_rows=1).first()["auc"] == 1.0
    assert evaluation.threshold_sweep(df, "s").count() == 200
    assert evaluation.threshold_sweep(df.limit(0), "s").count() == 0
