import datetime as dt

import numpy as np
import pytest

from packetloom.operators import drift


def frame(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` {kind}")


def numpy_psi(reference, current, edges):
    e = np.histogram(reference, edges)[0] / len(reference)
    a = np.histogram(current, edges)[0] / len(current)
    e, a = np.where(e == 0, 1e-4, e), np.where(a == 0, 1e-4, a)
    return float(np.sum((e - a) * np.log(e / a)))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("method", ["quantiles", "bins"])
def test_psi_equals_numpy(spark, seed, method):
    rng = np.random.default_rng(seed)
    reference = np.round(rng.exponential(size=900), 1)
    current = np.round(rng.exponential(1.4, size=700) - 0.2, 1)
    if method == "quantiles":
        edges = np.percentile(reference, np.arange(0, 11) * 10)
    else:
        low, high = reference.min(), reference.max()
        edges = np.array([low + (high - low) * b / 10 for b in range(10)] + [high])
    got = drift.psi(frame(spark, reference.tolist()), frame(spark, current.tolist()), ["x"], method).first()
    assert got["psi"] == pytest.approx(numpy_psi(reference, current, edges), abs=1e-9)


def test_psi_of_constant_and_empty_columns(spark):
    same = frame(spark, [2.0] * 20)
    assert drift.psi(same, same, ["x"]).first()["psi"] == 0.0
    assert drift.psi(same, same.limit(0), ["x"]).first()["psi"] == 0.0
    assert drift.psi(same.limit(0), same, ["x"]).first()["psi"] == 0.0
    assert drift.psi(same, frame(spark, [None, float("nan")]), ["x"]).first()["psi"] == 0.0


def test_psi_of_text_and_dotted_columns(spark):
    a = frame(spark, ["tcp"] * 8 + ["udp"] * 2, "id.proto", "string")
    b = frame(spark, ["tcp"] * 5 + ["udp"] * 5, "id.proto", "string")
    want = (0.8 - 0.5) * np.log(0.8 / 0.5) + (0.2 - 0.5) * np.log(0.2 / 0.5)
    row = drift.psi(a, b, ["id.proto", "absent"]).first()
    assert (row["feature"], row["drift"]) == ("id.proto", True) and row["psi"] == pytest.approx(want)
    assert drift.psi(a, b, ["id.proto"], numeric_only=True).first()["psi"] == 0.0


def alerts(spark, rows):
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(hours=h), level) for h, level in rows]
    return spark.createDataFrame(data, "at timestamp, alert_level string")


def test_prediction_drift(spark):
    old = [(0, "LOW")] * 19 + [(1, "HIGH")]
    assert drift.prediction_drift(alerts(spark, old)).first()["prediction_score"] == 0.0
    recent = [(100, "LOW")] * 9 + [(76, "CRITICAL")]
    assert drift.prediction_drift(alerts(spark, old + recent)).first()["prediction_score"] == pytest.approx(0.5)
    assert drift.prediction_drift(alerts(spark, old + [(100, "HIGH")])).first()["prediction_score"] == 1.0


@pytest.mark.parametrize("psi, prediction, status", [(0.4, 1.0, "RETRAIN_NEEDED"), (0.4, 0.0, "WARNING"), (0.1, 0.5, "STABLE")])
def test_report(spark, psi, prediction, status):
    rows = spark.createDataFrame([("a", psi, False)], "feature string, psi double, drift boolean")
    change = spark.createDataFrame([(prediction,)], "prediction_score double")
    report = drift.drift_report(rows, change).first()
    assert report["status"] == status
    assert report["final_score"] == pytest.approx(0.6 * min(psi / 0.4, 1) + 0.4 * prediction)


def test_report_without_features(spark):
    rows = spark.createDataFrame([], "feature string, psi double, drift boolean")
    change = spark.createDataFrame([(0.0,)], "prediction_score double")
    assert drift.drift_report(rows, change).first()["status"] == "STABLE"
