import pytest
from pyspark.sql import functions as F

from packetloom.functions import rules


def fuse(spark, label, proba, anomaly):
    row = spark.createDataFrame([(label, proba, anomaly)], "label int, proba double, anomaly double")
    return row.select(rules.fuse(F.col("label"), F.col("proba"), F.col("anomaly")).alias("r")).first()["r"].asDict()


@pytest.mark.parametrize(
    "label, proba, anomaly, final, risk, level",
    [
        (0, 0.10, 0.20, 0, 0.0, "LOW"),
        (1, 0.95, -0.13, 1, 89.0, "CRITICAL"),
        (0, 0.20, -0.30, 1, 66.0, "HIGH"),
        (1, 0.55, 0.10, 1, 33.0, "MEDIUM"),
        (1, 0.50, 0.10, 1, 30.0, "MEDIUM"),
        (1, 0.49, 0.10, 0, 29.4, "LOW"),
        (0, 0.20, -0.12, 0, 0.0, "LOW"),
        (0, 0.20, -0.15, 0, 36.0, "MEDIUM"),
        (0, 0.20, -0.90, 1, 70.0, "HIGH"),
        (1, 1.00, -0.90, 1, 100.0, "CRITICAL"),
    ],
)
def test_fusion(spark, label, proba, anomaly, final, risk, level):
    got = fuse(spark, label, proba, anomaly)
    assert (got["final_label"], got["risk_score"], got["alert_level"]) == (final, pytest.approx(risk), level)


def test_fusion_reasons(spark):
    assert fuse(spark, 0, 0.1, 0.2)["reasons"] == "Normal Traffic"
    assert fuse(spark, 1, 0.953, -0.131)["reasons"] == "Known Signature Match (0.95), Statistical Anomaly (Score -0.13)"
    assert fuse(spark, 0, 0.2, -0.3)["reasons"].endswith("Potential Zero-day")


def test_fusion_threshold_is_a_parameter(spark):
    row = spark.createDataFrame([(0, 0.1, -0.05)], "l int, p double, a double")
    got = row.select(rules.fuse(F.col("l"), F.col("p"), F.col("a"), threshold=0.0).alias("r")).first()["r"]
    assert got["alert_level"] == "HIGH" or got["risk_score"] == pytest.approx(40.0)


@pytest.mark.parametrize(
    "src, duration, port, proto, score, rule",
    [
        ("10.0.0.1", 5.0, 80, "TCP", 1.0, "RULE_WHITELIST"),
        ("1.1.1.1", 0.0, 2000, "tcp", 0.5, "RULE_NMAP"),
        ("1.1.1.1", 0.0, 2000, "TCP", 0.5, "RULE_NMAP"),
        ("1.1.1.1", 0.0, 1024, "tcp", 0.5, None),
        ("1.1.1.1", 0.001, 2000, "tcp", 0.5, None),
        ("1.1.1.1", None, 2000, "tcp", 0.5, None),
        ("1.1.1.1", 5.0, 80, "TCP", 0.0005, "RULE_LOW_RISK_MODEL"),
        ("1.1.1.1", 5.0, 80, "TCP", 0.9995, "RULE_HIGH_RISK_MODEL"),
        ("1.1.1.1", 5.0, 80, "TCP", 0.001, None),
        ("1.1.1.1", 5.0, 80, "TCP", None, None),
        ("1.1.1.1", 5.0, 80, "TCP", float("nan"), None),
        (None, 5.0, 80, "TCP", 0.5, None),
    ],
)
def test_auto_label_rule(spark, src, duration, port, proto, score, rule):
    row = spark.createDataFrame(
        [(src, duration, port, proto, score)], "src string, duration double, port int, proto string, score double"
    )
    found = row.select(rules.auto_label_rule(*[F.col(c) for c in row.columns]).alias("r")).first()["r"]
    assert found["rule"] == rule


def test_strict_case_needs_lower_case_protocol(spark):
    row = spark.createDataFrame([("x", 0.0, 2000, "TCP", 0.5)], "src string, d double, p int, proto string, s double")
    assert row.select(rules.auto_label_rule(*[F.col(c) for c in row.columns], strict_case=True).alias("r")).first()["r"]["rule"] is None


def test_conflict_and_uncertainty(spark):
    rows = [
        ("NORMAL", 0.9, 1.0),
        ("NORMAL", 0.8, 0.0),
        ("Attack", 0.1, 1.0),
        ("Attack", 0.2, 0.0),
        ("", 0.1, 0.0),
        (None, 0.9, 0.0),
        ("NORMAL", None, 0.0),
        ("NORMAL", float("nan"), 0.0),
    ]
    df = spark.createDataFrame(rows, "label string, score double, expected double")
    for r in df.select("expected", rules.conflict(F.col("label"), F.col("score")).alias("c")).collect():
        assert r["c"] == r["expected"]
    scores = spark.createDataFrame([(0.5, 1.0), (0.0, 0.0), (1.0, 0.0), (None, 0.0), (float("nan"), 0.0)], "s double, e double")
    for r in scores.select("e", rules.uncertainty(F.col("s")).alias("u")).collect():
        assert r["u"] == r["e"]


def test_risk_band(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (70.0,), (90.0,), (None,)], "r double")
    assert [r[0] for r in df.select(rules.risk_band(F.col("r"))).collect()] == ["low", "elevated", "high", "alarm", None]
