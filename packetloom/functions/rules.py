"""Decision rules as column expressions: signal fusion, automatic labels, review priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions.columns import present

# Thresholds, scores and texts of the fusion rule.
ANOMALY_THRESHOLD = -0.12
SIGNATURE_POINTS = 60.0
ANOMALY_BASE_POINTS = 30.0
ANOMALY_SLOPE = 200.0
ANOMALY_MAX_POINTS = 70.0
MAX_RISK = 100.0
CRITICAL_RISK = 80.0
HIGH_RISK = 50.0
MEDIUM_RISK = 30.0
ZERO_DAY_RISK = 40.0
SIGNATURE_TEXT = "Known Signature Match (%.2f)"
ANOMALY_TEXT = "Statistical Anomaly (Score %.2f)"
ZERO_DAY_TEXT = "Potential Zero-day"
NORMAL_TEXT = "Normal Traffic"

# The automatic label rules.
WHITELIST = ("192.168.1.100", "10.0.0.1")
SCAN_MAX_DURATION = 0.001
SCAN_MIN_PORT = 1024
SCAN_PROTOCOL = "tcp"
LOW_SCORE = 0.001
HIGH_SCORE = 0.999
CONFLICT_HIGH = 0.8
CONFLICT_LOW = 0.2

RULE_RESULT = "struct<label: string, confidence: double, rule: string>"


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def fusion_signals(
    label: Column, proba: Column, anomaly: Column, threshold: float = ANOMALY_THRESHOLD
) -> dict[str, Column]:
    """First step of the fusion: which signals fired and the unrounded risk."""
    attack = _holds(label == 1)
    anomalous = _holds(anomaly < F.lit(threshold))
    # a missing probability adds nothing; NULL would be skipped by least() and read as the maximal risk
    signature_points = F.when(attack, F.coalesce(proba, F.lit(0.0)) * F.lit(SIGNATURE_POINTS)).otherwise(F.lit(0.0))
    distance = F.abs(anomaly - F.lit(threshold)) * F.lit(ANOMALY_SLOPE)
    anomaly_points = F.when(
        anomalous, F.least(F.lit(ANOMALY_MAX_POINTS), distance + F.lit(ANOMALY_BASE_POINTS))
    ).otherwise(F.lit(0.0))
    return {
        "attack": attack,
        "anomalous": anomalous,
        "risk": F.least(F.lit(MAX_RISK), signature_points + anomaly_points),
    }


def fusion_verdict(
    label: Column, proba: Column, anomaly: Column, attack: Column, anomalous: Column, risk: Column
) -> dict[str, Column]:
    """Second step: label, rounded risk, level and reason text. Levels follow the unrounded risk."""
    zero_day = _holds(label == 0) & anomalous & (risk > ZERO_DAY_RISK)
    level = (
        F.when(zero_day, F.lit("HIGH"))
        .when(risk >= CRITICAL_RISK, F.lit("CRITICAL"))
        .when(risk >= HIGH_RISK, F.lit("HIGH"))
        .when(risk >= MEDIUM_RISK, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )
    verdict = (
        F.when(zero_day | (risk >= HIGH_RISK), F.lit(1))
        .when((risk >= MEDIUM_RISK) & attack, F.lit(1))
        .otherwise(F.lit(0))
    )
    reasons = F.concat_ws(
        ", ",
        F.when(attack, F.format_string(SIGNATURE_TEXT, proba)),
        F.when(anomalous, F.format_string(ANOMALY_TEXT, anomaly)),
        F.when(zero_day, F.lit(ZERO_DAY_TEXT)),
    )
    return {
        "final_label": verdict,
        "risk_score": F.round(risk, 2),
        "alert_level": level,
        "reasons": F.when(attack | anomalous, reasons).otherwise(F.lit(NORMAL_TEXT)),
    }


def fuse(label: Column, proba: Column, anomaly: Column, threshold: float = ANOMALY_THRESHOLD) -> Column:
    """Combine a supervised verdict and an anomaly score in one ``struct(final_label, risk_score, alert_level, reasons)``.

    ``with_fusion`` gives the same as separate columns, of which the optimizer drops the unused ones.
    """
    signals = fusion_signals(label, proba, anomaly, threshold)
    parts = fusion_verdict(label, proba, anomaly, **signals)
    return F.struct(*[value.alias(name) for name, value in parts.items()])


def with_fusion(
    df: DataFrame,
    label: str = "xgb_label",
    proba: str = "xgb_prob",
    anomaly: str = "anomaly_score",
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """Add ``final_label``, ``risk_score``, ``alert_level`` and ``reasons``."""
    inputs = [F.col(c) for c in (label, proba, anomaly)]
    signals = fusion_signals(*inputs, threshold)
    staged = df.withColumns({f"__{name}": value for name, value in signals.items()})
    parts = fusion_verdict(*inputs, **{name: F.col(f"__{name}") for name in signals})
    return staged.withColumns(parts).drop(*[f"__{name}" for name in signals])


def auto_label_rule(
    src_ip: Column,
    duration: Column,
    dst_port: Column,
    proto: Column,
    model_score: Column,
    whitelist: Sequence[str] = WHITELIST,
    strict_case: bool = False,
) -> Column:
    """First matching rule as ``struct(label, confidence, rule)``, NULL fields when none matches.

    A NULL or NaN operand never fires a rule. ``strict_case`` accepts only the lower-case protocol text.
    """
    protocol = proto if strict_case else F.lower(proto)
    scored = present(model_score)

    def outcome(label: str, confidence: float, rule: str) -> Column:
        return F.struct(
            F.lit(label).alias("label"), F.lit(confidence).alias("confidence"), F.lit(rule).alias("rule")
        ).cast(RULE_RESULT)

    none = F.struct(
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("rule"),
    ).cast(RULE_RESULT)
    short_scan = (duration < SCAN_MAX_DURATION) & (dst_port > SCAN_MIN_PORT) & (protocol == SCAN_PROTOCOL)
    return (
        F.when(_holds(src_ip.isin(*whitelist)), outcome("NORMAL", 1.0, "RULE_WHITELIST"))
        .when(_holds(short_scan), outcome("PortScan", 0.9, "RULE_NMAP"))
        .when(scored & (model_score < LOW_SCORE), outcome("NORMAL", 0.8, "RULE_LOW_RISK_MODEL"))
        .when(scored & (model_score > HIGH_SCORE), outcome("Attack", 0.8, "RULE_HIGH_RISK_MODEL"))
        .otherwise(none)
    )


def conflict(label: Column, model_score: Column) -> Column:
    """1 when the label and the model score contradict each other, else 0."""
    usable = _holds(label != "") & present(model_score)
    contradicts = ((label == "NORMAL") & (model_score > CONFLICT_HIGH)) | (
        (label != "NORMAL") & (model_score < CONFLICT_LOW)
    )
    return F.when(usable & contradicts, F.lit(1.0)).otherwise(F.lit(0.0))


def uncertainty(model_score: Column) -> Column:
    """1 at score 0.5, 0 at scores 0 and 1 and for a missing score."""
    return F.when(present(model_score), F.lit(1.0) - F.lit(2.0) * F.abs(model_score - F.lit(0.5))).otherwise(F.lit(0.0))


def review_priority(conflict_score: Column, uncertainty_score: Column) -> Column:
    return conflict_score * F.lit(2.0) + uncertainty_score


def risk_band(risk: Column) -> Column:
    """Gauge bands: 0-30 low, 30-70 elevated, 70-100 high, with an alarm mark from 90."""
    return (
        F.when(risk.isNull(), F.lit(None).cast("string"))
        .when(risk < 30, F.lit("low"))
        .when(risk < 70, F.lit("elevated"))
        .when(risk < 90, F.lit("high"))
        .otherwise(F.lit("alarm"))
    )


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the scalar rules callable from SQL text as temporary functions."""
    bodies = {
        "label_uncertainty(score DOUBLE) RETURNS DOUBLE": (
            "CASE WHEN score IS NULL OR isnan(score) THEN 0D ELSE 1D - 2D * abs(score - 0.5D) END"
        ),
        "label_conflict(label STRING, score DOUBLE) RETURNS DOUBLE": (
            f"CASE WHEN label IS NULL OR label = '' OR score IS NULL OR isnan(score) THEN 0D "
            f"WHEN label = 'NORMAL' AND score > {CONFLICT_HIGH}D THEN 1D "
            f"WHEN label <> 'NORMAL' AND score < {CONFLICT_LOW}D THEN 1D ELSE 0D END"
        ),
        "fusion_risk(label INT, proba DOUBLE, anomaly DOUBLE) RETURNS DOUBLE": (
            f"least({MAX_RISK}D, (CASE WHEN label = 1 THEN coalesce(proba, 0D) * {SIGNATURE_POINTS}D ELSE 0D END) + "
            f"(CASE WHEN anomaly < {ANOMALY_THRESHOLD}D THEN least({ANOMALY_MAX_POINTS}D, "
            f"abs(anomaly - ({ANOMALY_THRESHOLD}D)) * {ANOMALY_SLOPE}D + {ANOMALY_BASE_POINTS}D) ELSE 0D END))"
        ),
        "risk_band(risk DOUBLE) RETURNS STRING": (
            "CASE WHEN risk IS NULL THEN NULL WHEN risk < 30 THEN 'low' WHEN risk < 70 THEN 'elevated' "
            "WHEN risk < 90 THEN 'high' ELSE 'alarm' END"
        ),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in bodies]
