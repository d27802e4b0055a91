"""Packets to alerts: roll-up, model scores, fusion, alert records. The same functions serve batch and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.rules import ANOMALY_THRESHOLD, with_fusion
from packetloom.operators.flows import WINDOW, flow_rollup
from packetloom.schemas import FIVE_TUPLE, LEVELS, column_or


def to_alerts(
    scored: DataFrame,
    threshold: float = ANOMALY_THRESHOLD,
    min_level: str = "LOW",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Scored flows (``xgb_label, xgb_prob, anomaly_score``) to alert records at or above ``min_level``."""
    fused = with_fusion(scored, threshold=threshold)
    levels = LEVELS[LEVELS.index(min_level) :]
    if len(levels) < len(LEVELS):
        fused = fused.where(F.col("alert_level").isin(*levels))
    return fused.select(
        *keep,
        F.format_string("%.6f", F.col("timestamp")).alias("timestamp"),
        F.col("src_ip").alias("src"),
        F.col("dst_ip").alias("dst"),
        column_or(scored, "src_port", 0, "int").cast("int").alias("src_port"),
        column_or(scored, "dst_port", 0, "int").cast("int").alias("dst_port"),
        F.col("protocol").alias("proto"),
        F.col("xgb_prob").cast("double").alias("xgb_prob"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        "final_label",
        "risk_score",
        "alert_level",
        "reasons",
    )


def detect(
    packets: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    window: str | None = WINDOW,
    keys: Sequence[str] = FIVE_TUPLE,
    threshold: float = ANOMALY_THRESHOLD,
    min_level: str = "LOW",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Packets to alerts. ``score`` adds ``xgb_label, xgb_prob, anomaly_score`` (and columns to ``keep``) to the flow rows."""
    return to_alerts(score(flow_rollup(packets, window, keys)), threshold, min_level, keep)
