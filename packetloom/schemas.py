"""Record layouts shared by batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def record(**fields: str) -> T.StructType:
    """Flat record type from ``name="type"`` pairs; needs no running session, unlike a DDL text."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


# Field names and types of the exchanged records.
PACKET = record(
    timestamp="double", src_ip="string", dst_ip="string", protocol="string", length="int", flags="string",
    ttl="int", label="int",
)

CAPTURED_PACKET = record(
    path="string", packet_no="bigint", timestamp="double", src_ip="string", dst_ip="string",
    protocol="string", src_port="int", dst_port="int", length="int", flags="string", ttl="int", label="int",
)

SCORING_REQUEST = record(
    timestamp="double", src_ip="string", dst_ip="string", protocol="string", length="int", flags="string",
)

EXPLAINED_FEATURE = record(feature="string", value="double", shap_value="double", impact="string")

_ALERT = record(
    timestamp="string", src="string", dst="string", src_port="int", dst_port="int", proto="string",
    xgb_prob="double", anomaly_score="double", final_label="int", risk_score="double", alert_level="string",
    reasons="string",
)

ALERT = T.StructType([*_ALERT.fields, T.StructField("shap_explanation", T.ArrayType(EXPLAINED_FEATURE))])

AUDIT_ENTRY = record(ts="string", action="string", old_label="string", new_label="string", by="string")
AUDIT_LOG = T.ArrayType(AUDIT_ENTRY)

LABEL_ROW = T.StructType(
    record(
        flow_id="string", timestamp="string", src="string", dst="string", src_ip="string",
        dst_ip="string", proto="string", dst_port="int", duration="double", model_score="double",
        reasons="string", label="string", label_status="string", label_confidence="double",
        annotator_id="string",
    ).fields
    + [T.StructField("audit_log", AUDIT_LOG)]
)

MODEL_FEATURES = [
    "duration",
    "orig_pkts",
    "resp_pkts",
    "pkts_total",
    "orig_bytes",
    "resp_bytes",
    "bytes_total",
    "pkts_per_sec",
    "bytes_per_sec",
    "iat_mean",
    "iat_std",
    "syn_count",
    "ack_count",
    "rst_count",
]

FLOW = record(
    timestamp="double", ts="double", src_ip="string", dst_ip="string", src_port="int", dst_port="int",
    protocol="string", proto="string", length="bigint", flags="string", service="string", conn_state="string",
    duration="double", orig_pkts="bigint", resp_pkts="bigint", pkts_total="bigint", orig_bytes="bigint",
    resp_bytes="bigint", bytes_total="bigint", pkts_per_sec="double", bytes_per_sec="double",
    iat_mean="double", iat_std="double", syn_count="int", ack_count="int", rst_count="int", risk_hint="int",
)

FIVE_TUPLE = ("src_ip", "dst_ip", "protocol", "src_port", "dst_port")
LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
SEVERE_LEVELS = ("HIGH", "CRITICAL")
LABEL_STATUSES = ("UNLABELED", "PSEUDO_LABELED", "HUMAN_REVIEW_NEEDED", "VERIFIED")
NORMAL_NAMES = ("normal", "benign")


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def column_or(df: DataFrame, name: str, default: object, data_type: str) -> Column:
    """The column when the table has it, else a typed literal."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(default).cast(data_type)


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add the columns of ``{name: (type, default)}`` that the table lacks."""
    absent = {
        name: F.lit(default).cast(data_type) for name, (data_type, default) in defaults.items() if name not in df.columns
    }
    return df.withColumns(absent) if absent else df
