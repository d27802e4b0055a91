"""Traffic views derived from the sample tables, as DataFrames and as DuckDB common table expressions.

The sample tables hold no packets. ``events`` plays the packet table: the user picks the source, the counter in ``props``
picks destination, ports and flags, the event type picks the protocol. Everything else follows from the packets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions.hashing import hash_uniform, stable_id
from packetloom.operators.flows import flow_rollup
from packetloom.operators.labels import auto_label, import_alerts
from packetloom.plans.detection import to_alerts
from packetloom.session import use_utc

FLOW_WINDOW = "1 day"
FLOW_KEYS = ("src_ip", "dst_ip", "protocol", "dst_port")
NOW = "2024-02-01T00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def packets_from(events: DataFrame) -> DataFrame:
    # the counter is parsed in a step of its own, once per row
    parsed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, kind = F.col("k"), F.col("event_type")
    protocol = (
        F.when(kind.isin("click", "view"), "TCP").when(kind == "purchase", "UDP").when(kind == "signup", "ICMP").otherwise("OTHER")
    )
    is_tcp = kind.isin("click", "view")
    flags = (
        F.when(is_tcp & (k % 5 == 0), "S")
        .when(is_tcp & (k % 5 == 1), "SA")
        .when(is_tcp & (k % 5 == 2), "A")
        .when(is_tcp & (k % 5 == 3), "FA")
        .when(is_tcp & (k % 5 == 4), "RA")
    )
    ts = F.col("ts").cast("timestamp")
    return parsed.select(
        F.col("event_id").alias("packet_id"),
        ts.alias("ts"),
        (F.unix_micros(ts) / F.lit(1e6)).alias("timestamp"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 10).cast("string")).alias("src_ip"),
        F.concat(F.lit("192.168.1."), (k % 4).cast("string")).alias("dst_ip"),
        (F.lit(1024) + k).alias("src_port"),
        F.when(k % 4 == 0, 80).when(k % 4 == 1, 443).when(k % 4 == 2, 53).otherwise(8080).alias("dst_port"),
        protocol.alias("protocol"),
        (F.lit(40) + F.floor(F.col("value") * 3)).cast("int").alias("length"),
        flags.alias("flags"),
        F.lit(64).alias("ttl"),
        F.when(kind == "error", 1).otherwise(0).alias("label"),
    )


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_from(table(spark, sf_dir, "events"))


PACKETS_SQL = """
packets AS (
  SELECT event_id AS packet_id, ts, epoch_us(ts) / 1e6 AS timestamp,
    '10.0.0.' || CAST(user_id % 10 AS VARCHAR) AS src_ip, '192.168.1.' || CAST(k % 4 AS VARCHAR) AS dst_ip,
    1024 + k AS src_port,
    CASE k % 4 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 ELSE 8080 END AS dst_port,
    CASE WHEN event_type IN ('click', 'view') THEN 'TCP' WHEN event_type = 'purchase' THEN 'UDP'
      WHEN event_type = 'signup' THEN 'ICMP' ELSE 'OTHER' END AS protocol,
    CAST(40 + floor(value * 3) AS INTEGER) AS length,
    CASE WHEN event_type IN ('click', 'view') THEN
      CASE k % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'SA' WHEN 2 THEN 'A' WHEN 3 THEN 'FA' ELSE 'RA' END END AS flags,
    64 AS ttl, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events) e
)"""


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily flows with the source port left out of the key."""
    rolled = flow_rollup(packets(spark, sf_dir), window=FLOW_WINDOW, keys=FLOW_KEYS)
    return with_flow_id(rolled)


def with_flow_id(rolled: DataFrame) -> DataFrame:
    start = F.unix_micros("window_start")
    return rolled.withColumn("flow_id", stable_id(start, *[F.col(c) for c in FLOW_KEYS]))


FLOWS_SQL = (
    PACKETS_SQL
    + """,
flow_sums AS (
  SELECT epoch_us(time_bucket(INTERVAL 1 day, ts)) AS window_us, src_ip, dst_ip, protocol, dst_port,
    count(*) AS packets, CAST(sum(length) AS BIGINT) AS bytes, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us,
    coalesce(bool_or(contains(flags, 'S')), false) AS s, coalesce(bool_or(contains(flags, 'A')), false) AS a,
    coalesce(bool_or(contains(flags, 'F')), false) AS f, coalesce(bool_or(contains(flags, 'R')), false) AS r
  FROM packets GROUP BY ALL
),
flows AS (
  SELECT window_us, first_us / 1e6 AS timestamp, first_us / 1e6 AS ts, src_ip, dst_ip, 0 AS src_port, dst_port, protocol,
    protocol AS proto, bytes AS length,
    CASE WHEN r THEN 'RST' WHEN s AND NOT a THEN 'SYN' WHEN f THEN 'FIN' WHEN a THEN 'ACK' ELSE 'normal' END AS flags,
    CASE WHEN protocol = 'TCP' THEN 'http' ELSE 'dns' END AS service, CASE WHEN f THEN 'SF' ELSE 'S0' END AS conn_state,
    last_us / 1e6 - first_us / 1e6 AS duration, packets AS orig_pkts, 0::BIGINT AS resp_pkts, packets AS pkts_total,
    bytes AS orig_bytes, 0::BIGINT AS resp_bytes, bytes AS bytes_total,
    packets / (last_us / 1e6 - first_us / 1e6 + 1e-6) AS pkts_per_sec,
    bytes / (last_us / 1e6 - first_us / 1e6 + 1e-6) AS bytes_per_sec,
    0.0::DOUBLE AS iat_mean, 0.0::DOUBLE AS iat_std, CAST(s AS INTEGER) AS syn_count, CAST(a AS INTEGER) AS ack_count,
    CAST(r AS INTEGER) AS rst_count, 0 AS risk_hint,
    md5(concat_ws('|', window_us, src_ip, dst_ip, protocol, dst_port)) AS flow_id
  FROM flow_sums
)"""
)

# Fixed coefficients of a linear scorer, spread so that every alert level occurs.
SCORER_INTERCEPT = -7.0
SCORER_WEIGHTS = {"log_bytes": 1.1, "syn_count": 0.9, "rst_count": -0.7, "pkts_total": 0.05}


def scorer_features(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("log_bytes", F.log1p(F.col("bytes_total").cast("double")))


def linear_score() -> Column:
    z = F.lit(SCORER_INTERCEPT)
    for name, weight in SCORER_WEIGHTS.items():
        z = z + F.lit(weight) * F.col(name)
    return z


def score_flows(rolled: DataFrame) -> DataFrame:
    """Stand-in models for the catalog: a fixed logistic scorer and a hash-based anomaly score."""
    return (
        scorer_features(rolled)
        .withColumn("xgb_prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_score())))
        .withColumn("xgb_label", (F.col("xgb_prob") >= 0.5).cast("int"))
        .withColumn("anomaly_score", hash_uniform(F.col("flow_id"), "a") - F.lit(0.5))
    )


def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_flows(flows(spark, sf_dir))


SCORED_SQL = (
    FLOWS_SQL
    + """,
scored AS (
  SELECT *, CASE WHEN xgb_prob >= 0.5 THEN 1 ELSE 0 END AS xgb_label FROM (
    SELECT *, ln(1 + bytes_total) AS log_bytes,
      1.0 / (1.0 + exp(-(-7.0 + 1.1 * ln(1 + bytes_total) + 0.9 * syn_count + -0.7 * rst_count + 0.05 * pkts_total))) AS xgb_prob,
      (CAST('0x' || substr(md5(flow_id || '|a'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE - 0.5 AS anomaly_score
    FROM flows) q
)"""
)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert table with a parsed event time ``at``."""
    return to_alerts(scored_flows(spark, sf_dir), keep=("flow_id",)).withColumn(
        "at", F.timestamp_micros((F.col("timestamp").cast("double") * 1e6).cast("bigint"))
    )


ALERTS_SQL = (
    SCORED_SQL
    + """,
parts AS (
  SELECT *, anomaly_score < -0.12 AS anomalous,
    least(100.0, CASE WHEN xgb_label = 1 THEN xgb_prob * 60.0 ELSE 0.0 END
      + CASE WHEN anomaly_score < -0.12 THEN least(70.0, abs(anomaly_score + 0.12) * 200.0 + 30.0) ELSE 0.0 END) AS risk
  FROM scored
),
alerts AS (
  SELECT flow_id, timestamp, make_timestamp(CAST(round(timestamp * 1e6) AS BIGINT)) AS "at", src_ip AS src, dst_ip AS dst, src_port, dst_port, protocol AS proto,
    xgb_prob, anomaly_score,
    CASE WHEN xgb_label = 0 AND anomalous AND risk > 40 THEN 1 WHEN risk >= 50 THEN 1
      WHEN risk >= 30 AND xgb_label = 1 THEN 1 ELSE 0 END AS final_label,
    risk AS risk_score,
    CASE WHEN xgb_label = 0 AND anomalous AND risk > 40 THEN 'HIGH' WHEN risk >= 80 THEN 'CRITICAL'
      WHEN risk >= 50 THEN 'HIGH' WHEN risk >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level,
    CASE WHEN xgb_label = 0 AND NOT anomalous THEN 'Normal Traffic' ELSE concat_ws(', ',
      CASE WHEN xgb_label = 1 THEN printf('Known Signature Match (%.2f)', xgb_prob) END,
      CASE WHEN anomalous THEN printf('Statistical Anomaly (Score %.2f)', anomaly_score) END,
      CASE WHEN xgb_label = 0 AND anomalous AND risk > 40 THEN 'Potential Zero-day' END) END AS reasons
  FROM parts
)"""
)


def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts imported into the label store and labelled by the automatic rules."""
    return auto_label(import_alerts(alerts(spark, sf_dir)), at=NOW)
