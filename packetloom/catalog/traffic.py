"""Flow, alert and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.functions.columns import flag_names, log1p_length
from packetloom.functions.rules import risk_band
from packetloom.operators import analytics, flows

query = Catalog()


def micros(name: str):
    return F.unix_micros(name)


@query(f"WITH {v.PACKETS_SQL} SELECT packet_id, epoch_us(ts) AS ts_us, src_ip, dst_ip, src_port, dst_port, protocol, length, flags, ttl, label FROM packets")
def packets_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.packets(spark, sf_dir).select(
        "packet_id", micros("ts").alias("ts_us"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "length",
        "flags", "ttl", "label",
    )


_FLOW_TEXT = ["flow_id", "src_ip", "dst_ip", "dst_port", "protocol", "flags", "service", "conn_state"]
_FLOW_COUNTS = ["length", "orig_pkts", "resp_pkts", "bytes_total", "syn_count", "ack_count", "rst_count", "risk_hint"]
_FLOW_RATES = ["timestamp", "duration", "pkts_per_sec", "bytes_per_sec"]


def _flow_output(rolled: DataFrame) -> DataFrame:
    return rolled.select(
        *_FLOW_TEXT,
        *[F.col(c).cast("bigint").alias(c) for c in _FLOW_COUNTS],
        *[F.round(c, 5).alias(c) for c in _FLOW_RATES],
    )


_FLOW_SQL_OUTPUT = ", ".join(
    _FLOW_TEXT + [f"CAST({c} AS BIGINT) AS {c}" for c in _FLOW_COUNTS] + [f"round({c}, 5) AS {c}" for c in _FLOW_RATES]
)


@query(f"WITH {v.FLOWS_SQL} SELECT {_FLOW_SQL_OUTPUT} FROM flows")
def flow_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow_output(v.flows(spark, sf_dir))


@query(f"""WITH {v.PACKETS_SQL},
gaps AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY src_ip, dst_ip, protocol, dst_port, time_bucket(INTERVAL 1 day, ts) ORDER BY ts)) / 1e6 AS gap FROM packets)
SELECT src_ip, dst_ip, protocol, dst_port, epoch_us(time_bucket(INTERVAL 1 day, ts)) AS window_us, count(*) AS packets,
  CASE WHEN count(*) > 1 THEN (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / (count(*) - 1) ELSE 0 END AS iat_mean, round(coalesce(stddev_samp(gap), 0), 3) AS iat_std
FROM gaps GROUP BY ALL""")
def flow_iat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = flows.flow_rollup(v.packets(spark, sf_dir), v.FLOW_WINDOW, v.FLOW_KEYS, with_iat=True)
    return rolled.select(
        "src_ip", "dst_ip", "protocol", "dst_port", micros("window_start").alias("window_us"),
        F.col("orig_pkts").alias("packets"), "iat_mean", F.round("iat_std", 3).alias("iat_std"),
    )


@query(f"""WITH {v.PACKETS_SQL},
marked AS (SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w > 7200000000, true) AS opens FROM packets
  WINDOW w AS (PARTITION BY src_ip, protocol ORDER BY ts, packet_id)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY src_ip, protocol ORDER BY ts, packet_id) AS nr FROM marked)
SELECT src_ip, protocol, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS packets,
  CAST(sum(length) AS BIGINT) AS bytes FROM numbered GROUP BY src_ip, protocol, nr""")
def flow_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = flows.flow_sessions(v.packets(spark, sf_dir), 7200, keys=("src_ip", "protocol"))
    return sessions.select(
        "src_ip", "protocol", micros("session_start").alias("start_us"), micros("session_end").alias("end_us"),
        "packets", "bytes",
    )


@query(f"WITH {v.PACKETS_SQL} SELECT protocol, round(avg(length), 6) AS mean_length FROM packets GROUP BY protocol")
def length_by_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.packets(spark, sf_dir).groupBy("protocol").agg(F.round(F.avg("length"), 6).alias("mean_length"))


@query(f"WITH {v.PACKETS_SQL} SELECT packet_id, protocol, round(ln(1 + length), 9) AS length_log FROM packets")
def log1p_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.packets(spark, sf_dir).select(
        "packet_id", "protocol", F.round(log1p_length(F.col("length")), 9).alias("length_log")
    )


@query(f"""WITH {v.PACKETS_SQL} SELECT packet_id, concat_ws(',', CASE WHEN contains(flags, 'S') THEN 'SYN' END, CASE WHEN contains(flags, 'A') THEN 'ACK' END,
  CASE WHEN contains(flags, 'F') THEN 'FIN' END, CASE WHEN contains(flags, 'R') THEN 'RST' END, CASE WHEN contains(flags, 'P') THEN 'PSH' END) AS names FROM packets""")
def packet_flag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.packets(spark, sf_dir).select("packet_id", F.array_join(flag_names(F.col("flags")), ",").alias("names"))


_ALERT_SQL_OUTPUT = """flow_id, src, dst, src_port, dst_port, proto, round(xgb_prob, 7) AS xgb_prob,
  round(anomaly_score, 7) AS anomaly_score, final_label, round(risk_score, 2) AS risk_score, alert_level, reasons"""


def _alert_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        "flow_id", "src", "dst", "src_port", "dst_port", "proto", F.round("xgb_prob", 7).alias("xgb_prob"),
        F.round("anomaly_score", 7).alias("anomaly_score"), "final_label", "risk_score", "alert_level", "reasons",
    )


@query(f"WITH {v.ALERTS_SQL} SELECT {_ALERT_SQL_OUTPUT} FROM alerts")
def fuse_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_output(v.alerts(spark, sf_dir))


@query(f"""WITH {v.ALERTS_SQL} SELECT flow_id, printf('%.6f', timestamp) AS timestamp, src, dst, proto, alert_level FROM alerts
WHERE alert_level IN ('HIGH', 'CRITICAL')""")
def alert_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from packetloom.plans.detection import to_alerts

    emitted = to_alerts(v.scored_flows(spark, sf_dir), min_level="HIGH", keep=("flow_id",))
    return emitted.select("flow_id", "timestamp", "src", "dst", "proto", "alert_level")


@query(f"""WITH {v.ALERTS_SQL} SELECT count(*) AS total_alerts, count(DISTINCT src) AS distinct_sources,
  count(*) FILTER (WHERE alert_level = 'CRITICAL') AS critical_alerts, round(avg(round(risk_score, 2)), 6) AS avg_risk FROM alerts""")
def alert_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = analytics.kpis(v.alerts(spark, sf_dir))
    return kpis.withColumn("avg_risk", F.round("avg_risk", 6))


@query(f"""WITH {v.ALERTS_SQL} SELECT epoch_us(min("at")) AS first_us, epoch_us(max("at")) AS last_us FROM alerts""")
def alert_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = analytics.time_range(v.alerts(spark, sf_dir))
    return span.select(micros("first_at").alias("first_us"), micros("last_at").alias("last_us"))


@query(f"""WITH {v.ALERTS_SQL}, counted AS (SELECT time_bucket(INTERVAL 10 minute, "at") AS b, count(*) AS n FROM alerts GROUP BY 1),
frame AS (SELECT unnest(generate_series((SELECT min(b) FROM counted), (SELECT max(b) FROM counted), INTERVAL 10 minute)) AS b)
SELECT epoch_us(frame.b) AS bucket_us, coalesce(n, 0) AS count FROM frame LEFT JOIN counted ON counted.b = frame.b""")
def alert_freq_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.counts_over_time(v.alerts(spark, sf_dir)).select(micros("bucket").alias("bucket_us"), "count")


@query(f"WITH {v.ALERTS_SQL} SELECT alert_level, count(*) AS count FROM alerts GROUP BY 1")
def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.frequency(v.alerts(spark, sf_dir), "alert_level")


def _top(column: str, source: str = "alerts", k: int = 10, name: str | None = None) -> str:
    name = name or column
    return (
        f"WITH {v.ALERTS_SQL} SELECT CAST({column} AS VARCHAR) AS {name}, count(*) AS count FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count DESC, 1 LIMIT {k}"
    )


@query(_top("src"))
def top_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_sources(v.alerts(spark, sf_dir))


@query(_top("dst"))
def top_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_destinations(v.alerts(spark, sf_dir))


@query(_top("dst_port", name="port"))
def top_dst_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_ports(v.alerts(spark, sf_dir))


_EDGES_SQL = f"WITH {v.ALERTS_SQL}, top_edges AS (SELECT src, dst, count(*) AS count FROM alerts GROUP BY 1, 2 ORDER BY count DESC, src, dst LIMIT 50)"


@query(f"{_EDGES_SQL} SELECT src, dst, count FROM top_edges")
def edge_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_edges(v.alerts(spark, sf_dir))


@query(f"""{_EDGES_SQL} SELECT node, count(*) AS degree, CAST(sum(o) AS BIGINT) AS out_degree FROM
  (SELECT src AS node, 1 AS o FROM top_edges UNION ALL SELECT dst, 0 FROM top_edges) e GROUP BY node""")
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.node_degrees(analytics.top_edges(v.alerts(spark, sf_dir)))


@query(f"""WITH {v.ALERTS_SQL} SELECT CAST(hour("at") AS INTEGER) AS hour, CAST(minute("at") AS INTEGER) AS minute, count(*) AS count FROM alerts GROUP BY 1, 2""")
def heatmap_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.heatmap(v.alerts(spark, sf_dir))


@query(
    f"""WITH {v.ALERTS_SQL} SELECT CAST(hour("at") AS INTEGER) AS hour, """
    + ", ".join(f"""count(*) FILTER (WHERE minute("at") = {m}) AS m{m:02d}""" for m in range(60))
    + " FROM alerts GROUP BY 1"
)
def heatmap_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.heatmap_wide(v.alerts(spark, sf_dir))


@query(f"""WITH {v.ALERTS_SQL} SELECT CAST(least(19, floor(round(risk_score, 2) * 20 / 100.0)) AS INTEGER) AS bin, count(*) AS count FROM alerts GROUP BY 1""")
def risk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.risk_histogram(v.alerts(spark, sf_dir))


@query(f"""WITH {v.ALERTS_SQL} SELECT CASE WHEN round(risk_score, 2) < 30 THEN 'low' WHEN round(risk_score, 2) < 70 THEN 'elevated'
  WHEN round(risk_score, 2) < 90 THEN 'high' ELSE 'alarm' END AS band, count(*) AS count FROM alerts GROUP BY 1""")
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = v.alerts(spark, sf_dir).select(risk_band(F.col("risk_score")).alias("band"))
    return analytics.frequency(banded, "band")


@query(f"""WITH {v.ALERTS_SQL} SELECT {_ALERT_SQL_OUTPUT} FROM alerts WHERE (regexp_matches(src, '10\\.0\\.0\\.[1-3]$') OR regexp_matches(dst, '10\\.0\\.0\\.[1-3]$'))
  AND alert_level IN ('MEDIUM', 'HIGH') AND proto IN ('TCP', 'UDP')""")
def log_explorer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.explore(v.alerts(spark, sf_dir), r"10\.0\.0\.[1-3]$", ["MEDIUM", "HIGH"], ["TCP", "UDP"])
    return _alert_output(found)


@query(f"""WITH {v.ALERTS_SQL} SELECT {_ALERT_SQL_OUTPUT} FROM alerts
  WHERE CAST("at" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND alert_level IN ('HIGH', 'CRITICAL')""")
def date_level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.filter_dates_levels(v.alerts(spark, sf_dir), "2024-01-05", "2024-01-12", ["HIGH", "CRITICAL"])
    return _alert_output(found)


@query(f"""WITH {v.ALERTS_SQL} SELECT {_ALERT_SQL_OUTPUT} FROM alerts ORDER BY "at" DESC, flow_id LIMIT 2000""")
def tail_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_output(analytics.tail(v.alerts(spark, sf_dir), 2000, "at", "flow_id"))


@query(f"""WITH {v.ALERTS_SQL} SELECT flow_id, strftime("at", '%H:%M:%S') || ' | ' || coalesce(src, '?') || ' -> ' || coalesce(dst, '?')
  || ' [' || coalesce(alert_level, '?') || ']' AS caption FROM alerts""")
def alert_label_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.captions(v.alerts(spark, sf_dir)).select("flow_id", "caption")


@query(f"""WITH {v.ALERTS_SQL} SELECT flow_id, epoch_us("at") AS at_us, CAST(hour("at") AS INTEGER) AS hour, CAST(minute("at") AS INTEGER) AS minute,
  CAST(CAST("at" AS DATE) AS VARCHAR) AS day FROM alerts""")
def event_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = analytics.with_event_time(v.alerts(spark, sf_dir).drop("at"))
    return parsed.select(
        "flow_id", micros("at").alias("at_us"), "hour", "minute", F.col("date").cast("string").alias("day")
    )


@query(f"WITH {v.ALERTS_SQL} SELECT DISTINCT proto FROM alerts")
def distinct_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distinct_values(v.alerts(spark, sf_dir), "proto")


@query(f"""WITH {v.PACKETS_SQL} SELECT 'protocol' AS "column", protocol AS value, count(*) AS count FROM packets GROUP BY ALL
UNION ALL SELECT 'flags', flags, count(*) FROM packets GROUP BY ALL""")
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.profile(v.packets(spark, sf_dir), ["protocol", "flags"]).select("column", "value", "count")
