"""Source and sink queries: Spark derives files from the sample tables, the readers read them back."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import labelling, learning, traffic
from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.functions.columns import protocol_name
from packetloom.functions.rules import register_sql_functions
from packetloom.operators import features, labels
from packetloom.operators.analytics import filter_dates_levels
from packetloom.operators.evaluation import confusion
from packetloom.schemas import ALERT, FLOW, LABEL_ROW, PACKET
from packetloom.session import shared_path
from packetloom.sources import captures, readers, writers
from packetloom.sources.buckets import BucketTable

query = Catalog()

LINK_BYTES = 14


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.hex(value.cast("bigint")), digits, "0")


def _address(ip: Column) -> Column:
    parts = F.split(ip, r"\.")
    return F.concat(*[_hex(F.get(parts, F.lit(i)), 2) for i in range(4)])


def captures_from(packets: DataFrame) -> DataFrame:
    """One big-endian Ethernet capture per packet, built by column expressions."""
    flags = F.col("flags")
    bits = sum(
        (F.when(F.contains(flags, F.lit(letter)), F.lit(1 << i)).otherwise(F.lit(0)) for i, letter in enumerate("FSRPA")),
        F.lit(0),
    )
    number = (
        F.when(F.col("protocol") == "TCP", 6).when(F.col("protocol") == "UDP", 17).when(F.col("protocol") == "ICMP", 1).otherwise(47)
    )
    ports = F.concat(_hex(F.col("src_port"), 4), _hex(F.col("dst_port"), 4))
    transport = (
        F.when(number == 6, F.concat(ports, F.lit("0" * 16 + "50"), _hex(bits, 2), F.lit("0" * 12)))
        .when(number == 17, F.concat(ports, F.lit("0" * 8)))
        .otherwise(F.lit("0" * 16))
    )
    ip = F.concat(
        F.lit("4500"), _hex(F.col("length"), 4), F.lit("00000000"), _hex(F.col("ttl"), 2), _hex(number, 2), F.lit("0000"),
        _address(F.col("src_ip")), _address(F.col("dst_ip")),
    )
    frame = F.concat(F.lit("0" * 24 + "0800"), F.rpad(F.concat(ip, transport), 2 * F.col("length"), F.lit("0")))
    micros = F.unix_micros("ts")
    size = F.col("length") + LINK_BYTES
    record = F.concat(
        _hex(F.floor(micros / 1_000_000), 8), _hex(F.pmod(micros, F.lit(1_000_000)), 8), _hex(size, 8), _hex(size, 8), frame
    )
    header = F.lit("a1b2c3d4" + "00020004" + "00000000" + "00000000" + "0000ffff" + "00000001")
    return packets.select(
        F.concat(F.lit("capture-"), F.col("packet_id").cast("string")).alias("path"),
        F.unhex(F.concat(header, record)).alias("content"),
    )


@query(f"""WITH {v.PACKETS_SQL} SELECT 'capture-' || packet_id::VARCHAR AS path, epoch_us(ts) AS ts_us, src_ip, dst_ip,
  CASE WHEN protocol IN ('TCP', 'UDP') THEN src_port ELSE 0 END AS src_port, CASE WHEN protocol IN ('TCP', 'UDP') THEN dst_port ELSE 0 END AS dst_port,
  CASE WHEN protocol = 'OTHER' THEN '47' ELSE protocol END AS protocol, length + 14 AS length, flags, ttl, 0 AS label FROM packets""")
def pcap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = captures.decode_captures(captures_from(v.packets(spark, sf_dir)))
    return decoded.select(
        "path", F.round(F.col("timestamp") * 1e6).cast("bigint").alias("ts_us"), "src_ip", "dst_ip", "src_port", "dst_port",
        "protocol", "length", "flags", "ttl", "label",
    )


@query(f"WITH {v.FLOWS_SQL} SELECT src_ip, dst_ip, protocol, length, round(duration, 5) AS duration, 'local_normal' AS source_type, true AS stamped FROM flows")
def recent_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow CSV files written by the export and read back as the normal-traffic pool."""
    folder = writers.export_csv(v.flows(spark, sf_dir).select(*FLOW.names), "normal")
    pool = readers.read_pool(spark, folder, FLOW, "local_normal")
    return pool.select(
        "src_ip", "dst_ip", "protocol", "length", F.round("duration", 5).alias("duration"), "source_type",
        F.col(readers.FILE_TIME).isNotNull().alias("stamped"),
    )


@query(f"WITH {v.PACKETS_SQL} SELECT timestamp, src_ip, dst_ip, protocol, length, flags, ttl, label FROM packets")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark packets as CSV; a second file that does not exist adds nothing."""
    path = shared_path(spark, "benchmark")
    writers.write_csv(v.packets(spark, sf_dir).select(*PACKET.names), path)
    return readers.read_csv(spark, path, PACKET).unionByName(readers.read_csv(spark, f"{path}-absent", PACKET))


@query(f"WITH {v.FLOWS_SQL} SELECT src_ip, dst_ip, protocol, length, 'local_attack' AS source_type FROM flows WHERE protocol = 'OTHER'")
def attack_pool_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verified attack file of a folder."""
    folder = writers.export_csv(v.flows(spark, sf_dir).where("protocol = 'OTHER'").select(*FLOW.names), "attacks")
    pool = readers.read_pool(spark, folder, FLOW, "local_attack")
    return pool.select("src_ip", "dst_ip", "protocol", "length", "source_type")


@query(f"WITH {v.PACKETS_SQL} SELECT timestamp, src_ip, protocol, length FROM packets WHERE label = 1")
def newest_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three older files and two newer ones: the two newest are read."""
    path = shared_path(spark, "normal")
    packets = v.packets(spark, sf_dir).select(*PACKET.names)
    writers.write_csv(packets.where("label = 0").repartition(3), path)
    time.sleep(0.05)  # file times have milliseconds
    writers.write_csv(packets.where("label = 1").repartition(2), path, mode="append")
    pool = readers.read_pool(spark, path, PACKET, "local_normal", max_files=2)
    return pool.select("timestamp", "src_ip", "protocol", "length")


@query(f"""WITH {v.ALERTS_SQL} SELECT alert_level, count(*) AS alerts, sum(final_label)::BIGINT AS attacks, max(src) AS last_source FROM alerts GROUP BY 1""")
def jsonl_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert lines read without a schema."""
    path = shared_path(spark, "alerts")
    writers.append_jsonl(v.alerts(spark, sf_dir), path)
    read = readers.read_jsonl_inferred(spark, path)
    return read.groupBy("alert_level").agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("final_label").alias("attacks"), F.max("src").alias("last_source")
    )


@query(learning.query.oracle["confusion_binary"])
def json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics written as a report and read back."""
    path = shared_path(spark, "report")
    metrics = learning.confusion_binary(spark, sf_dir)
    for _ in range(2):  # a second report replaces the first
        writers.write_report(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@query(f"""WITH {learning._JUDGED_SQL}, c AS (SELECT count(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp FROM judged)
SELECT tp, fp, '{v.NOW}' AS timestamp FROM c UNION ALL SELECT tp, fp, '2024-02-02T00:00:00' FROM c""")
def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to the metric history."""
    path = shared_path(spark, "history")
    metrics = confusion(learning.judged_flows(spark, sf_dir)).select("tp", "fp")
    for at in (v.NOW, "2024-02-02T00:00:00"):
        writers.append_history(metrics, path, at)
    return spark.read.schema("tp bigint, fp bigint, timestamp string").json(path)


@query(f"WITH {v.FLOWS_SQL} SELECT flow_id, duration, pkts_total, syn_count FROM flows")
def anomaly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns without labels, ports, times and names that start with an underscore."""
    rows = v.flows(spark, sf_dir).select("flow_id", "ts", "src_port", "dst_port", "protocol", "duration", "pkts_total", "syn_count")
    rows = rows.withColumns({"label": F.lit(0), "_hidden": F.lit(1.0)})
    return rows.select("flow_id", *features.anomaly_feature_names(rows))


@query(f"WITH {v.PACKETS_SQL} SELECT packet_id, ttl, length FROM packets")
def strict_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.strict_select(v.packets(spark, sf_dir), ["ttl", "length"], keep=["packet_id"])


@query(f"WITH {v.PACKETS_SQL} SELECT label, count(*) AS packets FROM packets GROUP BY 1")
def guarded_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class of a table that passes the two-class guard."""
    packets = v.packets(spark, sf_dir)
    features.require_classes(packets, "label")
    return packets.groupBy("label").agg(F.count(F.lit(1)).alias("packets"))


@query(f"""WITH {v.PACKETS_SQL} SELECT packet_id, protocol AS name, CASE protocol WHEN 'OTHER' THEN '47' ELSE protocol END AS name_or_number FROM packets""")
def protocol_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protocol numbers, as a capture holds them, turned into names."""
    kind = F.col("protocol")
    number = F.when(kind == "TCP", 6).when(kind == "UDP", 17).when(kind == "ICMP", 1).otherwise(47)
    rows = v.packets(spark, sf_dir).select("packet_id", number.alias("number"))
    names = {"name": protocol_name(F.col("number")), "name_or_number": protocol_name(F.col("number"), other=None)}
    return rows.withColumns(names).drop("number")


@query(labelling.query.oracle["audit_explode"])
def audit_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit logs kept as JSON text, parsed and listed."""
    updated = labels.update_labels(v.label_store(spark, sf_dir), labelling.verdicts(spark, sf_dir), at=v.NOW)
    stored = updated.select("flow_id", F.to_json("audit_log").alias("text"))
    return labels.audit_entries(stored.select("flow_id", labels.parse_audit_text(F.col("text")).alias("audit_log")))


@query(f"WITH {v.ALERTS_SQL} SELECT src, dst, dst_port, proto, round(xgb_prob, 7) AS xgb_prob, final_label, round(risk_score, 2) AS risk_score, alert_level, reasons FROM alerts")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert lines with damaged lines between them; only the damaged ones are skipped."""
    alerts = v.alerts(spark, sf_dir)
    record = F.to_json(F.struct(*[c for c in ALERT.names if c in alerts.columns]))
    damaged = F.concat(F.lit('{"timestamp": "'), F.col("flow_id"))
    lines = alerts.select(F.explode(F.array(record, F.when(F.col("src_port") == 0, damaged))).alias("line")).where("line IS NOT NULL")
    path = shared_path(spark, "alerts")
    lines.write.text(path)
    read = readers.read_jsonl(spark, path)
    return read.select(
        "src", "dst", "dst_port", "proto", F.round("xgb_prob", 7).alias("xgb_prob"), "final_label", "risk_score",
        "alert_level", "reasons",
    )


@query(traffic.query.oracle["date_level_filter"])
def partitioned_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts stored below one folder per day, then filtered by date and level."""
    path = shared_path(spark, "alerts")
    alerts = v.alerts(spark, sf_dir)
    writers.append_alerts(alerts, path)
    stored = spark.read.parquet(path).where(F.col("dt").between("2024-01-05", "2024-01-12")).drop("dt")
    return traffic._alert_output(filter_dates_levels(stored, "2024-01-05", "2024-01-12", ["HIGH", "CRITICAL"]))


@query(labelling.query.oracle["label_update_audit"])
def label_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label store saved in buckets and updated from its own contents: only the buckets of the verdicts are rewritten."""
    store = BucketTable(spark, shared_path(spark, "labels"), LABEL_ROW, buckets=16)
    store.save(v.label_store(spark, sf_dir))
    store.rewrite(labelling.verdicts(spark, sf_dir), lambda rows, verdicts: labels.update_labels(rows, verdicts, at=v.NOW))
    return store.load().select("flow_id", "label", "label_status", "label_confidence", "annotator_id")


@query(f"""WITH {learning._JUDGED_SQL} SELECT flow_id, round(least(100.0, CASE WHEN prediction = 1 THEN probability * 60.0 ELSE 0.0 END
    + CASE WHEN anomaly_score < -0.12 THEN least(70.0, abs(anomaly_score + 0.12) * 200.0 + 30.0) ELSE 0.0 END), 7) AS risk,
  round(least(100.0, CASE WHEN prediction = 1 AND probability >= 0.9 THEN probability * 60.0 ELSE 0.0 END
    + CASE WHEN anomaly_score < -0.12 THEN least(70.0, abs(anomaly_score + 0.12) * 200.0 + 30.0) ELSE 0.0 END), 7) AS risk_if_known,
  round(1 - 2 * abs(probability - 0.5), 7) AS unsure,
  CASE WHEN prediction = 1 AND probability > 0.8 THEN 1.0 ELSE 0.0 END::DOUBLE AS conflict FROM judged""")
def sql_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules called as SQL functions; risk_if_known takes uncertain probabilities as missing."""
    register_sql_functions(spark)
    learning.judged_flows(spark, sf_dir).createOrReplaceTempView("judged_flows")
    return spark.sql(
        """SELECT flow_id, round(fusion_risk(prediction, probability, anomaly_score), 7) AS risk,
             round(fusion_risk(prediction, CASE WHEN probability >= 0.9 THEN probability END, anomaly_score), 7) AS risk_if_known,
             round(label_uncertainty(probability), 7) AS unsure,
             label_conflict(CASE WHEN prediction = 1 THEN 'NORMAL' END, probability) AS conflict
           FROM judged_flows"""
    )


#: The fourteen model features of a flow; counts and flags are whole numbers.
MODEL_FEATURES = [
    "duration", "pkts_total", "bytes_total", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes", "pkts_per_sec", "bytes_per_sec",
    "iat_mean", "iat_std", "syn_count", "ack_count", "rst_count",
]
_SCALED = ["length_log", *MODEL_FEATURES]


@query(f"""WITH {v.FLOWS_SQL}, logs AS (SELECT flow_id, protocol, ln(1 + length) AS length_log, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)} FROM flows),
s AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_SCALED))} FROM logs)
SELECT flow_id, {", ".join(f"round(({c} - m{i}) / CASE WHEN s{i} > 1e-12 THEN s{i} ELSE 1 END, 5) AS {c}" for i, c in enumerate(_SCALED))}, """ + ", ".join(
    f"CAST(protocol = '{p}' AS INTEGER)::DOUBLE AS protocol_{p}" for p in ("ICMP", "OTHER", "TCP", "UDP")
) + " FROM logs, s")
def saved_preprocessing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature steps fitted on whole flows with all model features, saved, loaded and applied."""
    rows = v.flows(spark, sf_dir).select("flow_id", "length", "protocol", *MODEL_FEATURES)
    path = shared_path(spark, "fitted")
    writers.save_fitted(features.fit_preprocessing(rows, exclude=["flow_id"]), path)
    applied = writers.load_fitted(path).transform(rows)
    return applied.withColumns({c: F.round(c, 5) for c in _SCALED})
