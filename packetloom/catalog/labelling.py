"""Label-store queries over the alerts.

Alerts carry no duration, which the scan rule reads as 0: TCP alerts on a high port count as scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.functions.rules import WHITELIST
from packetloom.operators import labels
from packetloom.schemas import LABEL_ROW
from packetloom.session import shared_path
from packetloom.sources.buckets import BucketTable

query = Catalog()

_STORE_SQL = f"""{v.ALERTS_SQL},
imported AS (SELECT *, round(risk_score, 2) / 100.0 AS model_score FROM alerts),
ruled AS (SELECT *, CASE WHEN src IN ('192.168.1.100', '10.0.0.1') THEN 'RULE_WHITELIST' WHEN proto = 'TCP' AND dst_port > 1024 THEN 'RULE_NMAP'
  WHEN model_score < 0.001 THEN 'RULE_LOW_RISK_MODEL' WHEN model_score > 0.999 THEN 'RULE_HIGH_RISK_MODEL' END AS annotator_id FROM imported),
store AS (SELECT flow_id, src, dst, proto, alert_level, model_score, annotator_id,
  CASE annotator_id WHEN 'RULE_WHITELIST' THEN 'NORMAL' WHEN 'RULE_NMAP' THEN 'PortScan' WHEN 'RULE_LOW_RISK_MODEL' THEN 'NORMAL' WHEN 'RULE_HIGH_RISK_MODEL' THEN 'Attack' END AS label,
  CASE annotator_id WHEN 'RULE_WHITELIST' THEN 1.0 WHEN 'RULE_NMAP' THEN 0.9 WHEN 'RULE_LOW_RISK_MODEL' THEN 0.8 WHEN 'RULE_HIGH_RISK_MODEL' THEN 0.8 ELSE 0.0 END::DOUBLE AS label_confidence,
  CASE WHEN annotator_id IS NULL THEN 'UNLABELED' ELSE 'PSEUDO_LABELED' END AS label_status
  FROM ruled),
prioritised AS (SELECT *, 1 - 2 * abs(model_score - 0.5) AS uncertainty,
  CASE WHEN label = 'NORMAL' AND model_score > 0.8 THEN 1.0 WHEN label <> 'NORMAL' AND model_score < 0.2 THEN 1.0 ELSE 0.0 END::DOUBLE AS conflict_score FROM store),
hard AS (SELECT *, round(conflict_score * 2 + uncertainty, 9) AS review_priority FROM prioritised ORDER BY round(conflict_score * 2 + uncertainty, 9) DESC, flow_id LIMIT 50),
marked AS (SELECT store.* REPLACE (CASE WHEN hard.flow_id IS NOT NULL THEN 'HUMAN_REVIEW_NEEDED' ELSE store.label_status END AS label_status) FROM store LEFT JOIN hard USING (flow_id)),
updates AS (SELECT flow_id, 'DoS' AS new_label, 'analyst' AS annotator_id FROM alerts WHERE alert_level = 'CRITICAL' UNION ALL SELECT 'unknown', 'DoS', 'analyst')"""


@query(f"WITH {_STORE_SQL} SELECT flow_id, round(model_score, 4) AS model_score, NULL::VARCHAR AS label, 'UNLABELED' AS label_status FROM imported")
def import_label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    imported = labels.import_alerts(v.alerts(spark, sf_dir))
    return imported.select("flow_id", F.round("model_score", 4).alias("model_score"), "label", "label_status")


@query(f"""WITH {_STORE_SQL} SELECT flow_id, label, label_status, label_confidence, annotator_id,
  CASE WHEN label IS NULL THEN 0 ELSE 1 END AS audit_entries FROM store""")
def auto_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.label_store(spark, sf_dir).select(
        "flow_id", "label", "label_status", "label_confidence", "annotator_id", F.size("audit_log").alias("audit_entries")
    )


def _scan_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with duration and a lower score range, so that the scan rule fires as well."""
    flows = v.scored_flows(spark, sf_dir)
    return flows.withColumn("model_score", F.lit(0.0005) + F.col("xgb_prob") * 0.999)


@query(f"""WITH {v.SCORED_SQL}, f AS (SELECT *, 0.0005 + xgb_prob * 0.999 AS model_score FROM scored),
r AS (SELECT flow_id, CASE WHEN src_ip IN ('192.168.1.100', '10.0.0.1') THEN 'RULE_WHITELIST'
  WHEN duration < 0.001 AND dst_port > 1024 AND lower(proto) = 'tcp' THEN 'RULE_NMAP'
  WHEN model_score < 0.001 THEN 'RULE_LOW_RISK_MODEL' WHEN model_score > 0.999 THEN 'RULE_HIGH_RISK_MODEL' END AS rule FROM f)
SELECT rule, count(*) AS count FROM r GROUP BY rule""")
def auto_label_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labels.auto_label(_scan_flows(spark, sf_dir), at=v.NOW)
    return labelled.groupBy(F.col("annotator_id").alias("rule")).agg(F.count(F.lit(1)).alias("count"))


def marked_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.mark_for_review(v.label_store(spark, sf_dir))


@query(f"""WITH {_STORE_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE label_status = 'VERIFIED') AS verified,
  count(*) FILTER (WHERE label_status = 'PSEUDO_LABELED') AS pseudo_labeled, count(*) FILTER (WHERE label_status = 'HUMAN_REVIEW_NEEDED') AS pending_review FROM marked""")
def label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_stats(marked_store(spark, sf_dir))


@query(f"WITH {_STORE_SQL} SELECT flow_id, round(uncertainty, 7) AS uncertainty, conflict_score, round(review_priority, 7) AS review_priority FROM hard")
def hard_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = labels.select_hard_samples(v.label_store(spark, sf_dir))
    return chosen.select(
        "flow_id", F.round("uncertainty", 7).alias("uncertainty"), "conflict_score",
        F.round("review_priority", 7).alias("review_priority"),
    )


@query(f"WITH {_STORE_SQL} SELECT flow_id, label_status FROM marked WHERE label_status = 'HUMAN_REVIEW_NEEDED' ORDER BY flow_id LIMIT 10")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.review_queue(marked_store(spark, sf_dir)).select("flow_id", "label_status")


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical = v.alerts(spark, sf_dir).where("alert_level = 'CRITICAL'").select("flow_id")
    unknown = spark.range(1).select(F.lit("unknown").alias("flow_id"))
    return critical.unionByName(unknown).select(
        "flow_id", F.lit("DoS").alias("new_label"), F.lit("analyst").alias("annotator_id")
    )


@query(f"""WITH {_STORE_SQL} SELECT s.flow_id, coalesce(u.new_label, s.label) AS label,
  CASE WHEN u.flow_id IS NULL THEN s.label_status ELSE 'VERIFIED' END AS label_status,
  CASE WHEN u.flow_id IS NULL THEN s.label_confidence ELSE 1.0 END AS label_confidence, coalesce(u.annotator_id, s.annotator_id) AS annotator_id
FROM store s LEFT JOIN updates u ON s.flow_id = u.flow_id""")
def label_update_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated = labels.update_labels(v.label_store(spark, sf_dir), verdicts(spark, sf_dir), at=v.NOW)
    return updated.select("flow_id", "label", "label_status", "label_confidence", "annotator_id")


@query(f"""WITH {_STORE_SQL} SELECT flow_id, 0 AS position, '{v.NOW}' AS ts, 'AUTO_LABEL' AS action, NULL::VARCHAR AS old_label, label AS new_label, annotator_id AS "by"
FROM store WHERE label IS NOT NULL
UNION ALL SELECT s.flow_id, CASE WHEN s.label IS NULL THEN 0 ELSE 1 END, '{v.NOW}', 'MANUAL_UPDATE', s.label, u.new_label, u.annotator_id FROM store s JOIN updates u ON s.flow_id = u.flow_id""")
def audit_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated = labels.update_labels(v.label_store(spark, sf_dir), verdicts(spark, sf_dir), at=v.NOW)
    return labels.audit_entries(updated)


@query(f"""WITH {_STORE_SQL}, changes AS (SELECT flow_id, 'Malware' AS label, 'VERIFIED' AS label_status FROM alerts WHERE alert_level = 'HIGH'
  UNION ALL SELECT md5(flow_id), 'PortScan', 'VERIFIED' FROM alerts WHERE alert_level = 'MEDIUM')
SELECT flow_id, label, label_status FROM store WHERE flow_id NOT IN (SELECT flow_id FROM changes) UNION ALL SELECT * FROM changes""")
def label_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = v.alerts(spark, sf_dir)
    verified = F.lit("VERIFIED").alias("label_status")
    replaced = alerts.where("alert_level = 'HIGH'").select("flow_id", F.lit("Malware").alias("label"), verified)
    added = alerts.where("alert_level = 'MEDIUM'").select(
        F.md5(F.col("flow_id").cast("binary")).alias("flow_id"), F.lit("PortScan").alias("label"), verified
    )
    store = BucketTable(spark, shared_path(spark, "labels"), LABEL_ROW, buckets=16)
    store.save(v.label_store(spark, sf_dir))
    store.upsert(replaced.unionByName(added))
    return store.load().select("flow_id", "label", "label_status")


_LIST = ", ".join(f"'{ip}'" for ip in WHITELIST)


@query(f"WITH {v.ALERTS_SQL} SELECT flow_id, src IN ({_LIST}) AS whitelisted FROM alerts")
def whitelist_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.alerts(spark, sf_dir).select("flow_id", F.col("src").isin(*WHITELIST).alias("whitelisted"))


@query(f"""WITH {v.PACKETS_SQL} SELECT src_ip, dst_ip, packet_id, length FROM
  (SELECT *, row_number() OVER (PARTITION BY src_ip, dst_ip ORDER BY ts, packet_id) AS n FROM packets) q WHERE n = 1""")
def first_packet_per_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.packets(spark, sf_dir).select("src_ip", "dst_ip", "ts", "packet_id", "length")
    return labels.first_per_key(rows, ["src_ip", "dst_ip"], ["ts", "packet_id"]).drop("ts")
