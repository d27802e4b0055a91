"""Label store: import, automatic labels, review selection, human updates, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.functions.columns import append_audit, audit_entry
from packetloom.functions.hashing import stable_id
from packetloom.functions.rules import (
    WHITELIST,
    auto_label_rule,
    conflict,
    review_priority,
    uncertainty,
)
from packetloom.schemas import AUDIT_LOG, LABEL_STATUSES, column_or, ensure_columns

ALERT_KEY = ("timestamp", "src", "dst", "src_port", "dst_port", "proto")


def _no_text() -> Column:
    return F.lit(None).cast("string")


def import_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts as unlabelled rows of the label store.

    ``flow_id`` is kept when present, else derived from the key columns, so importing twice gives the same ids.
    """
    score = F.col("risk_score") / 100.0 if "risk_score" in alerts.columns else F.lit(0.5)
    flow_id = (
        F.col("flow_id")
        if "flow_id" in alerts.columns
        else stable_id(*[F.col(c) for c in ALERT_KEY if c in alerts.columns])
    )
    return alerts.withColumns(
        {
            "flow_id": flow_id,
            "model_score": score.cast("double"),
            "label": _no_text(),
            "label_status": F.lit("UNLABELED"),
        }
    )


def _source_ip(df: DataFrame) -> Column:
    """Label rows carry ``src_ip``, alerts carry ``src``."""
    return F.coalesce(column_or(df, "src_ip", None, "string"), column_or(df, "src", None, "string"))


def auto_label(
    flows: DataFrame,
    at: str | Column,
    whitelist: Sequence[str] = WHITELIST,
    strict_case: bool = False,
) -> DataFrame:
    """Apply the label rules to every row. ``at`` is the audit time, a parameter so that reruns agree."""
    known = ensure_columns(flows, {"audit_log": (AUDIT_LOG.simpleString(), None), "annotator_id": ("string", None)})
    rule = auto_label_rule(
        _source_ip(flows),
        column_or(flows, "duration", 0.0, "double").try_cast("double"),
        column_or(flows, "dst_port", 0, "int").try_cast("int"),
        column_or(flows, "proto", "", "string"),
        column_or(flows, "model_score", None, "double").try_cast("double"),
        whitelist,
        strict_case,
    )
    at_time = F.lit(at) if isinstance(at, str) else at
    hit = F.col("rule.label").isNotNull()
    entry = audit_entry(at_time, "AUTO_LABEL", _no_text(), F.col("rule.label"), F.col("rule.rule"))
    return (
        known.withColumn("rule", rule)
        .withColumns(
            {
                "label": F.col("rule.label"),
                "label_status": F.when(hit, F.lit("PSEUDO_LABELED")).otherwise(F.lit("UNLABELED")),
                "label_confidence": F.coalesce(F.col("rule.confidence"), F.lit(0.0)),
                "annotator_id": F.when(hit, F.col("rule.rule")).otherwise(F.col("annotator_id")),
                "audit_log": F.when(hit, append_audit(F.col("audit_log"), entry)).otherwise(
                    F.coalesce(F.col("audit_log"), F.array().cast(AUDIT_LOG))
                ),
            }
        )
        .drop("rule")
    )


def with_review_priority(store: DataFrame) -> DataFrame:
    score = F.col("model_score").cast("double")
    return store.withColumns(
        {"uncertainty": uncertainty(score), "conflict_score": conflict(F.col("label"), score)}
    ).withColumn("review_priority", review_priority(F.col("conflict_score"), F.col("uncertainty")))


def select_hard_samples(store: DataFrame, top_k: int = 50) -> DataFrame:
    """The ``top_k`` rows most worth a human look; ties go to the smaller ``flow_id``."""
    return with_review_priority(store).orderBy(F.col("review_priority").desc(), "flow_id").limit(top_k)


def mark_for_review(store: DataFrame, top_k: int = 50) -> DataFrame:
    """The whole store with the hard samples set to ``HUMAN_REVIEW_NEEDED``."""
    chosen = select_hard_samples(store, top_k).select("flow_id", F.lit(True).alias("chosen"))
    return (
        with_review_priority(store)
        .join(chosen, "flow_id", "left")
        .withColumn(
            "label_status",
            F.when(F.col("chosen"), F.lit("HUMAN_REVIEW_NEEDED")).otherwise(F.col("label_status")),
        )
        .drop("chosen")
    )


def review_queue(store: DataFrame, status: str = "HUMAN_REVIEW_NEEDED", first: int = 10) -> DataFrame:
    return by_status(store, status).orderBy("flow_id").limit(first)


def by_status(store: DataFrame, status: str) -> DataFrame:
    if status not in LABEL_STATUSES:
        raise ValueError(f"unknown label status {status}")
    return store.where(F.col("label_status") == status)


def label_stats(store: DataFrame) -> DataFrame:
    status = F.col("label_status")
    return store.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "VERIFIED").alias("verified"),
        F.count_if(status == "PSEUDO_LABELED").alias("pseudo_labeled"),
        F.count_if(status == "HUMAN_REVIEW_NEEDED").alias("pending_review"),
    )


def update_labels(store: DataFrame, updates: DataFrame, at: str | Column) -> DataFrame:
    """Human verdicts ``(flow_id, new_label, annotator_id)``; ids the store does not hold are ignored.

    Of several verdicts on one id the newest by the optional column ``verdict_time`` counts, without one or in a tie the
    largest (label, annotator), so a row is never multiplied and reruns agree. The store must not hold an id twice, see
    ``duplicate_keys``. The join side is left to the optimizer: a short review list is broadcast, a bulk import is shuffled.
    """
    at_time = F.lit(at) if isinstance(at, str) else at
    verdicts = (
        updates.groupBy("flow_id")
        .agg(
            F.max(
                F.struct(
                    column_or(updates, "verdict_time", None, "timestamp").alias("__when"),
                    F.col("new_label").alias("__new"),
                    F.col("annotator_id").alias("__by"),
                )
            ).alias("v")
        )
        .select("flow_id", "v.__new", "v.__by", F.lit(True).alias("__hit"))
    )
    entry = audit_entry(at_time, "MANUAL_UPDATE", F.col("label"), F.col("__new"), F.col("__by"))
    hit = F.col("__hit").isNotNull()
    changed = {
        "audit_log": F.when(hit, append_audit(F.col("audit_log"), entry)).otherwise(F.col("audit_log")),
        "label": F.when(hit, F.col("__new")).otherwise(F.col("label")),
        "label_status": F.when(hit, F.lit("VERIFIED")).otherwise(F.col("label_status")),
        "label_confidence": F.when(hit, F.lit(1.0)).otherwise(F.col("label_confidence")),
        "annotator_id": F.when(hit, F.col("__by")).otherwise(F.col("annotator_id")),
    }
    full = ensure_columns(
        store,
        {
            "audit_log": (AUDIT_LOG.simpleString(), None),
            "label_confidence": ("double", None),
            "annotator_id": ("string", None),
        },
    )
    return full.join(verdicts, "flow_id", "left").withColumns(changed).drop("__new", "__by", "__hit")


def upsert(store: DataFrame, changes: DataFrame, key: str = "flow_id", order: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``changes`` replace rows with the same key and are added where the key is new.

    Of several changes of one key the last by ``order`` enters the store (default: by all other columns that have an order).
    """
    rest = [c for c in changes.columns if c != key]
    ordering = order or [c for c in rest if not isinstance(changes.schema[c].dataType, (T.MapType, T.VariantType))]
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*ordering)).alias("__row")).select(key, "__row.*")
    return store.join(newest, key, "left_anti").unionByName(newest.select(*changes.columns), allowMissingColumns=True)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order.

    One aggregate keeps the smallest row per key map-side; a row-number window would sort every copy of a hot key.
    """
    rest = [c for c in df.columns if c not in key]
    ordering = F.struct(*order)
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), ordering).alias("__row"))
    return picked.select(*key, "__row.*").select(*df.columns)


def duplicate_keys(df: DataFrame, key: Sequence[str] = ("flow_id",)) -> DataFrame:
    """Keys that occur more than once; an empty result means updates by key are unambiguous."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def parse_audit_text(text: Column) -> Column:
    """Audit log kept as JSON text back to an array."""
    return F.from_json(text, AUDIT_LOG)


def audit_entries(store: DataFrame, key: str = "flow_id") -> DataFrame:
    """One row per audit entry with its position."""
    return store.select(key, F.posexplode("audit_log").alias("position", "entry")).select(key, "position", "entry.*")
