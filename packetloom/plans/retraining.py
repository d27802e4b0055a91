"""Retraining as one Spark application: drift check, data mix, hold-out, training, gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from packetloom.operators import drift, evaluation, learners, sampling
from packetloom.operators.features import numeric_feature_names, with_binary_label
from packetloom.session import settle


def retrain_needed(report: DataFrame, threshold: float = drift.WARNING_SCORE) -> bool:
    """Strictly above the threshold."""
    return report.first()["final_score"] > threshold


@dataclass
class RetrainingResult:
    models: list[learners.TrafficModel]
    comparison: DataFrame
    gate: DataFrame
    dataset_report: DataFrame
    zero_day: DataFrame | None
    drift: DataFrame


def retrain(
    benchmark: DataFrame,
    normal: DataFrame,
    attack: DataFrame,
    test: DataFrame,
    key: Sequence[str],
    now: float,
    champion_metrics: DataFrame,
    canary: DataFrame | None = None,
    top_k: int = 20,
    params: Mapping[str, Mapping] | None = None,
    monitored: Sequence[str] = drift.MONITORED,
    **mix,
) -> RetrainingResult:
    """Mix the pools, hold out a zero-day class, train the ensemble and compare it with the champion's metrics.

    The mixed set is read by several training passes, so it is written to the shared folder once. The result also has the
    recall on the held-out class, which no model has seen (none when no class qualifies), and the drift of the
    ``monitored`` columns of the new normal traffic against the benchmark.
    """
    mixed = settle(sampling.build_retrain_set(benchmark, normal, attack, key, now, **mix), "mix")
    split = sampling.zero_day_split(mixed)
    rows = with_binary_label(sampling.finish_retrain_set(split.train))
    names = [f for f in numeric_feature_names(rows) if f not in ("y", *key)]
    features = learners.select_features(rows, names, min(top_k, len(names)), params=(params or {}).get("forest"))
    models, comparison = learners.train_ensemble(rows, test, features, params)
    challenger = ensemble_metrics(models, test)
    canary_metrics = ensemble_metrics(models, canary) if canary is not None else None
    gate = evaluation.promotion_gate(challenger, champion_metrics, canary_metrics)
    zero_day = None
    if split.held_out_class is not None:
        unseen = with_binary_label(sampling.finish_retrain_set(split.held_out))
        zero_day = evaluation.zero_day_recall(learners.ensemble_vote(models, unseen))
    return RetrainingResult(models, comparison, gate, split.report, zero_day, drift.psi(benchmark, normal, monitored))


def ensemble_metrics(models: Sequence[learners.TrafficModel], rows: DataFrame) -> DataFrame:
    """Binary metrics of the soft vote of the models."""
    return evaluation.binary_metrics(learners.ensemble_vote(models, rows), learners.LABEL)
