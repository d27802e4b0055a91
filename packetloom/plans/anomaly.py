"""Anomaly models: fit on normal traffic, choose a threshold, judge it on labelled traffic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators.evaluation import best_threshold, binary_metrics, flag_below, percentile_threshold
from packetloom.operators.features import anomaly_feature_names, drop_leakage, fit_preprocessing, model_inputs, with_binary_label
from packetloom.operators.isolation import SAMPLE_SIZE, TREES, Forest, fit_forest
from packetloom.operators.sampling import stratified_split
from packetloom.session import settle

# Retraining policy.
CONTAMINATION = 0.01
PERCENTILE = 99.0
SCORE = "anomaly_score"


def retrain_on_normal(
    normal: DataFrame, key: Sequence[str], contamination: float = CONTAMINATION, percentile: float = PERCENTILE
) -> tuple[Forest, float | None]:
    """Forest on the numeric columns of normal traffic and the score that ``percentile`` percent of it exceed.

    The scores are already shifted by the contamination offset, so with the default policy the threshold is close to 0.
    """
    names = [f for f in anomaly_feature_names(normal) if f not in key]
    forest = fit_forest(normal, names, key, contamination=contamination)
    return forest, percentile_threshold(forest.score(normal).select(SCORE), SCORE, percentile)


@dataclass
class AnomalyDetector:
    steps: PipelineModel
    forest: Forest
    threshold: float
    #: Results of the threshold choice and of the judgement; a loaded detector has those of its training.
    validation: DataFrame
    test: DataFrame

    def save(self, spark: SparkSession, path: str) -> None:
        """Features, forest, threshold and the reports of the training below one folder."""
        self.steps.write().overwrite().save(f"{path}/features")
        self.forest.save(spark, f"{path}/forest")
        self.validation.write.mode("overwrite").parquet(f"{path}/validation")
        self.test.write.mode("overwrite").parquet(f"{path}/test")
        # written last: a folder without it is not complete
        spark.createDataFrame([(float(self.threshold),)], "threshold double").write.mode("overwrite").json(f"{path}/threshold")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> AnomalyDetector:
        threshold = spark.read.schema("threshold double").json(f"{path}/threshold").first()["threshold"]
        steps, forest = PipelineModel.load(f"{path}/features"), Forest.load(spark, f"{path}/forest")
        return cls(steps, forest, threshold, spark.read.parquet(f"{path}/validation"), spark.read.parquet(f"{path}/test"))

    def flag(self, rows: DataFrame) -> DataFrame:
        """Score and verdict for every row of prepared-or-raw traffic columns."""
        return flag_below(self.forest.score(self.steps.transform(rows)), SCORE, self.threshold)


def train_and_tune(
    normal: DataFrame, mixed: DataFrame, key: Sequence[str], trees: int = TREES, sample_size: int = SAMPLE_SIZE
) -> AnomalyDetector:
    """Fit features and forest on ``normal``; half of the labelled ``mixed`` rows choose the threshold with the best F1,
    the other half judges it. Text columns of many values count by how frequent their values are on normal traffic.
    """
    clean = drop_leakage(normal.drop("label"))
    steps = fit_preprocessing(clean, exclude=key, wide="frequency")
    prepared = steps.transform(clean)
    names = model_inputs(prepared, key)
    forest = fit_forest(prepared, names, key, trees, sample_size)
    labelled = drop_leakage(with_binary_label(mixed)).drop("label")
    halves = stratified_split(labelled, "y", key, 0.5)
    # scored once, read by the sweep and by the final judgement
    scored = settle(forest.score(steps.transform(halves)).select(*key, "y", "is_test", SCORE), "scores")
    validation = best_threshold(scored.where(~F.col("is_test")), SCORE)
    threshold = validation.first()["threshold"]
    judged = flag_below(scored.where("is_test"), SCORE, threshold)
    return AnomalyDetector(steps, forest, threshold, validation, binary_metrics(judged))
