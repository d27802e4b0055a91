"""Packets or flows to a fitted detector: features, scaling, encoding and a classifier in one saved model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators.evaluation import class_report
from packetloom.operators.features import (
    drop_leakage,
    fit_preprocessing,
    model_inputs,
    require_classes,
    with_binary_label,
)
from packetloom.operators.learners import LABEL, SEED, VECTOR, estimator
from packetloom.operators.sampling import stratified_split


@dataclass
class Detector:
    """``model`` holds every step; ``report`` is the class report on the held-out rows."""

    model: PipelineModel
    report: DataFrame

    def predict(self, rows: DataFrame) -> DataFrame:
        return predict(self.model, rows)


def fit_detector(
    rows: DataFrame,
    key: Sequence[str],
    kind: str = "wide",
    params: Mapping | None = None,
    test_share: float = 0.2,
    seed: int = SEED,
) -> Detector:
    """Fit on a stratified share of labelled rows. Statistics come from the training rows only, and the fitted steps are
    the ones that later score batches and streams.
    """
    labelled = drop_leakage(with_binary_label(rows, LABEL)).drop("label")
    require_classes(labelled, LABEL)
    split = stratified_split(labelled, LABEL, key, test_share)
    train, test = split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
    steps = fit_preprocessing(train, exclude=[*key, LABEL])
    prepared = steps.transform(train)
    assembler = VectorAssembler(inputCols=model_inputs(prepared, [*key, LABEL]), outputCol=VECTOR, handleInvalid="keep")
    classifier = estimator(kind, params, seed=seed).fit(assembler.transform(prepared))
    model = PipelineModel([*steps.stages, assembler, classifier])
    judged = model.transform(test).select(LABEL, F.col("prediction").cast("int").alias("prediction"))
    return Detector(model, class_report(judged, LABEL))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every row with its class and confidence (the largest class probability)."""
    # the steps replace their input columns, so the row as it came travels along
    scored = model.transform(rows.withColumn("__row", F.struct(*rows.columns)))
    confidence = F.array_max(vector_to_array("probability"))
    return scored.select("__row.*", F.col("prediction").cast("int").alias("class"), confidence.alias("confidence"))
