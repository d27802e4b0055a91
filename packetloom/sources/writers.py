"""Sinks. Spark writes one file per task; nothing is gathered on the driver."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.schemas import record
from packetloom.session import delete, shared_path
from packetloom.sources.readers import empty


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append alert or metric records."""
    df.write.mode("append").partitionBy(*partition_by).json(path)


def append_alerts(alerts: DataFrame, path: str, time_col: str = "at", file_format: str = "parquet") -> None:
    """Append alerts below ``dt=<date>``, so that date filters skip whole folders.

    The rebalance hint gathers the rows of a date into few files and splits a date that got most of the alerts.
    """
    dated = alerts.withColumn("dt", F.to_date(time_col)).hint("rebalance", "dt")
    dated.write.mode("append").partitionBy("dt").format(file_format).save(path)


def write_report(report: DataFrame, path: str) -> None:
    """Small aggregated report as JSON, replacing an earlier one."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_history(metrics: DataFrame, path: str, at: str | Column) -> None:
    at_time = F.lit(at) if isinstance(at, str) else at
    metrics.withColumn("timestamp", at_time).write.mode("append").json(path)


class SnapshotTable:
    """Whole-table store: every save is a new version below ``path``, announced by a one-row commit record.

    Readers take the newest announced version, so the table a save reads from is never overwritten and a save
    that fails half-way leaves the old version valid.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json"):
        self.spark, self.path, self.schema, self.file_format = spark, path.rstrip("/"), schema, file_format

    def versions(self) -> list[str]:
        """Announced versions, oldest first; their number stays small with ``prune``."""
        commits = record(version="string", number="bigint")
        try:
            rows = self.spark.read.schema(commits).json(f"{self.path}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in (error.getCondition() or ""):
                return []
            raise
        return [r["version"] for r in rows.orderBy("number").collect()]

    def load(self) -> DataFrame:
        found = self.versions()
        if not found:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).format(self.file_format).load(f"{self.path}/{found[-1]}")

    def save(self, df: DataFrame, base: str | None = None) -> str:
        """Write and announce a new version. ``base`` names the version ``df`` was made from (default: the newest now).

        When another save has been announced since, this one fails before it announces anything, so no change is lost in
        silence: load again and repeat the change. Each number has a commit folder of its own that is never written twice.
        """
        before = self.versions()
        if base is not None and before[-1:] != [base]:
            raise SaveConflict(f"{base} is not the newest version of {self.path}")
        number = int(before[-1].split("-")[1]) + 1 if before else 1
        version = f"version-{number:06d}-{uuid.uuid4().hex[:8]}"
        df.write.format(self.file_format).save(f"{self.path}/{version}")
        if self.versions() != before:
            raise SaveConflict(f"another save of {self.path} was announced first")
        commit = self.spark.range(1).select(F.lit(version).alias("version"), F.lit(number).cast("bigint").alias("number"))
        try:
            commit.coalesce(1).write.mode("errorifexists").json(f"{self.path}/commits/save={number:06d}")
        except AnalysisException as error:
            raise SaveConflict(f"another save of {self.path} was announced first") from error
        return version

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all announced versions but the newest ``keep``; tables loaded from them can no longer be read."""
        old = self.versions()[: -max(1, keep)]
        for version in old:
            # the announcement goes first: a version without one is never read
            delete(self.spark, f"{self.path}/commits/save={version.split('-')[1]}")
            delete(self.spark, f"{self.path}/{version}")
        return old


class SaveConflict(RuntimeError):
    """Two saves of one table at a time."""


def save_fitted(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def export_csv(df: DataFrame, name: str = "export") -> str:
    """Filtered rows as CSV below the shared folder; returns the path."""
    path = shared_path(df.sparkSession, name)
    write_csv(df, path)
    return path
