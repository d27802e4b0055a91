"""Sink for changing rows by key: every micro-batch adds a run, runs are merged level by level.

A run holds the newest row of each of its keys. When ``FAN_IN`` runs of one level are there, they are merged into one run
of the next level, so the number of runs grows with the logarithm of the number of micro-batches and every row is rewritten
once per level. A manifest per micro-batch names the runs that are valid after it; it is written last, and runs
that the last two manifests do not name are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.session import delete, get_text, names_in, put_text

FAN_IN = 8
VERSION = "__version"


class KeyedRuns:
    """Rows by ``keys`` below ``path``; a later micro-batch replaces the row of an earlier one."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], fan_in: int = FAN_IN):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.spark, self.path, self.keys, self.fan_in = spark, path.rstrip("/"), list(keys), fan_in

    def _manifests(self) -> list[int]:
        return [int(name.split(".")[0]) for name in names_in(self.spark, f"{self.path}/manifests") if name.endswith(".json")]

    def _runs(self, batch_id: int) -> list[dict]:
        return json.loads(get_text(self.spark, f"{self.path}/manifests/{batch_id:012d}.json"))

    def runs(self) -> list[str]:
        """Names of the valid runs."""
        found = self._manifests()
        return [r["name"] for r in self._runs(found[-1])] if found else []

    def _newest(self, names: Sequence[str]) -> DataFrame:
        """The newest row of every key, with its version."""
        rows = self.spark.read.parquet(*(f"{self.path}/{name}" for name in names))
        rest = [c for c in rows.columns if c not in self.keys]
        picked = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("__row"))
        return picked.select(*self.keys, "__row.*")

    def absorb(self, batch: DataFrame, batch_id: int) -> None:
        """Add a micro-batch, which holds a key once. Repeating it after a failure starts from the manifest before it."""
        known = self._manifests()
        earlier = [b for b in known if b < batch_id]
        runs = self._runs(earlier[-1]) if earlier else []
        name = f"run-0-{batch_id:012d}"
        batch.withColumn(VERSION, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/{name}")
        runs.append({"name": name, "level": 0})
        level = 0
        while sum(r["level"] == level for r in runs) >= self.fan_in:
            merged = [r["name"] for r in runs if r["level"] == level]
            name = f"run-{level + 1}-{batch_id:012d}"
            self._newest(merged).write.mode("overwrite").parquet(f"{self.path}/{name}")
            runs = [r for r in runs if r["level"] != level] + [{"name": name, "level": level + 1}]
            level += 1
        put_text(self.spark, f"{self.path}/manifests/{batch_id:012d}.json", json.dumps(runs))
        self._clean(earlier, {r["name"] for r in runs})

    def _clean(self, earlier: list[int], valid: set[str]) -> None:
        """Keep the manifest before this one, which a repeated micro-batch and readers on their way need."""
        keep = valid | ({r["name"] for r in self._runs(earlier[-1])} if earlier else set())
        for name in names_in(self.spark, self.path):
            if name.startswith("run-") and name not in keep:
                delete(self.spark, f"{self.path}/{name}")
        for batch_id in earlier[:-1]:
            delete(self.spark, f"{self.path}/manifests/{batch_id:012d}.json")

    def read(self) -> DataFrame:
        """The newest row of every key."""
        names = self.runs()
        if not names:
            raise FileNotFoundError(f"{self.path} has no finished micro-batch")
        return self._newest(names).drop(VERSION)
