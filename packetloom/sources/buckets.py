"""Table by key in hash buckets: a change rewrites only the buckets that hold its keys.

Files of a bucket are never changed. A version is a manifest that names, for every bucket, the folder its rows are in; a
change writes the buckets it touches below a folder of its own and announces a manifest that names the old folders for all
others. Announcing fails where another change has been announced since, so no change is lost in silence.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.operators.labels import duplicate_keys, upsert
from packetloom.session import delete, get_text, names_in, put_text, settle
from packetloom.sources.readers import empty
from packetloom.sources.writers import SaveConflict

LEAST_BUCKETS, ROWS_PER_BUCKET = 16, 2_000_000
BUCKET = "__bucket"


class BucketTable:
    """Rows of unique ``key`` below ``path``.

    The number of buckets is that of the first version, by default from its rows; a ``save`` may set another one.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "flow_id", buckets: int | None = None):
        self.spark, self.path, self.schema, self.key, self._buckets = spark, path.rstrip("/"), schema, key, buckets

    def versions(self) -> list[int]:
        names = names_in(self.spark, f"{self.path}/versions")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """buckets, and the folder of every bucket that has rows; that of the newest version by default."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "buckets": self._buckets or LEAST_BUCKETS, "folders": {}}
        version = known[-1] if version is None else version
        return json.loads(get_text(self.spark, f"{self.path}/versions/{version:08d}.json")) | {"version": version}

    def _bucket(self, manifest: dict):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(manifest["buckets"])).cast("int")

    def _read(self, manifest: dict, wanted: list[int] | None = None) -> DataFrame:
        folders = [f for b, f in manifest["folders"].items() if wanted is None or int(b) in wanted]
        if not folders:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/{f}" for f in folders))

    def load(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    def _announce(self, before: dict, rows: DataFrame, touched: list[int] | None) -> int:
        """Write the rows of the touched buckets (None: of all) and announce a version in which the others are as before."""
        folder = uuid.uuid4().hex
        # one sorted writer per bucket; a bucket has a share of the keys, so none is hot
        spread = rows.withColumn(BUCKET, self._bucket(before)).repartition(BUCKET)
        spread.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        written = {n.split("=")[1]: f"{folder}/{n}" for n in names_in(self.spark, f"{self.path}/data/{folder}") if "=" in n}
        self._unique(self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}") if written else rows, folder)
        kept = {b: f for b, f in before["folders"].items() if touched is not None and int(b) not in touched}
        number = before["version"] + 1
        text = json.dumps({"buckets": before["buckets"], "folders": kept | written})
        if not put_text(self.spark, f"{self.path}/versions/{number:08d}.json", text, replace=False):
            delete(self.spark, f"{self.path}/data/{folder}")
            raise SaveConflict(f"another change of {self.path} was announced first")
        return number

    def save(self, rows: DataFrame, buckets: int | None = None) -> int:
        """A version of these rows alone, whose keys must be unique."""
        before, rows = self.manifest(), self._aligned(rows)
        if buckets:
            before["buckets"] = buckets
        elif not before["version"] and not self._buckets:
            rows = settle(rows, "saved")
            before["buckets"] = max(LEAST_BUCKETS, rows.count() // ROWS_PER_BUCKET)
        return self._announce(before, rows, None)

    def rewrite(self, changes: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """A version in which the rows of the touched buckets are ``change(rows, changes)``; ``changes`` has the key.

        ``change`` must keep rows in their buckets: it may alter, add and drop rows of the keys of ``changes`` only.
        """
        before, changes = self.manifest(), settle(changes, "changes")  # read for the buckets and by ``change``
        touched = sorted(r[0] for r in changes.select(self._bucket(before)).distinct().collect())  # at most all buckets
        if not touched:
            return before["version"]
        return self._announce(before, self._aligned(change(self._read(before, touched), changes)), touched)

    def upsert(self, changes: DataFrame) -> int:
        """Rows of ``changes`` replace those of their key or are added."""
        return self.rewrite(changes, lambda rows, new: upsert(rows, new, self.key))

    def prune(self, keep: int = 2) -> list[int]:
        """Forget all versions but the newest ``keep`` and delete folders that none of these names."""
        known = self.versions()
        old = known[: -max(1, keep)]
        named = {f for v in known[-max(1, keep) :] for f in self.manifest(v)["folders"].values()}
        for version in old:
            delete(self.spark, f"{self.path}/versions/{version:08d}.json")
        for folder in names_in(self.spark, f"{self.path}/data"):
            for part in names_in(self.spark, f"{self.path}/data/{folder}"):
                if "=" in part and f"{folder}/{part}" not in named:
                    delete(self.spark, f"{self.path}/data/{folder}/{part}")
        return old

    def _aligned(self, rows: DataFrame) -> DataFrame:
        """The columns of the table; those that are missing are null."""
        return rows.select(
            *((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields)
        )

    def _unique(self, rows: DataFrame, folder: str) -> None:
        twice = duplicate_keys(rows, (self.key,)).first()
        if twice is not None:
            delete(self.spark, f"{self.path}/data/{folder}")
            raise ValueError(f"{self.key} {twice[self.key]!r} occurs {twice['copies']} times")
