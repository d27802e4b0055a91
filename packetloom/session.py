"""Session conventions: UTC times and one shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC wall clocks, so calendar parts and windows need a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster that would be one machine's disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return _local_root(spark.sparkContext.applicationId)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"packetloom-{application}-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside the block when it ends. What is to last must be written within it.

    ``with scratch(spark): retrain(...).comparison.write.parquet(path)``
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none where there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def put_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file so that readers see all of it or none; False where it exists and must not be replaced."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    files = target.getFileSystem(hadoop)
    if files.exists(target):
        if not replace:
            return False
        files.delete(target, False)
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    # a rename fails where another writer was first
    moved = files.rename(draft, target)
    if not moved:
        files.delete(draft, False)
    return moved


def get_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several later passes read one expensive intermediate result: the written table survives the loss of
    executors, which cached blocks do not, and cuts the lineage. It stays until the ``scratch`` block around it ends.
    """
    path = shared_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
