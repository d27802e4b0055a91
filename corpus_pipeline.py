"""A training corpus in five stages: toxic texts out, one text per group of near copies, benchmark leaks out, sources mixed
to their target shares, records shuffled into shards.

Each stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packetloom.llm import decontaminate, jaccard, mixing, sharding, toxicity
from packetloom.llm.common import table
from packetloom.session import scratch, shared_path

#: Trees and calibration cannot be put in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not predict toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in shuffled order, with shard and slot."""
    return sharding.write_shards(sharding.two_pass_shuffle(docs), shared_path(spark, "corpus"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        with scratch(spark):  # a stage's own intermediate tables go when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
