"""Global shuffle in two passes and equal shards.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash. Pass two runs a Fisher-Yates shuffle in
each bucket and writes it. Buckets lie end to end, so every record has one place in a uniform order of the whole table;
shard and slot follow from the place, which makes shard sizes differ by one row at most (law ``rows``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.llm.common import extend, spare, text_of

#: Cells of the hash range; buckets are runs of cells, so the driver sees so many counts at most.
CELLS = 1 << 16
BUCKET_BYTES = 32 << 20


def byte_size(text_col: str) -> Column:
    """UTF-8 bytes of the text plus one for its end; a null text has none."""
    return F.octet_length(text_of(text_col)).cast("long") + 1


def two_pass_shuffle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 16,
    seed: int = 20_240_501,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with place_size, place_shard and place_slot, each partition holding whole buckets in shuffled order.

    The key hashes seed, id and text, so null ids and one repeated id spread over all buckets. Rows equal in both are
    interchangeable, and which of them gets which place carries no meaning. Reruns and retried tasks give the same
    places, whatever the partitions of the input. A worker keeps eight bytes per row of the bucket at hand; rows
    stream past it. An empty table gives no rows; a null text has size 1. Columns named like the new ones are replaced.
    """
    docs = docs.drop("place_size", "place_shard", "place_slot")
    key, part, place = spare(docs, "key"), spare(docs, "bucket"), spare(docs, "place")
    keyed = docs.withColumns(
        {
            "place_size": byte_size(text_col),
            key: F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text_of(text_col)),
        }
    )
    cell = F.shiftrightunsigned(key, 48)
    counted = keyed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum("place_size").alias("size")).collect()
    buckets = max(1, min(CELLS, -(-sum(r["size"] for r in counted) // bucket_bytes)))
    rows = [0] * buckets
    for r in counted:
        rows[r["cell"] * buckets // CELLS] += r["n"]
    starts = [0, *accumulate(rows)]

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, order, seen = -1, np.empty(0, np.int64), 0
        for batch in batches:
            bucket = batch.column(part).to_numpy(zero_copy_only=False)
            places = np.empty(len(bucket), np.int64)
            for b in np.unique(bucket):
                mine = np.flatnonzero(bucket == b)
                if b != current:
                    current, seen, order = b, 0, np.arange(rows[b], dtype=np.int64)
                    np.random.default_rng([seed, int(b)]).shuffle(order)  # Fisher-Yates
                places[mine] = starts[b] + order[seen : seen + len(mine)]
                seen += len(mine)
            yield extend(batch, **{place: places})

    keyed = keyed.withColumn(part, F.floor(cell * buckets / CELLS).cast("int"))
    # every attempt at the second pass sees a bucket's rows in the order of their keys, whatever order they arrived in
    scattered = keyed.repartitionById(buckets, F.col(part)).sortWithinPartitions(part, key, id_col)
    schema = T.StructType([*scattered.schema.fields, T.StructField(place, T.LongType())])
    placed = scattered.mapInArrow(shuffle, schema).sortWithinPartitions(place)
    shard, slot = (F.col(place) % shards).cast("int"), F.floor(F.col(place) / shards).cast("long")
    return placed.withColumns({"place_shard": shard, "place_slot": slot}).drop(key, part, place)


def write_shards(placed: DataFrame, path: str) -> DataFrame:
    """Write one folder per shard, rows in slot order within a file; give the table back as it was written."""
    placed.write.partitionBy("place_shard").option("compression", "zstd").parquet(path)
    return placed.sparkSession.read.schema(placed.schema).parquet(path)


def shard_digest(placed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, size, CRC of the text and the place of every row."""
    return placed.select(
        id_col,
        F.col("place_size").alias("size"),
        F.crc32(text_of(text_col)).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("place_shard").alias("shard"),
        F.col("place_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
