"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node that it reaches) for every node of ``edges`` but the smallest itself.

    Each round points the larger neighbours of every node at its smallest neighbour, then does the same for the smaller
    ones; stars remain after a number of rounds that is logarithmic in the longest path. Each round is written to the
    shared folder, so lineage stays short and lost executors cost one round. A node of very high degree only meets
    partial minima, and the join back to its edges may be split.
    """
    found = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    found = settle(found, "edges")
    before = _state(found)
    while before[0]:
        both = found.union(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = settle(small.union(low.select("u", "m")).distinct(), "edges")
        after = _state(found)
        if after == before:
            break
        before = after
    return found.select(F.col("u").alias("node"), F.col("v").alias("component"))
