"""Deterministic random numbers, stable identifiers and table fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def joined_text(columns: Sequence[Column], separator: str = "|") -> Column:
    """One text per row; NULL gets its own mark so that it differs from an empty text."""
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns])


def hash_uniform(key: Column | Sequence[Column], salt: str) -> Column:
    """Repeatable uniform number in (0, 1) from the first 52 bits of an md5 digest, as many as a double keeps apart.

    Retried tasks draw the same number again, which ``rand()`` does not promise after a shuffle.
    """
    keys = [key] if isinstance(key, Column) else list(key)
    digest = F.md5(joined_text([*keys, F.lit(salt)]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def stable_id(*columns: Column) -> Column:
    return F.md5(joined_text(columns).cast("binary"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive fingerprint: row count and four exact sums over 32-bit md5 slices of the rows.

    The slices are added as BIGINT within each input partition, which is fast and cannot overflow there, and as decimals
    across partitions.
    """
    names = list(columns or df.columns)
    digest = F.md5(joined_text([F.col(f"`{n}`") for n in names]).cast("binary"))
    parts = [f"slice_{i}" for i in range(4)]
    slices = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(p) for i, p in enumerate(parts)]
    rows = df.select(F.spark_partition_id().alias("partition"), digest.alias("digest")).select("partition", *slices)
    local = rows.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(p) for p in parts])
    total = local.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), *[F.sum(F.col(p).cast("decimal(20,0)")).alias(p) for p in parts]
    )
    return total.select(
        "n_rows",
        F.sha2(F.concat_ws("|", F.col("n_rows").cast("string"), *[F.col(p).cast("string") for p in parts]), 256).alias(
            "fingerprint"
        ),
    )
