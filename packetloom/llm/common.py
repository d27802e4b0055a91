"""Shared pieces: table access, text of rows, whitespace words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than blank and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a stored table; other columns never reach an operator."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def spare(rows: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it new among the columns of ``rows``."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(column: str | Column) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def fold(doc_id: str | Column, keep_out: int, parts: int = 5) -> Column:
    """True where crc32 of the id as text has the remainder ``keep_out``; a null id counts as empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts == keep_out


def rows_of(batches: Iterator[pa.RecordBatch], most: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` rows, so that Python objects of a few long texts exist at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def extend(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch with further columns."""
    names = [*batch.schema.names, *columns]
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v) for v in columns.values())], names=names)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the consecutive rows with equal ``keys`` (whole numbers); one group at a time is held across batches.

    For partitions that are sorted by their keys. Many small groups cost far less so than one call of a function each.
    """
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        changed = np.zeros(max(0, rows.num_rows - 1), bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            changed |= values[1:] != values[:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist()]
        for low, high in zip(edges, edges[1:]):
            yield rows.slice(low, high - low)
        held = rows.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held
