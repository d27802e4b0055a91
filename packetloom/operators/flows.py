"""Packets to flows: windowed roll-up, inter-arrival times, idle-gap sessions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.columns import epoch_seconds, has_flag, safe_rate
from packetloom.operators.ordering import SLICE, SLICE_ROWS, repeats_heavily, slice_scan, with_slice
from packetloom.schemas import FIVE_TUPLE
from packetloom.session import settle

WINDOW = "5 seconds"

_FLAGS = ("SYN", "ACK", "FIN", "RST")


def packet_measures(time_col: str) -> list[Column]:
    """Aggregates of one flow; every one merges map-side, so a hot flow never reaches one task as raw rows."""
    return [
        F.count(F.lit(1)).alias("packets"),
        F.sum(F.col("length").cast("bigint")).alias("bytes"),
        F.min(time_col).alias("first_ts"),
        F.max(time_col).alias("last_ts"),
        *[F.bool_or(has_flag(F.col("flags"), f)).alias(f"saw_{f.lower()}") for f in _FLAGS],
    ]


def instant_rows(
    packets: DataFrame, keys: Sequence[str], time_col: str, slice_rows: int
) -> tuple[DataFrame, list[float]]:
    """Partial measures in time slices, ready for windows over (key, slice), and the slice borders.

    Usually every packet is one row. Only when single instants hold a large share of the packets (copies, coarse clocks)
    are the packets of one key and instant added up first, which costs a shuffle of its own.
    """
    micros = F.unix_micros(F.col(time_col))
    bounds, scan = slice_scan(packets, micros, {}, slice_rows)
    if bounds and repeats_heavily(scan):
        rows = packets.groupBy(*keys, time_col).agg(*packet_measures(time_col))
    else:
        rows = packets.select(
            *keys,
            time_col,
            F.lit(1).cast("bigint").alias("packets"),
            F.col("length").cast("bigint").alias("bytes"),
            F.col(time_col).alias("first_ts"),
            F.col(time_col).alias("last_ts"),
            *[has_flag(F.col("flags"), f).alias(f"saw_{f.lower()}") for f in _FLAGS],
        )
    return with_slice(rows, micros, bounds), bounds


def merged_measures() -> list[Column]:
    """The same aggregates over partial results."""
    return [
        F.sum("packets").alias("packets"),
        F.sum("bytes").alias("bytes"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *[F.bool_or(f"saw_{f.lower()}").alias(f"saw_{f.lower()}") for f in _FLAGS],
    ]


def flow_columns(keys: Sequence[str], iat_mean: Column | None = None, iat_std: Column | None = None) -> list[Column]:
    """Flow record from the measures. Keys left out of the grouping become typed defaults."""
    zero = F.lit(0.0)
    duration = epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts"))
    protocol = F.col("protocol") if "protocol" in keys else F.lit("OTHER")
    representative = (
        F.when(F.col("saw_rst"), F.lit("RST"))
        .when(F.col("saw_syn") & ~F.col("saw_ack"), F.lit("SYN"))
        .when(F.col("saw_fin"), F.lit("FIN"))
        .when(F.col("saw_ack"), F.lit("ACK"))
        .otherwise(F.lit("normal"))
    )

    def key(name: str, default: object, data_type: str) -> Column:
        return (F.col(name) if name in keys else F.lit(default)).cast(data_type).alias(name)

    packets, volume = F.col("packets"), F.col("bytes")
    return [
        epoch_seconds(F.col("first_ts")).alias("timestamp"),
        epoch_seconds(F.col("first_ts")).alias("ts"),
        key("src_ip", None, "string"),
        key("dst_ip", None, "string"),
        key("src_port", 0, "int"),
        key("dst_port", 0, "int"),
        protocol.alias("protocol"),
        protocol.alias("proto"),
        volume.alias("length"),
        representative.alias("flags"),
        F.when(protocol == "TCP", F.lit("http")).otherwise(F.lit("dns")).alias("service"),
        F.when(F.col("saw_fin"), F.lit("SF")).otherwise(F.lit("S0")).alias("conn_state"),
        duration.alias("duration"),
        packets.alias("orig_pkts"),
        F.lit(0).cast("bigint").alias("resp_pkts"),
        packets.alias("pkts_total"),
        volume.alias("orig_bytes"),
        F.lit(0).cast("bigint").alias("resp_bytes"),
        volume.alias("bytes_total"),
        safe_rate(packets, duration).alias("pkts_per_sec"),
        safe_rate(volume, duration).alias("bytes_per_sec"),
        (zero if iat_mean is None else iat_mean).alias("iat_mean"),
        (zero if iat_std is None else iat_std).alias("iat_std"),
        F.col("saw_syn").cast("int").alias("syn_count"),
        F.col("saw_ack").cast("int").alias("ack_count"),
        F.col("saw_rst").cast("int").alias("rst_count"),
        F.lit(0).alias("risk_hint"),
    ]


def _window_key(window: str | None, time_col: str) -> list[Column]:
    return [F.window(F.col(time_col), window).alias("window")] if window else []


def _window_start(window: str | None) -> list[Column]:
    return [F.col("window.start").alias("window_start")] if window else []


def flow_rollup(
    packets: DataFrame,
    window: str | None = WINDOW,
    keys: Sequence[str] = FIVE_TUPLE,
    time_col: str = "ts",
    with_iat: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One flow row per key and tumbling window (``window=None``: per key over the whole table).

    Works on a stream as well when ``with_iat`` is off. With ``with_iat`` the inter-arrival mean and sample standard
    deviation are computed; otherwise both are 0.
    """
    if with_iat:
        return _rollup_with_iat(packets, window, keys, time_col, slice_rows)
    grouped = packets.groupBy(*_window_key(window, time_col), *keys).agg(*packet_measures(time_col))
    return grouped.select(*_window_start(window), *flow_columns(keys))


def _rollup_with_iat(
    packets: DataFrame, window: str | None, keys: Sequence[str], time_col: str, slice_rows: int
) -> DataFrame:
    """Gaps are taken inside time slices first and across slice borders second, so a flow that holds a large share
    of the table is spread over many slices.
    """
    group = (["window"] if window else []) + list(keys)
    windowed = packets.withColumns({"window": _window_key(window, time_col)[0]} if window else {})
    sliced, _ = instant_rows(windowed, group, time_col, slice_rows)
    within = Window.partitionBy(*group, SLICE).orderBy(time_col)
    gap = (F.unix_micros(time_col) - F.unix_micros(F.lag(time_col).over(within))) / 1e6
    per_slice = (
        sliced.withColumn("gap", gap)
        .groupBy(*group, SLICE)
        .agg(*merged_measures(), F.sum(F.col("gap") * F.col("gap")).alias("gap_squares"))
    )
    across = Window.partitionBy(*group).orderBy(SLICE)
    border = (F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(across))) / 1e6
    flows = (
        per_slice.withColumn("border", border)
        .groupBy(*group)
        .agg(
            *merged_measures(),
            (
                F.coalesce(F.sum("gap_squares"), F.lit(0.0))
                + F.coalesce(F.sum(F.col("border") * F.col("border")), F.lit(0.0))
            ).alias("gap_squares"),
        )
    )
    total = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return flows.select(*_window_start(window), *flow_columns(keys, *gap_moments(F.col("packets"), total, F.col("gap_squares"))))


def gap_moments(packets: Column, total: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and sample standard deviation of the gaps between packets, from their sum in seconds and that of their squares."""
    gaps = (packets - 1).cast("double")
    mean = F.when(gaps > 0, total / gaps).otherwise(F.lit(0.0))
    spread = F.greatest(F.lit(0.0), squares - total * total / gaps)
    return mean, F.when(gaps > 1, F.sqrt(spread / (gaps - 1))).otherwise(F.lit(0.0))


def flow_sessions(
    packets: DataFrame,
    gap_seconds: float,
    keys: Sequence[str] = FIVE_TUPLE,
    time_col: str = "ts",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Sessions per key: a session ends where the next packet is more than ``gap_seconds`` later.

    Same result as ``session_window``, which sorts all rows of a key in one task. Here sessions are formed inside time
    slices, and only the first fragment of each slice is stitched to the session that reaches into it.
    """
    keys = list(keys)
    gap_micros = F.lit(round(gap_seconds * 1_000_000))
    micros = F.unix_micros(F.col(time_col))
    sliced, bounds = instant_rows(packets, keys, time_col, slice_rows)
    within = Window.partitionBy(*keys, SLICE).orderBy(time_col)
    starts = F.when(micros - F.unix_micros(F.lag(time_col).over(within)) > gap_micros, F.col(time_col))
    fragments = (
        sliced.withColumn("starts", starts)
        .withColumn("opened", F.max("starts").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, SLICE, "opened")
        .agg(*merged_measures())
    )
    if bounds:
        started = _stitched(settle(fragments, "fragments"), keys, gap_micros)
    else:
        started = fragments.withColumn("session_start", F.coalesce("opened", "first_ts"))
    return (
        started.groupBy(*keys, "session_start")
        .agg(*merged_measures())
        .withColumn("session_end", F.col("last_ts"))
        .withColumn("duration", epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts")))
    )


def _stitched(fragments: DataFrame, keys: list[str], gap_micros: Column) -> DataFrame:
    """Give the first fragment of every slice the start of the session it continues.

    ``fragments`` is a written table, because it is read twice: as a whole and for one summary row per key and slice.
    """
    across = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        fragments.groupBy(*keys, SLICE)
        .agg(F.min("first_ts").alias("head"), F.max("last_ts").alias("tail"), F.max("opened").alias("last_opened"))
        .withColumn("previous", F.lag("tail").over(across))
        .withColumn(
            "head_opens",
            F.col("previous").isNull() | (F.unix_micros("head") - F.unix_micros("previous") > gap_micros),
        )
        .withColumn("newest", F.greatest("last_opened", F.when(F.col("head_opens"), F.col("head"))))
        .withColumn("carried", F.max("newest").over(earlier))
        .select(
            *[F.col(k).alias(f"head_{k}") for k in [*keys, SLICE]],
            F.when(F.col("head_opens"), F.col("head")).otherwise(F.col("carried")).alias("head_start"),
        )
    )
    # null-safe, so that sessions of an unknown address are kept
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"head_{k}")) for k in [*keys, SLICE]])
    return fragments.join(heads, same).withColumn("session_start", F.coalesce("opened", "head_start"))
