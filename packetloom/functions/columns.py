"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IP protocol numbers and TCP flag letters.
PROTOCOL_NAMES = {6: "TCP", 17: "UDP", 1: "ICMP"}
FLAG_LETTERS = {"SYN": "S", "ACK": "A", "FIN": "F", "RST": "R", "PSH": "P"}
RATE_EPSILON = 1e-6


def present(value: Column, floating: bool = True) -> Column:
    """Neither NULL nor, for floating types, NaN."""
    return value.isNotNull() & ~F.isnan(value) if floating else value.isNotNull()


def finite_or_zero(value: Column) -> Column:
    """NULL, NaN and both infinities become 0."""
    as_double = value.cast("double")
    finite = present(as_double) & (F.abs(as_double) < F.lit(float("inf")))
    return F.when(finite, value).otherwise(F.lit(0).cast("double"))


def safe_rate(amount: Column, seconds: Column) -> Column:
    return amount / (seconds + F.lit(RATE_EPSILON))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def protocol_name(number: Column, other: str | None = "OTHER") -> Column:
    """Name of an IP protocol number; ``other=None`` keeps the number as text."""
    unknown = number.cast("string") if other is None else F.lit(other)
    named = F.lit(None).cast("string")
    for code, name in PROTOCOL_NAMES.items():
        named = F.when(number == code, F.lit(name)).otherwise(named)
    return F.coalesce(named, unknown)


def has_flag(flags: Column, name: str) -> Column:
    return F.coalesce(F.contains(flags, F.lit(FLAG_LETTERS[name])), F.lit(False))


def flag_names(flags: Column) -> Column:
    """Array of flag names, in the order of the letter table."""
    parts = [F.when(has_flag(flags, name), F.lit(name)) for name in FLAG_LETTERS]
    return F.array_compact(F.array(*parts))


def log1p_length(length: Column) -> Column:
    return F.log1p(length.cast("double"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts).cast("double") / F.lit(1e6)


def event_time(value: Column) -> Column:
    """Epoch seconds as text or number, else a timestamp text, else NULL."""
    text = value.cast("string")
    seconds = text.try_cast("double")
    return F.coalesce(F.when(~F.isnan(seconds), F.timestamp_micros((seconds * 1e6).cast("bigint"))), F.try_to_timestamp(text))


def alert_caption(at: Column, src: Column, dst: Column, level: Column) -> Column:
    """``HH:MM:SS | src -> dst [level]`` with ``?`` for what is missing."""
    unknown = F.lit("?")
    return F.concat(
        F.coalesce(F.date_format(at, "HH:mm:ss"), unknown),
        F.lit(" | "),
        F.coalesce(src, unknown),
        F.lit(" -> "),
        F.coalesce(dst, unknown),
        F.lit(" ["),
        F.coalesce(level, unknown),
        F.lit("]"),
    )


def binary_label(value: Column, normal: tuple[str, ...] = ("normal", "benign")) -> Column:
    """0 for a normal class and the number 0, 1 for any other class or number; NaN and NULL have no label."""
    text = F.lower(value.cast("string"))
    number = text.try_cast("double")
    return (
        F.when(text.isNull() | F.isnan(number), F.lit(None).cast("int"))
        .when(number.isNotNull(), (number != 0).cast("int"))
        .when(text.isin(*normal), F.lit(0))
        .otherwise(F.lit(1))
    )


def append_audit(log: Column, entry: Column) -> Column:
    """Append one struct to an audit array that may be NULL."""
    return F.when(log.isNull(), F.array(entry)).otherwise(F.concat(log, F.array(entry)))


def audit_entry(at: Column, action: str, old_label: Column, new_label: Column, by: Column) -> Column:
    return F.struct(
        at.cast("string").alias("ts"),
        F.lit(action).alias("action"),
        old_label.cast("string").alias("old_label"),
        new_label.cast("string").alias("new_label"),
        by.cast("string").alias("by"),
    )
