"""Questions about the alert table: KPIs, rankings, time series, graph and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.columns import alert_caption, event_time
from packetloom.operators.ordering import smallest
from packetloom.schemas import column_or

HISTOGRAM_BINS = 20
MAX_RISK = 100.0


def with_event_time(df: DataFrame, time_col: str = "timestamp", name: str = "at") -> DataFrame:
    """Parsed event time with its calendar parts. An unreadable time stays NULL."""
    return df.withColumn(name, event_time(F.col(time_col))).withColumns(
        {"hour": F.hour(name), "minute": F.minute(name), "date": F.to_date(name)}
    )


def newest_first(df: DataFrame, time_col: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(time_col).desc_nulls_last(), tie)


def tail(df: DataFrame, rows: int, time_col: str, tie: str) -> DataFrame:
    """The newest ``rows`` rows, found without a full sort."""
    age = -F.unix_micros(F.col(time_col))
    timed = df.where(F.col(time_col).isNotNull())
    return newest_first(smallest(timed, age, [tie], rows), time_col, tie)


def kpis(alerts: DataFrame, approximate: bool = False) -> DataFrame:
    """Total, distinct sources, critical alerts and mean risk in one pass.

    Sources are counted per address first, so the exact distinct count needs no copy of the rows per aggregate.
    """
    if approximate:
        return alerts.agg(
            F.count(F.lit(1)).alias("total_alerts"),
            F.approx_count_distinct("src").alias("distinct_sources"),
            F.count_if(F.col("alert_level") == "CRITICAL").alias("critical_alerts"),
            F.avg("risk_score").alias("avg_risk"),
        )
    per_source = alerts.groupBy("src").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("alert_level") == "CRITICAL").alias("critical"),
        F.sum("risk_score").alias("risk"),
        F.count("risk_score").alias("n_risk"),
    )
    return per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_alerts"),
        F.count("src").alias("distinct_sources"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_alerts"),
        (F.sum("risk") / F.nullif(F.sum("n_risk"), F.lit(0))).alias("avg_risk"),
    )


def time_range(df: DataFrame, time_col: str = "at") -> DataFrame:
    return df.agg(F.min(time_col).alias("first_at"), F.max(time_col).alias("last_at"))


def frequency(df: DataFrame, column: str, keep_null: bool = False, name: str = "count") -> DataFrame:
    """Value counts; NULL only when asked for."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "count") -> DataFrame:
    return frequency(df, column, name=name).orderBy(F.col(name).desc(), column).limit(k)


def top_sources(alerts: DataFrame, k: int = 10) -> DataFrame:
    return top_values(alerts, "src", k)


def top_destinations(alerts: DataFrame, k: int = 10) -> DataFrame:
    return top_values(alerts, "dst", k)


def top_ports(alerts: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent target ports as text; the column is ``dst_port`` or ``dest_port``."""
    port = "dst_port" if "dst_port" in alerts.columns else "dest_port"
    return top_values(alerts.select(F.col(port).cast("string").alias("port")), "port", k)


def edges(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("count"))


def top_edges(alerts: DataFrame, k: int = 50) -> DataFrame:
    return edges(alerts).orderBy(F.col("count").desc(), "src", "dst").limit(k)


def node_degrees(edge_rows: DataFrame) -> DataFrame:
    """Degree (in and out) and number of out-neighbours of every node of a distinct edge list."""
    ends = edge_rows.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(1).alias("out")),
                F.struct(F.col("dst").alias("node"), F.lit(0).alias("out")),
            )
        )
    )
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), F.sum("out").alias("out_degree"))


def counts_over_time(df: DataFrame, time_col: str = "at", width: str = "10 minutes") -> DataFrame:
    """Rows per time bucket between the first and the last bucket, empty buckets as 0.

    The calendar is a range of numbers, dealt out over tasks: one wrong time makes it long, but not one long row.
    """
    counted = (
        df.where(F.col(time_col).isNotNull())
        .groupBy(F.window(time_col, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("bucket"), "n")
    )
    step = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {width})")
    span = counted.agg(F.unix_micros(F.min("bucket")).alias("lo"), F.unix_micros(F.max("bucket")).alias("hi"), F.first(step).alias("step"))
    span = span.first()
    steps = 0 if span["lo"] is None else (span["hi"] - span["lo"]) // span["step"] + 1
    at = F.lit(span["lo"]).cast("bigint") + F.col("id") * F.lit(span["step"]).cast("bigint")
    empty = df.sparkSession.range(steps).select(F.timestamp_micros(at).alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    # one more tiny aggregate instead of a join: both sides have one row per bucket
    return counted.unionByName(empty).groupBy("bucket").agg(F.sum("n").alias("count"))


def heatmap(df: DataFrame, time_col: str = "at") -> DataFrame:
    """Counts per hour and minute, long form."""
    return (
        df.where(F.col(time_col).isNotNull())
        .groupBy(F.hour(time_col).alias("hour"), F.minute(time_col).alias("minute"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def heatmap_wide(df: DataFrame, time_col: str = "at") -> DataFrame:
    """One row per hour, one column per minute, 0 where nothing happened."""
    long = heatmap(df, time_col)
    return long.groupBy("hour").agg(
        *[F.coalesce(F.sum(F.when(F.col("minute") == m, F.col("count"))), F.lit(0)).alias(f"m{m:02d}") for m in range(60)]
    )


def histogram_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of equal width; the last bin is closed, values outside give NULL."""
    position = F.floor((value - F.lit(low)) * bins / F.lit(high - low))
    return F.when((value >= low) & (value <= high), F.least(position, F.lit(bins - 1))).cast("int")


def risk_histogram(alerts: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    binned = alerts.select(histogram_bin(F.col("risk_score"), 0.0, MAX_RISK, bins).alias("bin"))
    return binned.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))


def filter_dates_levels(alerts: DataFrame, first: str, last: str, levels: Sequence[str], time_col: str = "at") -> DataFrame:
    """Inclusive calendar dates and a set of levels.

    The date range is written on the time column itself, so it reaches the scan as a pushed filter.
    """
    start = F.lit(first).cast("timestamp")
    end = F.lit(last).cast("timestamp") + F.expr("INTERVAL 1 DAY")
    rows = alerts.where((F.col(time_col) >= start) & (F.col(time_col) < end))
    return rows.where(F.col("alert_level").isin(*levels)) if "alert_level" in alerts.columns else rows


def explore(
    alerts: DataFrame,
    address: str | None = None,
    levels: Sequence[str] = (),
    protocols: Sequence[str] = (),
    literal: bool = False,
) -> DataFrame:
    """Log explorer: address pattern in source or destination, level and protocol sets; empty means no filter."""
    rows = alerts
    if address:
        pattern = F.lit(address)
        rows = (
            rows.where(F.contains("src", pattern) | F.contains("dst", pattern))
            if literal
            else rows.where(F.col("src").rlike(address) | F.col("dst").rlike(address))
        )
    if levels:
        rows = rows.where(F.col("alert_level").isin(*levels))
    if protocols:
        rows = rows.where(F.col("proto").isin(*protocols))
    return rows


def captions(alerts: DataFrame, time_col: str = "at") -> DataFrame:
    return alerts.withColumn(
        "caption",
        alert_caption(
            F.col(time_col),
            column_or(alerts, "src", None, "string"),
            column_or(alerts, "dst", None, "string"),
            column_or(alerts, "alert_level", None, "string"),
        ),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every value of some columns, NULL included, with the column type."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"`{c}`").cast("string").alias("value")
                )
                for c in columns
            ]
        )
    )
    return df.select(cells.alias("cell")).groupBy("cell.column", "cell.type", "cell.value").agg(
        F.count(F.lit(1)).alias("count")
    )


def explanation_rows(alerts: DataFrame, key: str, nested: str = "shap_explanation") -> DataFrame:
    """Drill-down: one row per explained feature of each alert."""
    return alerts.select(key, F.inline(nested))
