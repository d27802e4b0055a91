"""Streaming forms of the batch jobs: the same column expressions on an unbounded packet table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from packetloom.functions.rules import ANOMALY_THRESHOLD
from packetloom.operators.drift import is_severe
from packetloom.operators.flows import WINDOW, flow_rollup, packet_measures
from packetloom.plans.detection import detect
from packetloom.schemas import FIVE_TUPLE
from packetloom.session import shared_path
from packetloom.streaming.runs import KeyedRuns

DELAY = "10 seconds"


def event_stream(packets: DataFrame, delay: str = DELAY) -> DataFrame:
    """Declare the event time: rows more than ``delay`` behind the newest one are dropped and counted."""
    return packets.withWatermark("ts", delay)


def flow_stream(
    packets: DataFrame, window: str = WINDOW, keys: Sequence[str] = FIVE_TUPLE, delay: str = DELAY
) -> DataFrame:
    """Tumbling-window flows; the state of a window is dropped once the watermark has passed it."""
    return flow_rollup(event_stream(packets, delay), window, keys)


def session_stream(packets: DataFrame, gap: str, keys: Sequence[str] = FIVE_TUPLE, delay: str = DELAY) -> DataFrame:
    """Idle-gap sessions. A micro-batch is small, so the built-in session window is the right tool here."""
    return (
        event_stream(packets, delay)
        .groupBy(F.session_window("ts", gap).alias("session"), *keys)
        .agg(*packet_measures("ts"))
        .select(
            *keys,
            F.col("session.start").alias("session_start"),
            F.col("last_ts").alias("session_end"),
            "packets",
            "bytes",
            ((F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6).alias("duration"),
        )
    )


def alert_stream(
    packets: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    window: str = WINDOW,
    keys: Sequence[str] = FIVE_TUPLE,
    delay: str = DELAY,
    threshold: float = ANOMALY_THRESHOLD,
    min_level: str = "LOW",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Packets to alerts: windowed flows, then the stateless scoring and fusion of the batch job."""
    return detect(event_stream(packets, delay), score, window, keys, threshold, min_level, keep)


def live_counts(alerts: DataFrame, time_col: str = "at", width: str = "10 minutes", delay: str = DELAY) -> DataFrame:
    """Alert counts per time bucket, for an ``update`` sink that a dashboard polls."""
    return (
        alerts.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("count"), F.count_if(is_severe(F.col("alert_level"))).alias("severe"))
        .select(F.col("w.start").alias("bucket"), "count", "severe")
    )


def hourly_alerts(alerts: DataFrame, time_col: str = "at", delay: str = DELAY) -> DataFrame:
    """Alerts and severe ones per hour, for an ``update`` sink by ``hour``: ``drift.rate_of_hours`` makes windows of them.

    The current hour is among them as soon as it has an alert.
    """
    return live_counts(alerts, time_col, "1 hour", delay).select(F.col("bucket").alias("hour"), F.col("count").alias("n"), "severe")


def severe_rate_stream(
    alerts: DataFrame, time_col: str = "at", span: str = "24 hours", step: str = "1 hour", delay: str = DELAY
) -> DataFrame:
    """Severe share over a sliding window, for an ``append`` sink.

    Alerts are counted per step first; only those counts enter the windows that contain them, so an alert is not copied
    once per window. A window is emitted, and its state dropped, when the watermark has passed its end.
    """
    counted = (
        alerts.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, step).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_severe(F.col("alert_level"))).alias("bad"))
    )
    return (
        counted.groupBy(F.window(F.window_time("part"), span, step).alias("w"))
        .agg(F.sum("n").alias("alerts"), F.sum("bad").alias("severe"))
        .select(
            F.col("w.start").alias("window_start"), "alerts", "severe", (F.col("severe") / F.col("alerts")).alias("severe_rate")
        )
    )


def enrich(stream: DataFrame, static: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Stream rows with a static table (labels, whitelist); it is read again for every micro-batch."""
    return stream.join(static, on, how)


def append_to(
    stream: DataFrame,
    path: str,
    checkpoint: str | None = None,
    file_format: str = "json",
    every: str | None = None,
) -> StreamingQuery:
    """Append finished rows to files, exactly once: the file sink keeps its own commit log.

    ``every`` is a processing interval; without it the data available now is processed and the query ends.
    """
    location = checkpoint or shared_path(stream.sparkSession, "offsets")
    writer = stream.writeStream.outputMode("append").format(file_format).option("checkpointLocation", location)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def update_to(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Keep the newest row of every key of a changing aggregate (see ``KeyedRuns``); ``latest`` reads them.

    A repeated micro-batch replaces its own run, so a restart leaves no duplicates, and the number of files stays bounded.
    """
    location = checkpoint or shared_path(stream.sparkSession, "offsets")
    sink = KeyedRuns(stream.sparkSession, path, keys)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", location)
        .trigger(**trigger)
        .foreachBatch(sink.absorb)
        .start()
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key written by ``update_to``."""
    return KeyedRuns(spark, path, keys).read()


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that came too late, over the progress reports that a query still keeps (the last hundred by default)."""
    return sum(
        operator["numRowsDroppedByWatermark"] for report in query.recentProgress for operator in report["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that came too late over the whole life of every query: ``spark.streams.addListener(LateRows())``."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
