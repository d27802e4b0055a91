"""Streaming queries: the event table is read as a file stream, results land in the shared folder."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import traffic
from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.functions.rules import WHITELIST
from packetloom.operators.drift import rate_of_hours
from packetloom.session import settle, shared_path
from packetloom.sources import readers
from packetloom.streaming import jobs, tracker

query = Catalog()

DELAY = "12 hours"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def packet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packet table as arriving files. The first micro-batch takes all that are there, so no row comes too late."""
    path = shared_path(spark, "arrived")
    packets = v.packets(spark, sf_dir).drop("ts")
    packets.write.parquet(path)
    return readers.packet_stream(spark, path, "parquet", packets.schema)


def _current(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run the stream over the available data and read the newest row of every key."""
    spark = stream.sparkSession
    path = shared_path(spark, "updates")
    jobs.update_to(stream, path, keys).awaitTermination()
    return jobs.latest(spark, path, keys)


@contextmanager
def _state_store(spark: SparkSession):
    """The tracker needs the RocksDB state store."""
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(conf, before) if before else spark.conf.unset(conf)


def _tracked(stream: DataFrame, keys: list[str], with_iat: bool = False) -> DataFrame:
    """Ended flows of a tracker over the available data, and those still open in its state."""
    spark = stream.sparkSession
    path, checkpoint = shared_path(spark, "ended"), shared_path(spark, "tracker")
    with _state_store(spark):
        jobs.append_to(stream, path, checkpoint, "parquet").awaitTermination()
        ended = spark.read.schema(stream.schema).parquet(path)
        return settle(ended.unionByName(tracker.open_flows(spark, checkpoint, keys, with_iat)), "flows")


@query(traffic.query.oracle["flow_rollup"])
def stream_flow_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = jobs.flow_stream(packet_stream(spark, sf_dir), v.FLOW_WINDOW, v.FLOW_KEYS, DELAY)
    current = _current(v.with_flow_id(rolled), ["flow_id"])
    return traffic._flow_output(current)


@query(traffic.query.oracle["fuse_alerts"])
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = lambda rolled: v.score_flows(v.with_flow_id(rolled))
    alerts = jobs.alert_stream(packet_stream(spark, sf_dir), score, v.FLOW_WINDOW, v.FLOW_KEYS, DELAY, keep=["flow_id"])
    return traffic._alert_output(_current(alerts, ["flow_id"]))


@query(f"""WITH {v.PACKETS_SQL},
marked AS (SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w > 7200000000, true) AS opens FROM packets
  WINDOW w AS (PARTITION BY src_ip, protocol ORDER BY ts, packet_id)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY src_ip, protocol ORDER BY ts, packet_id) AS nr FROM marked),
sessions AS (SELECT src_ip, protocol, nr, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS packets, CAST(sum(length) AS BIGINT) AS bytes
  FROM numbered GROUP BY src_ip, protocol, nr)
SELECT src_ip, protocol, start_us, end_us, packets, bytes,
  lead(nr) OVER (PARTITION BY src_ip, protocol ORDER BY nr) IS NULL AND end_us + 7200000000 >= (SELECT epoch_us(max(ts)) FROM packets) - 43200000000 AS open
FROM sessions""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions: ended ones are appended, open ones are read from the state."""
    keys = ["src_ip", "protocol"]
    sessions = _tracked(tracker.track_sessions(packet_stream(spark, sf_dir), 7200.0, keys, DELAY), keys)
    return sessions.select(
        *keys, _micros("first").alias("start_us"), _micros("last").alias("end_us"), "packets", "bytes", (F.col("ended_by") == "open").alias("open")
    )


def _micros(name: str) -> Column:
    return F.round(F.col(name) * 1e6).cast("bigint")


@query(f"""WITH {v.PACKETS_SQL} SELECT epoch_us(time_bucket(INTERVAL 10 minute, ts)) AS bucket_us, count(*) AS count,
  count(*) FILTER (WHERE label = 1) AS severe FROM packets GROUP BY 1""")
def stream_live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("label") == 1, "HIGH").otherwise("LOW")
    alerts = packet_stream(spark, sf_dir).select(F.col("ts").alias("at"), level.alias("alert_level"))
    current = _current(jobs.live_counts(alerts, delay=DELAY), ["bucket"])
    return current.select(F.unix_micros("bucket").alias("bucket_us"), "count", "severe")


@query(f"""WITH {v.PACKETS_SQL} SELECT epoch_us(date_trunc('hour', ts) - to_hours(i)) AS window_us, count(*) AS alerts,
  count(*) FILTER (WHERE label = 1) AS severe FROM packets, (SELECT unnest(range(0, 24)) AS i) r GROUP BY date_trunc('hour', ts) - to_hours(i)""")
def stream_severe_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severe rate of every day-long window, the running ones included, from hourly counts that the stream keeps."""
    level = F.when(F.col("label") == 1, "HIGH").otherwise("LOW")
    alerts = packet_stream(spark, sf_dir).select(F.col("ts").alias("at"), level.alias("alert_level"))
    hours = _current(jobs.hourly_alerts(alerts, delay=DELAY), ["hour"])
    return rate_of_hours(hours).select(F.unix_micros("window_start").alias("window_us"), "alerts", "severe")


_LIST = ", ".join(f"'{ip}'" for ip in WHITELIST)


@query(f"WITH {v.PACKETS_SQL} SELECT packet_id, src_ip, src_ip IN ({_LIST}) AS whitelisted FROM packets")
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateless stream joined with the whitelist table and appended to files."""
    whitelist = spark.createDataFrame([(ip, True) for ip in WHITELIST], "src_ip string, listed boolean")
    enriched = jobs.enrich(packet_stream(spark, sf_dir), whitelist, "src_ip").select(
        "packet_id", "src_ip", F.coalesce("listed", F.lit(False)).alias("whitelisted")
    )
    path = shared_path(spark, "enriched")
    jobs.append_to(enriched, path, file_format="parquet").awaitTermination()
    return spark.read.parquet(path)


#: Timeouts of the flow query: an hour of silence, a day and a half of age, ticks of a minute, a watermark an hour behind.
IDLE, ACTIVE, TICK, BEHIND = 36_000, 129_600, 60, 3_600


@query(f"""WITH RECURSIVE {v.PACKETS_SQL},
parts AS (SELECT src_ip, protocol, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, count(*) AS packets, sum(length) AS bytes
  FROM packets GROUP BY src_ip, protocol, epoch_us(ts) // {TICK * 10**6}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY src_ip, protocol ORDER BY first) AS nr FROM parts),
walk AS (
  SELECT src_ip, protocol, nr, first AS opened, last, 1 AS flow FROM numbered WHERE nr = 1
  UNION ALL
  SELECT n.src_ip, n.protocol, n.nr, CASE WHEN ends THEN n.first ELSE w.opened END, CASE WHEN ends THEN n.last ELSE greatest(w.last, n.last) END,
    w.flow + ends::INT
  FROM walk w JOIN numbered n ON n.src_ip = w.src_ip AND n.protocol = w.protocol AND n.nr = w.nr + 1,
    LATERAL (SELECT n.first - w.last > {IDLE * 10**6} OR n.last - w.opened > {ACTIVE * 10**6} AS ends) e),
flows AS (SELECT src_ip, protocol, flow, min(n.first) AS first, max(n.last) AS last, sum(packets) AS packets, sum(bytes) AS bytes
  FROM walk JOIN numbered n USING (src_ip, protocol, nr) GROUP BY src_ip, protocol, flow)
SELECT src_ip, protocol, first AS start_us, last AS end_us, CAST(packets AS BIGINT) AS packets, CAST(bytes AS BIGINT) AS bytes,
  CASE WHEN lead(flow) OVER (PARTITION BY src_ip, protocol ORDER BY flow) IS NULL
        AND least(last + {IDLE * 10**6}, first + {ACTIVE * 10**6}) >= (SELECT epoch_us(max(ts)) FROM packets) - {BEHIND * 10**6} THEN 'open'
    WHEN first + {ACTIVE * 10**6} < last + {IDLE * 10**6} THEN 'active' ELSE 'idle' END AS ended_by
FROM flows""")
def stream_stateful_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flows: ended by silence, ended by age, or still open when the data ends."""
    keys = ["src_ip", "protocol"]
    stream = tracker.track_flows(packet_stream(spark, sf_dir), keys, float(IDLE), float(ACTIVE), f"{BEHIND} seconds", float(TICK))
    return _tracked(stream, keys).select(
        *keys, _micros("first").alias("start_us"), _micros("last").alias("end_us"), "packets", "bytes", "ended_by"
    )


@query(f"""WITH {v.PACKETS_SQL}, seen AS (SELECT *, length % 3 = 0 AS late FROM packets),
mark AS (SELECT epoch_us(max(ts)) - 43200000000 AS watermark FROM seen WHERE length % 3 = 1)
SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, count(*) AS packets, count(*) FILTER (late) AS late_packets
FROM seen, mark WHERE NOT late OR epoch_us(date_trunc('hour', ts)) + 3600000000 > watermark GROUP BY 1""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream whose last file comes when the watermark has passed most of its hours.

    The watermark that drops rows is that of the micro-batch before, so the late file is the third one.
    """
    path = shared_path(spark, "arrived")
    packets = v.packets(spark, sf_dir).drop("ts")
    for part in (1, 2, 0):
        packets.where(F.col("length") % 3 == part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are taken in the order of their times, which have milliseconds
    arriving = readers.packet_stream(spark, path, "parquet", packets.schema, maxFilesPerTrigger=1)
    hours = (
        jobs.event_stream(arriving, DELAY).groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("packets"), F.count_if(F.col("length") % 3 == 0).alias("late_packets"))
        .select(F.col("w.start").alias("hour"), "packets", "late_packets")
    )
    return _current(hours, ["hour"]).select(F.unix_micros("hour").alias("hour_us"), "packets", "late_packets")


@query(traffic.query.oracle["flow_iat"])
def stream_flow_iat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inter-arrival times of windowed flows: a flow of one window ends with it, those of the last windows are still open."""
    packets = packet_stream(spark, sf_dir).withColumn("window_start", F.window("ts", v.FLOW_WINDOW)["start"])
    keys = ["window_start", *v.FLOW_KEYS]
    stream = tracker.track_flows(packets, keys, None, 86_400.0, DELAY, 3_600.0, with_iat=True)
    return _tracked(stream, keys, with_iat=True).select(
        *v.FLOW_KEYS, F.unix_micros("window_start").alias("window_us"), "packets", "iat_mean", F.round("iat_std", 3).alias("iat_std")
    )
