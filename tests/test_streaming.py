import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from packetloom.functions.rules import WHITELIST
from packetloom.operators import flows
from packetloom.plans.detection import to_alerts
from packetloom.schemas import PACKET
from packetloom.session import names_in, shared_path
from packetloom.sources.readers import packet_stream, with_packet_time
from packetloom.streaming import jobs, tracker
from packetloom.streaming.runs import KeyedRuns

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
KEYS = ("src_ip", "dst_ip", "protocol")


def packet(at, src="a", flags="S", length=60):
    return {
        "timestamp": START + at, "src_ip": src, "dst_ip": "z", "protocol": "TCP", "length": length, "flags": flags, "ttl": 64, "label": 0
    }


def write_files(folder, files):
    """One file per list of packets, arriving in order."""
    import os

    for i, packets in enumerate(files):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(p) for p in packets))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture
def arriving(tmp_path):
    files = [[packet(s, src="ab"[s % 2], flags="SA") for s in range(i * 20, i * 20 + 20)] for i in range(4)]
    write_files(tmp_path, files)
    return str(tmp_path)


def stream(spark, path):
    return packet_stream(spark, path, "json", maxFilesPerTrigger=1)


def test_flow_stream_equals_batch(spark, arriving):
    path = shared_path(spark, "flows")
    jobs.update_to(jobs.flow_stream(stream(spark, arriving), keys=KEYS), path, ["window_start", *KEYS]).awaitTermination()
    got = jobs.latest(spark, path, ["window_start", *KEYS])
    batch = flows.flow_rollup(with_packet_time(spark.read.schema(PACKET).json(arriving)), keys=KEYS)
    columns = ["window_start", *KEYS, "pkts_total", "bytes_total", "flags", "duration"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_appended_alerts_are_finished_windows(spark, arriving):
    def score(rolled):
        return rolled.withColumns({"xgb_prob": F.lit(0.95), "xgb_label": F.lit(1), "anomaly_score": F.lit(-0.2)})

    path = shared_path(spark, "alerts")
    alerts = jobs.alert_stream(stream(spark, arriving), score, keys=KEYS)
    jobs.append_to(alerts, path, file_format="json").awaitTermination()
    got = spark.read.json(path)
    batch = to_alerts(score(flows.flow_rollup(with_packet_time(spark.read.schema(PACKET).json(arriving)), keys=KEYS)))
    finished = batch.where(F.col("timestamp").cast("double") < START + 65)
    assert got.count() == finished.count() > 0
    assert got.select("alert_level").distinct().first()[0] == "CRITICAL"


def test_restart_continues_after_the_last_batch(spark, arriving, tmp_path):
    path, offsets = shared_path(spark, "flows"), shared_path(spark, "offsets")
    rows = stream(spark, arriving).select("src_ip", "timestamp")
    jobs.append_to(rows, path, offsets).awaitTermination()
    write_files(tmp_path, [[]] * 4 + [[packet(500)]])
    jobs.append_to(stream(spark, arriving).select("src_ip", "timestamp"), path, offsets).awaitTermination()
    assert spark.read.json(path).count() == 81


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    write_files(tmp_path, [[packet(100)], [packet(200)], [packet(300), packet(5)], [packet(400)]])
    path = shared_path(spark, "flows")
    query = jobs.update_to(jobs.flow_stream(stream(spark, str(tmp_path)), keys=KEYS), path, ["window_start", *KEYS])
    query.awaitTermination()
    assert jobs.dropped_by_watermark(query) == 1
    assert jobs.latest(spark, path, ["window_start", *KEYS]).agg(F.sum("pkts_total")).first()[0] == 4


def test_sessions(spark, tmp_path):
    write_files(tmp_path, [[packet(0), packet(3)], [packet(6), packet(40)], [packet(500)], [packet(501)]])
    path = shared_path(spark, "sessions")
    jobs.append_to(jobs.session_stream(stream(spark, str(tmp_path)), "10 seconds", KEYS), path, file_format="parquet").awaitTermination()
    got = {(r["packets"], r["duration"]) for r in spark.read.parquet(path).collect()}
    assert got == {(3, 6.0), (1, 0.0)}


def test_enrichment(spark, arriving):
    listed = spark.createDataFrame([("a", WHITELIST[0])], "src_ip string, note string")
    path = shared_path(spark, "enriched")
    jobs.append_to(jobs.enrich(stream(spark, arriving), listed, "src_ip"), path).awaitTermination()
    assert spark.read.json(path).where("note is not null").count() == 40


def test_tracker_timeouts(spark, tmp_path):
    conf = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(conf, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        first = [packet(s) for s in range(0, 10)] + [packet(s, "b") for s in range(0, 61, 5)]
        second = [packet(40), packet(41)] + [packet(s, "b") for s in range(65, 130, 5)]
        write_files(tmp_path, [first, second, [packet(1000, "c")], [packet(1001, "c")]])
        path = shared_path(spark, "ended")
        ended = tracker.track_flows(stream(spark, str(tmp_path)), KEYS, idle=15, active=60, delay="1 second")
        jobs.append_to(ended, path, file_format="parquet").awaitTermination()
    finally:
        spark.conf.unset(conf)
    got = spark.read.parquet(path)
    assert {(r["packets"], r["ended_by"]) for r in got.where("src_ip = 'a'").collect()} == {(10, "idle"), (2, "idle")}
    b = got.where("src_ip = 'b'").collect()
    assert sum(r["packets"] for r in b) == 26 and "active" in {r["ended_by"] for r in b}
    assert max(r["duration"] for r in b) <= 60


def test_tracker_checks_its_tick(spark, arriving):
    with pytest.raises(ValueError):
        tracker.track_flows(stream(spark, arriving), KEYS, idle=1, tick=5)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocksdb(spark):
    conf = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(conf, ROCKSDB)
    yield
    spark.conf.unset(conf)


def test_open_flows_stay_readable(spark, tmp_path, rocksdb):
    first = [packet(s) for s in range(0, 10)] + [packet(s, "b") for s in range(0, 61, 5)] + [packet(3, None)]
    write_files(tmp_path, [first, [packet(s, "b") for s in range(65, 71, 5)] + [packet(66, "a")]])
    path, checkpoint = shared_path(spark, "ended"), shared_path(spark, "tracker")
    ended = tracker.track_flows(stream(spark, str(tmp_path)), KEYS, idle=15, active=60, delay="1 second")
    jobs.append_to(ended, path, checkpoint, "parquet").awaitTermination()
    rows = spark.read.schema(ended.schema).parquet(path).unionByName(tracker.open_flows(spark, checkpoint, KEYS))
    got = {(r["src_ip"], r["first"] - START, r["packets"], r["ended_by"]) for r in rows.collect()}
    assert got == {("a", 0.0, 10, "idle"), ("a", 66.0, 1, "open"), ("b", 0.0, 13, "active"), ("b", 65.0, 2, "open"), (None, 3.0, 1, "idle")}


def test_tracked_sessions_equal_batch_sessions(spark, arriving, rocksdb):
    path, checkpoint = shared_path(spark, "ended"), shared_path(spark, "tracker")
    sessions = tracker.track_sessions(stream(spark, arriving), 1.0, KEYS, "1 second")
    jobs.append_to(sessions, path, checkpoint, "parquet").awaitTermination()
    rows = spark.read.schema(sessions.schema).parquet(path).unionByName(tracker.open_flows(spark, checkpoint, KEYS))
    batch = flows.flow_sessions(with_packet_time(spark.read.schema(PACKET).json(arriving)), 1.0, KEYS)
    got = sorted((r["src_ip"], r["first"], r["packets"]) for r in rows.collect())
    assert got == sorted((r["src_ip"], r["session_start"].timestamp(), r["packets"]) for r in batch.collect())


def test_a_hot_key_reaches_its_state_as_few_rows():
    import pandas as pd

    packets = pd.DataFrame({"k": ["a"] * 100_000, "first": [int(START * 1e6) + i * 1000 for i in range(100_000)], "bytes": 1})
    sent = pd.concat(tracker._partial_sums(["k"], 10_000_000)(iter([packets[:50_000], packets[50_000:]])))
    assert len(sent) <= 12 and sent["packets"].sum() == 100_000
    whole = pd.concat(tracker._partial_sums(["k"], 10_000_000, True)(iter([packets[::2], packets[1::2]])))
    assert len(whole) <= 11 and abs(whole["gaps"].sum() - (100_000 - len(whole)) * 1e-6) < 1e-9


def test_inter_arrival_times_of_a_stream_equal_batch(spark, tmp_path, rocksdb):
    times = [0, 0.5, 3, 3, 3.25, 9, 14.5, 30, 31, 47, 47.75]
    write_files(tmp_path, [[packet(s) for s in times[:4]], [packet(s) for s in times[4:8][::-1]], [packet(s) for s in times[8:]] + [packet(5, "b")]])
    path, checkpoint = shared_path(spark, "ended"), shared_path(spark, "tracker")
    ended = tracker.track_flows(stream(spark, str(tmp_path)), KEYS, 1000, None, "100 seconds", 2.0, with_iat=True)
    jobs.append_to(ended, path, checkpoint, "parquet").awaitTermination()
    rows = spark.read.schema(ended.schema).parquet(path).unionByName(tracker.open_flows(spark, checkpoint, KEYS, True))
    got = {r["src_ip"]: (r["packets"], r["iat_mean"], r["iat_std"]) for r in rows.collect()}
    batch = flows.flow_rollup(with_packet_time(spark.read.schema(PACKET).json(str(tmp_path))), None, KEYS, with_iat=True)
    for r in batch.collect():
        assert got[r["src_ip"]] == pytest.approx((r["orig_pkts"], r["iat_mean"], r["iat_std"]))
    assert got["b"] == (1, 0.0, 0.0) and len(got) == 2


def test_runs_stay_few_and_hold_the_newest_rows(spark):
    path = shared_path(spark, "runs")
    sink = KeyedRuns(spark, path, ["k"], fan_in=4)
    wanted = {}
    for batch in range(50):
        rows = [(k, batch * 100 + k) for k in range(batch % 7, 40, 5)]
        wanted.update(dict(rows))
        sink.absorb(spark.createDataFrame(rows, "k long, x long").coalesce(1), batch)
        if batch % 10 == 3:  # the same micro-batch again, as after a failure
            sink.absorb(spark.createDataFrame(rows, "k long, x long").coalesce(1), batch)
    assert {r["k"]: r["x"] for r in sink.read().collect()} == wanted
    assert len(sink.runs()) <= 3 * 3
    assert len([n for n in names_in(spark, path) if n.startswith("run-")]) <= 2 * 9 and len(names_in(spark, f"{path}/manifests")) <= 4


def test_a_failed_micro_batch_leaves_the_last_state(spark, monkeypatch):
    from packetloom.streaming import runs

    sink = KeyedRuns(spark, shared_path(spark, "runs"), ["k"], fan_in=2)
    one = spark.createDataFrame([(1, "a")], "k long, x string")
    sink.absorb(one, 0)
    with monkeypatch.context() as patch:
        patch.setattr(runs, "put_text", lambda *a, **o: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sink.absorb(spark.createDataFrame([(1, "b")], "k long, x string"), 1)
    assert [tuple(r) for r in sink.read().collect()] == [(1, "a")]
    sink.absorb(spark.createDataFrame([(1, "b"), (None, "c")], "k long, x string"), 1)
    assert sorted(map(str, (tuple(r) for r in sink.read().collect()))) == ["(1, 'b')", "(None, 'c')"]
    with pytest.raises(FileNotFoundError):
        KeyedRuns(spark, shared_path(spark, "runs"), ["k"]).read()
