import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from packetloom.operators import flows


def packets(spark, rows):
    """(seconds, src, flags, length)"""
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(seconds=s), src, "10.0.0.9", "TCP", 5, 80, n, f) for s, src, f, n in rows]
    return spark.createDataFrame(
        data,
        "ts timestamp, src_ip string, dst_ip string, protocol string, src_port int, dst_port int, length int, flags string",
    )


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the packets belong to one flow, a fifth of them share one instant, some addresses are NULL."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        src = "hot" if i % 2 else ("cold" + str(i % 20) if i % 5 else None)
        at = 500.0 if i % 5 == 3 else float(np.round(rng.uniform(0, 4000), 3))
        rows.append((at, src, "SA", 60))
    return packets(spark, rows).repartition(8).cache()


def test_rollup_fields(spark):
    df = packets(spark, [(0.0, "a", "S", 10), (1.0, "a", "A", 20), (4.0, "a", "FA", 30), (6.0, "a", "S", 5), (0.5, "b", "R", 7)])
    rows = {(r["src_ip"], r["window_start"].second): r for r in flows.flow_rollup(df).collect()}
    first = rows["a", 0]
    assert (first["pkts_total"], first["bytes_total"], first["duration"]) == (3, 60, 4.0)
    assert (first["flags"], first["conn_state"], first["service"]) == ("FIN", "SF", "http")
    assert first["pkts_per_sec"] == pytest.approx(3 / (4 + 1e-6))
    assert (rows["a", 5]["flags"], rows["a", 5]["duration"]) == ("SYN", 0.0)
    assert (rows["b", 0]["flags"], rows["b", 0]["rst_count"]) == ("RST", 1)


def test_rollup_without_window_covers_the_table(spark):
    df = packets(spark, [(0.0, "a", None, 10), (100.0, "a", None, 20)])
    row = flows.flow_rollup(df, window=None).first()
    assert (row["pkts_total"], row["flags"], row["conn_state"], row["iat_mean"]) == (2, "normal", "S0", 0.0)


def test_heavy_instants_are_added_up_before_slicing(hot):
    with_copies, _ = flows.instant_rows(hot, ["src_ip"], "ts", 150)
    assert with_copies.count() < hot.count()
    spread = hot.where(F.col("ts") != F.lit("2024-01-01 00:08:20").cast("timestamp"))
    assert flows.instant_rows(spread, ["src_ip"], "ts", 150)[0].count() == spread.count()


@pytest.fixture(scope="module")
def spread(hot):
    return hot.where(F.col("ts") != F.lit("2024-01-01 00:08:20").cast("timestamp")).cache()


@pytest.mark.parametrize("gap", [0.5, 5.0])
def test_sessions_without_copies(spread, gap):
    got = flows.flow_sessions(spread, gap, keys=("src_ip",), slice_rows=150)
    built_in = spread.groupBy("src_ip", F.session_window("ts", f"{gap} seconds").alias("w")).agg(F.count("*").alias("n"))
    assert sorted(r["packets"] for r in got.collect()) == sorted(r["n"] for r in built_in.collect())


@pytest.mark.parametrize("slice_rows", [10_000_000, 150])
def test_inter_arrival_times(hot, slice_rows):
    got = flows.flow_rollup(hot, window=None, keys=("src_ip",), with_iat=True, slice_rows=slice_rows).toPandas()
    pdf = hot.select("src_ip", (F.unix_micros("ts") / 1e6).alias("t")).toPandas()
    for src, part in pdf.groupby("src_ip", dropna=False):
        gaps = np.diff(np.sort(part["t"]))
        row = got[got["src_ip"].isna() if pd.isna(src) else got["src_ip"] == src].iloc[0]
        assert row["pkts_total"] == len(part)
        assert row["iat_mean"] == pytest.approx(gaps.mean(), rel=1e-9)
        assert row["iat_std"] == pytest.approx(gaps.std(ddof=1), rel=1e-6)


@pytest.mark.parametrize("slice_rows", [10_000_000, 150])
@pytest.mark.parametrize("gap", [0.5, 5.0, 60.0, 5000.0])
def test_sessions_equal_session_window(hot, gap, slice_rows):
    got = flows.flow_sessions(hot, gap, keys=("src_ip",), slice_rows=slice_rows)
    got = {(r["src_ip"], r["session_start"], r["session_end"], r["packets"], r["bytes"]) for r in got.collect()}
    built_in = (
        hot.groupBy("src_ip", F.session_window("ts", f"{gap} seconds").alias("w"))
        .agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"), F.sum("length").alias("s"))
    )
    want = {(r["src_ip"], r["a"], r["b"], r["n"], r["s"]) for r in built_in.collect()}
    assert got == want
