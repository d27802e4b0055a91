"""Stateful flow tracker with idle and active timeouts, as flow exporters use them.

A flow ends when nothing arrives for ``idle`` seconds or when it gets older than ``active`` seconds, whichever comes
first. Packets of one key and one tick are added up inside each Arrow batch before the shuffle, so that a hot flow reaches
its state as a few partial sums instead of as packets. With no active timeout flows are idle-gap sessions. Flows that are
still open stay in the state store, from where ``open_flows`` reads them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from packetloom.operators.flows import gap_moments
from packetloom.schemas import FIVE_TUPLE, record

IDLE_SECONDS = 15.0
ACTIVE_SECONDS = 1800.0
TICK_SECONDS = 1.0

#: Times are whole microseconds; gaps is the sum of the squared gaps between packets, in seconds.
_SUMS = record(first="bigint", last="bigint", packets="bigint", bytes="bigint", gaps="double")
_FLOW = record(first="double", last="double", packets="bigint", bytes="bigint", duration="double", ended_by="string")
_GAPS = record(iat_mean="double", iat_std="double")


def _summed(parts: pd.DataFrame, by: Sequence[str], tick: int) -> pd.DataFrame:
    """Partial sums of one key and tick added up, in time order: what lies between two of them is a gap."""
    group = [*by, "tick"]
    ticked = parts.assign(tick=parts["first"] // tick).sort_values("first", kind="stable")
    before = ticked.groupby(group, dropna=False)["last"].shift()
    border = ((ticked["first"] - before) / 1e6).clip(lower=0).fillna(0.0)
    ticked["gaps"] = ticked["gaps"] + border**2
    sums = ticked.groupby(group, dropna=False, as_index=False).agg(
        first=("first", "min"), last=("last", "max"), packets=("packets", "sum"), bytes=("bytes", "sum"), gaps=("gaps", "sum")
    )
    return sums.drop(columns="tick")


def _partial_sums(keys: Sequence[str], tick: int, whole: bool = False):
    """Sums per Arrow batch, or with ``whole`` over all batches of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            packets = batch.assign(last=batch["first"], packets=1, gaps=0.0)
            if whole:
                held.append(packets)
            elif len(packets):
                yield _summed(packets, keys, tick)
        if held:
            yield _summed(pd.concat(held), keys, tick)

    return run


class FlowTimeouts(StatefulProcessor):
    """Keeps the open flow of a key; merges partial sums in time order and emits ended flows."""

    def __init__(self, keys: Sequence[str], idle: float, active: float, tick: int):
        self.keys, self.idle, self.active, self.tick = list(keys), idle, active, tick

    def deadline(self, flow) -> tuple[float, str]:
        """When the flow ends unless it goes on, and which timeout ends it; a tie counts as idle."""
        idle, active = flow[1] + self.idle, flow[0] + self.active
        return (active, "active") if active < idle else (idle, "idle")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        flow = tuple(self.open.get()) if self.open.exists() else None
        ended = []
        parts = None
        for batch in rows:
            # partial sums of other tasks are merged batch by batch: memory holds one row per tick of the micro-batch
            parts = _summed(batch if parts is None else pd.concat([parts, batch]), [], self.tick)
        for first, last, packets, size, gaps in parts.sort_values("first")[_SUMS.names].itertuples(index=False):
            if flow is not None and (first - flow[1] > self.idle or last - flow[0] > self.active):
                ended.append((*flow, self.deadline(flow)[1]))
                flow = None
            if flow is None:
                flow = (first, last, packets, size, gaps)
            else:
                border = max(0, first - flow[1]) / 1e6
                flow = (min(flow[0], first), max(flow[1], last), flow[2] + packets, flow[3] + size, flow[4] + gaps + border**2)
        self._keep(flow)
        if ended:
            yield self._rows(key, ended)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            flow = tuple(self.open.get())
            self.open.clear()
            yield self._rows(key, [(*flow, self.deadline(flow)[1])])

    def _keep(self, flow) -> None:
        first, last, packets, size, gaps = flow
        self.open.update((int(first), int(last), int(packets), int(size), float(gaps)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # the earlier of both timeouts; a later packet moves it
        self.handle.registerTimer(int(self.deadline(flow)[0] // 1000) + 1)

    def _rows(self, key, ended) -> pd.DataFrame:
        table = pd.DataFrame(ended, columns=[*_SUMS.names, "ended_by"])
        for position, (name, value) in enumerate(zip(self.keys, key)):
            table.insert(position, name, value)
        return table

    def close(self) -> None:
        pass


def _flows(sums: DataFrame, keys: Sequence[str], with_iat: bool) -> DataFrame:
    """Flow rows of partial sums: times in seconds, and the moments of the gaps if asked for."""
    duration = (F.col("last") - F.col("first")) / 1e6
    moments = gap_moments(F.col("packets"), duration, F.col("gaps")) if with_iat else ()
    return sums.select(
        *keys, (F.col("first") / 1e6).alias("first"), (F.col("last") / 1e6).alias("last"), "packets", "bytes",
        duration.alias("duration"), "ended_by", *(m.alias(n) for m, n in zip(moments, _GAPS.names)),
    )


def track_flows(
    packets: DataFrame,
    keys: Sequence[str] = FIVE_TUPLE,
    idle: float | None = IDLE_SECONDS,
    active: float | None = ACTIVE_SECONDS,
    delay: str = "10 seconds",
    tick: float = TICK_SECONDS,
    with_iat: bool = False,
) -> DataFrame:
    """Ended flows of a packet stream with event time ``ts``.

    ``tick`` must not exceed ``idle``. A timeout of None never ends a flow; one of them must be given. The state store
    must be the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``).

    ``with_iat`` adds mean and sample standard deviation of the inter-arrival times. Packets are then shuffled by key and
    tick first, so a hot flow is ordered tick by tick in many tasks and its state takes up one row per tick. The
    moments are exact while a tick's packets arrive in one micro-batch; of one that is split the overlap has no gap.
    """
    if idle is None and active is None:
        raise ValueError("a flow needs a timeout")
    idle, active = (float("inf") if x is None else x for x in (idle, active))
    if tick > idle:
        raise ValueError("tick must not exceed the idle timeout")
    key_fields = [packets.schema[k] for k in keys]
    tick_micros = round(tick * 1_000_000)
    rows = packets.select(*keys, F.unix_micros("ts").alias("first"), F.col("length").cast("bigint").alias("bytes"))
    if with_iat:
        rows = rows.repartition(*keys, F.expr(f"first div {tick_micros}"))
    sums = rows.mapInPandas(_partial_sums(keys, tick_micros, with_iat), T.StructType([*key_fields, *_SUMS.fields]))
    timed = sums.withColumn("ts", F.timestamp_micros("last")).withWatermark("ts", delay)
    ended = timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=FlowTimeouts(keys, idle * 1e6, active * 1e6, tick_micros),
        outputStructType=T.StructType([*key_fields, *_SUMS.fields, *_FLOW.fields[-1:]]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return _flows(ended, keys, with_iat)


def track_sessions(packets: DataFrame, gap: float, keys: Sequence[str] = FIVE_TUPLE, delay: str = "10 seconds") -> DataFrame:
    """Ended idle-gap sessions. Packets closer than the gap are one session anyway, so a task sends one row per key and gap."""
    return track_flows(packets, keys, idle=gap, active=None, delay=delay, tick=gap)


def open_flows(spark: SparkSession, checkpoint: str, keys: Sequence[str] = FIVE_TUPLE, with_iat: bool = False) -> DataFrame:
    """Flows of ``track_flows`` that had not ended at the last micro-batch, read from the state store at its checkpoint."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    sums = state.select(*[F.col(f"key.{k}").alias(k) for k in keys], "value.*", F.lit("open").alias("ended_by"))
    return _flows(sums, keys, with_iat)
