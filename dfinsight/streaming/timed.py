"""T1 as keyed state with timers: counters that expire, and can be read as state.

A counter of a key holds arrivals none of which is ``ttl`` or more of event time after the one before. Arrivals come in
any order within the watermark's delay, so a key may hold several counters, and one that comes late can join two. A timer
stands ``ttl`` after the last arrival of each; when the watermark passes it, the counter is given out as closed and its
state goes, so the state holds only keys that are alive, and of a key at most one counter for each ``ttl`` of the delay.
State, timers and the watermark are in the checkpoint: a restart carries them on, and a batch job reads the
open counters from there, without a log of changes. Times are compared in milliseconds, as watermarks are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import importable

COUNTERS = "counters"
#: Counters of a key in order of time: arrivals, first and last arrival (microseconds).
STATE = "n array<long>, first array<long>, last array<long>"


class ExpiringCounters(StatefulProcessor):
    """Rows (key, event time in microseconds) in, closed counters out."""

    def __init__(self, ttl_seconds: float):
        self.ttl_ms = int(ttl_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(COUNTERS, STATE)

    def _counters(self) -> list[tuple[int, int, int]]:
        held = self.state.get()
        return [] if held is None else [tuple(map(int, c)) for c in zip(*held)]

    def _hold(self, before: list, now: list) -> None:
        ends = [{c[2] // 1000 + self.ttl_ms for c in some} for some in (before, now)]
        for t in ends[0] - ends[1]:
            self.handle.deleteTimer(t)
        for t in ends[1] - ends[0]:
            self.handle.registerTimer(t)
        if now:
            self.state.update(tuple(list(x) for x in zip(*now)))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        times = np.sort(np.fromiter((r["micros"] for r in rows), np.int64))
        parts = np.split(times, np.flatnonzero(np.diff(times // 1000) >= self.ttl_ms) + 1)
        before = self._counters()
        merged: list[tuple[int, int, int]] = []
        for n, first, last in sorted([*before, *((len(p), int(p[0]), int(p[-1])) for p in parts)], key=lambda c: c[1]):
            if merged and first // 1000 - merged[-1][2] // 1000 < self.ttl_ms:
                m = merged.pop()
                n, first, last = m[0] + n, m[1], max(m[2], last)
            merged.append((n, first, last))
        self._hold(before, merged)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = self._counters()
        closed, alive = ([c for c in held if (c[2] // 1000 + self.ttl_ms <= now) is ended] for ended in (True, False))
        self._hold(alive, alive)  # a timer that fires is gone by itself
        if closed:
            yield from (Row(key=key[0], n=n, first=first, last=last) for n, first, last in closed)

    def close(self) -> None:
        pass


def expiring_counts(stream: DataFrame, key: str, event_time: str, delay: str, ttl_seconds: float) -> DataFrame:
    """Closed counters (key, n, first, last) of ``stream``, in append mode; a null is a key as well, a row without event time belongs to no counter. Timers need the RocksDB
    state store: run it by ``streams.run_append(..., state_store=streams.ROCKSDB)``, which sets it where the session does not."""
    importable(stream.sparkSession)
    kind = dict(stream.dtypes)[key]
    rows = stream.filter(F.col(event_time).isNotNull()).select(F.col(key).alias("key"), F.col(event_time).alias("event_time"), F.unix_micros(event_time).alias("micros")).withWatermark("event_time", delay)
    # as Rows: a DataFrame of pandas holds whole numbers beside a null as floats, which are no keys of a long
    closed = rows.groupBy("key").transformWithState(ExpiringCounters(ttl_seconds), f"key {kind}, n long, first long, last long", "Append", "EventTime")
    return closed.select("key", "n", F.timestamp_micros("first").alias("first"), F.timestamp_micros("last").alias("last"))


def open_counts(spark: SparkSession, base: str) -> DataFrame:
    """The open counters (key, n, first, last) of a stream run under ``base``, read from its state."""
    state = spark.read.format("statestore").option("stateVarName", COUNTERS).load(f"{base}/checkpoint")
    each = state.select(F.col("key.key").alias("key"), F.explode(F.arrays_zip("value.n", "value.first", "value.last")).alias("c"))
    return each.select("key", F.col("c.n").alias("n"), F.timestamp_micros("c.first").alias("first"), F.timestamp_micros("c.last").alias("last"))
