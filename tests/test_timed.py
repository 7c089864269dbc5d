"""T1 with timers: late arrivals join counters, closed ones leave the state, a restart carries it on."""

from __future__ import annotations

import datetime as dt
import uuid

from dfinsight.plans import more_queries
from dfinsight.streaming import streams, timed

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "k string, t timestamp"


def test_counters_merge_expire_and_are_read_back(spark, tmp_path):
    base = streams.stream_base(spark, f"timed-{uuid.uuid4().hex}")

    def deliver(*rows):
        spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m)) for k, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.file_stream(spark, str(tmp_path / "in"), schema=spark.createDataFrame([], SCHEMA).schema)
        out = streams.run_append(timed.expiring_counts(stream, "k", "t", "30 minutes", 600), base)
        minutes = lambda df: {(r.key, r.n, *((x.timestamp() - T0.timestamp()) / 60 for x in (r["first"], r["last"]))) for r in df.collect()}
        return minutes(out), minutes(timed.open_counts(spark, base))

    closed, alive = deliver(("a", 0), ("a", 0), ("a", 15), ("b", 3), (None, 4))
    assert closed == set() and alive == {("a", 2, 0, 0), ("a", 1, 15, 15), ("b", 1, 3, 3), (None, 1, 4, 4)}
    closed, alive = deliver(("a", 7), ("b", 13))  # 7 joins 0 and 15; 13 is ten minutes after 3, so a counter of its own
    assert closed == set() and alive == {("a", 4, 0, 15), ("b", 1, 3, 3), ("b", 1, 13, 13), (None, 1, 4, 4)}
    ended = {("b", 1, 3, 3), ("b", 1, 13, 13), (None, 1, 4, 4)}
    closed, alive = deliver(("c", 54))  # the watermark is at 24: what ended by 14 has expired
    assert closed == ended and alive == {("a", 4, 0, 15), ("c", 1, 54, 54)}
    closed, alive = deliver(("a", 30), ("c", 60))  # at 30: a has expired, and its new arrival begins again
    assert closed == ended | {("a", 4, 0, 15)} and alive == {("a", 1, 30, 30), ("c", 2, 54, 60)}


def test_query_needs_no_setting_of_the_session(spark, tmp_path):
    """The driver's session has Spark's default state store, which has no timers; null users and times beside others."""
    plain, default = spark.newSession(), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain.conf.set(streams.STATE_STORE, default)
    plain.conf.set("spark.sql.shuffle.partitions", "2")
    at = lambda day, hour=0: dt.datetime(2024, 1, day, hour)
    times = [(7, at(1)), (7, at(2, 12)), (7, at(4, 12)), (8, at(10)), (8, at(11, 23)), (None, at(3)), (9, at(30)), (7, None), (6, None), (6, None)]
    rows = [(i, ts, user, "view", 1.0, None) for i, (user, ts) in enumerate(times)]
    plain.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in more_queries.q_stream_counts_expiring(plain, str(tmp_path)).collect()}
    assert got == {(7, 2, at(1), at(2, 12), False), (7, 2, at(4, 12), at(4, 12), False), (6, 2, None, None, None), (8, 2, at(10), at(11, 23), False),
                   (None, 1, at(3), at(3), False), (9, 1, at(30), at(30), True)}
    assert plain.conf.get(streams.STATE_STORE) == default
