import os
import tempfile
import time
import uuid

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dfinsight.session import clean_scratch, scratch_path
from dfinsight.streaming import streams
from tests.conftest import SF01, rows


def base_of(spark, name):
    return streams.stream_base(spark, f"{name}-{uuid.uuid4().hex}")


def _write(dirpath, name, tbl, mtime):
    p = os.path.join(dirpath, name)
    pq.write_table(tbl, p)
    os.utime(p, (mtime, mtime))


def _late_files(days_behind: int) -> str:
    """Three files, read in order: ids < 6000; ids >= 5000 (1,000 duplicates); ids 0-9 again as new
    ids (+1,000,000) with ts ``days_behind`` days behind the maximum (late)."""
    import datetime as dt

    import pyarrow as pa
    ev = pq.read_table(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-late-")
    now = time.time() - 100
    ids = ev["event_id"]
    _write(d, "f0.parquet", ev.filter(pc.less(ids, 6000)), now)
    _write(d, "f1.parquet", ev.filter(pc.greater_equal(ids, 5000)), now + 10)
    late = ev.filter(pc.less(ids, 10))
    max_ts = pc.max(ev["ts"]).as_py()
    late = late.set_column(late.schema.get_field_index("event_id"), "event_id", pc.add(late["event_id"], 1_000_000))
    late = late.set_column(late.schema.get_field_index("ts"), "ts",
                           pa.array([max_ts - dt.timedelta(days=days_behind)] * late.num_rows,
                                    type=ev.schema.field("ts").type))
    _write(d, "f2.parquet", late, now + 20)
    return d


@pytest.fixture(scope="module")
def late_dir():
    return _late_files(20)


@pytest.fixture(scope="module")
def slightly_late_dir():
    return _late_files(2)


@pytest.mark.parametrize("delay,max_files,expected", [("1 hour", 1, 10000), ("10 days", 1, 10010),
                                                      ("1 hour", 3, 10010)])
def test_dedupe_late_and_duplicates(spark, late_dir, delay, max_files, expected):
    s = streams.with_event_time(streams.file_stream(spark, late_dir, "*.parquet", max_files_per_trigger=max_files), "ts")
    out = streams.run_append(streams.stream_dedupe(s, "event_id", "event_time", delay).drop("event_time"), base_of(spark, "t3"))
    assert out.count() == expected
    assert out.select("event_id").distinct().count() == expected


@pytest.mark.parametrize("delay,max_files", [("1 hour", 1), ("10 days", 1), ("1 hour", 3)])
def test_lateness_uses_the_earlier_watermark(spark, slightly_late_dir, delay, max_files):
    """Rows 2 days behind survive even a 1-hour delay: late rows are judged with the watermark as
    it stood before the previous batch (after file 0 only), not after file 1."""
    s = streams.with_event_time(streams.file_stream(spark, slightly_late_dir, "*.parquet",
                                                    max_files_per_trigger=max_files), "ts")
    out = streams.run_append(streams.stream_dedupe(s, "event_id", "event_time", delay).drop("event_time"), base_of(spark, "t3b"))
    assert out.count() == 10010


def test_counts_survive_restart(spark):
    ev = pq.read_table(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-t1-")
    now = time.time() - 100
    _write(d, "a.parquet", ev.filter(pc.less(ev["event_id"], 6000)), now)
    base = base_of(spark, "t1-restart")
    first = streams.run_updates(streams.stream_counts(streams.file_stream(spark, d), "event_type"),
                                   ["event_type"], base)
    assert sum(r.n for r in first.collect()) == 6000
    assert streams.compact_updates(spark, base, ["event_type"]) == 0  # snapshot, then keep streaming
    _write(d, "b.parquet", ev.filter(pc.greater_equal(ev["event_id"], 6000)), now + 10)
    second = streams.run_updates(streams.stream_counts(streams.file_stream(spark, d), "event_type"),
                                    ["event_type"], base)
    batch = spark.read.parquet(f"{SF01}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    assert rows(second) == rows(batch)


def test_stream_metric_series_equals_batch(spark):
    s = streams.with_event_time(streams.file_stream(spark, SF01, "events.parquet", max_files_per_trigger=1), "ts")
    cur = streams.run_updates(streams.metric_series(s, "event_time", "event_type", "value", "1 day", "1 day"),
                                 ["w", "event_type"], base_of(spark, "t4"))
    got = rows(streams.flatten_window(cur), "event_type", "window_start", "n")
    batch = streams.metric_series(spark.read.parquet(f"{SF01}/events.parquet"), "ts", "event_type", "value", "1 day")
    want = rows(streams.flatten_window(batch, ntz=False), "event_type", "window_start", "n")
    assert got == want and len(got) == 150


def test_latest_values_batch_and_stream_agree(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    batch = streams.latest_values(ev, "user_id", "ts", "event_id", ["value"])
    s = streams.file_stream(spark, SF01, "events.parquet")
    cur = streams.run_updates(streams.latest_values(s, "user_id", "ts", "event_id", ["value"]), ["user_id"], base_of(spark, "t2"))
    assert rows(cur, "user_id", "event_id", "value") == rows(batch, "user_id", "event_id", "value")


def test_metric_latest_stream_equals_batch(spark):
    s = streams.file_stream(spark, SF01, "events.parquet")
    cur = streams.run_updates(streams.metric_latest(s, "event_type", "ts", "event_id", "value"),
                                 ["event_type"], base_of(spark, "t5"))
    batch = streams.metric_latest(spark.read.parquet(f"{SF01}/events.parquet"), "event_type", "ts", "event_id", "value")
    assert rows(cur, "event_type", "latest", "max", "n") == rows(batch, "event_type", "latest", "max", "n")


def test_stream_latest_helper(spark):
    cur = streams.stream_latest(streams.file_stream(spark, SF01, "events.parquet"), "user_id", "ts", "event_id",
                                ["value"], base_of(spark, "t2-helper"))
    assert cur.count() == 150


def test_processing_time_counter_handle(spark):
    base = base_of(spark, "t1-live")
    q = streams.start_updates(streams.stream_counts(streams.file_stream(spark, SF01, "events.parquet"), "event_type"),
                              base, {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sum(r.n for r in streams.current_table(spark, base, ["event_type"]).collect()) == 10000


def test_compaction_keeps_the_current_table(spark):
    ev = pq.read_table(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-compact-")
    now = time.time() - 100
    for i, lo in enumerate(range(0, 10000, 2500)):
        _write(d, f"p{i}.parquet", ev.filter(pc.and_(pc.greater_equal(ev["event_id"], lo),
                                                     pc.less(ev["event_id"], lo + 2500))), now + 10 * i)
    base = base_of(spark, "t1-compact")
    agg = streams.stream_counts(streams.file_stream(spark, d, max_files_per_trigger=1), "event_type")
    q = streams.start_updates(agg, base, {"availableNow": True})
    q.awaitTermination()
    before = rows(streams.current_table(spark, base, ["event_type"]))
    upto = streams.compact_updates(spark, base, ["event_type"])
    assert upto == 3
    after = rows(streams.current_table(spark, base, ["event_type"]))
    assert after == before and sum(n for _, n in after) == 10000


def test_bytes_bounded_batches_give_the_same_counts(spark):
    ev = pq.read_table(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-mbt-")
    now = time.time() - 100
    for i in range(3):
        _write(d, f"p{i}.parquet", ev.filter(pc.equal(pc.bit_wise_and(ev["event_id"], 3), i)), now + i)
    base = base_of(spark, "t1-bytes")
    q = streams.start_updates(streams.stream_counts(streams.file_stream(spark, d, max_bytes_per_trigger=1),
                                                    "event_type"), base)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    assert sum(r.n for r in streams.current_table(spark, base, ["event_type"]).collect()) == 7500


def test_empty_stream_gives_an_empty_table(spark):
    d = tempfile.mkdtemp(prefix="dfinsight-empty-")
    schema = spark.read.parquet(f"{SF01}/events.parquet").schema
    cur = streams.run_updates(streams.stream_counts(streams.file_stream(spark, d, schema=schema), "event_type"),
                                 ["event_type"], base_of(spark, "t1-empty"))
    assert cur.count() == 0 and cur.columns == ["event_type", "n"]


def test_empty_append_stream(spark):
    d = tempfile.mkdtemp(prefix="dfinsight-empty2-")
    schema = spark.read.parquet(f"{SF01}/events.parquet").schema
    s = streams.with_event_time(streams.file_stream(spark, d, schema=schema), "ts")
    out = streams.run_append(streams.stream_dedupe(s, "event_id", "event_time", "1 hour"), base_of(spark, "t3-empty"))
    assert out.count() == 0


def test_state_survives_the_removal_of_scratch(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-durable-")
    base = base_of(spark, "t1-durable")
    for n in range(2):
        ev.write.mode("append").parquet(d)
        cur = streams.run_updates(streams.stream_counts(streams.file_stream(spark, d), "event_type"), ["event_type"], base)
        clean_scratch(spark)
    assert sum(r.n for r in cur.collect()) == 20000


def test_a_folder_under_scratch_is_refused(spark):
    agg = streams.stream_counts(streams.file_stream(spark, SF01, "events.parquet"), "event_type")
    with pytest.raises(ValueError):
        streams.run_updates(agg, ["event_type"], scratch_path(spark, "t1"))
    with pytest.raises(ValueError):
        streams.start_updates(agg, base_of(spark, "t1-nokeys"), compact_every=2)


def test_scheduled_compaction_removes_old_batches(spark):
    ev = pq.read_table(f"{SF01}/events.parquet")
    d = tempfile.mkdtemp(prefix="dfinsight-sched-")
    now = time.time() - 100
    for i in range(8):
        _write(d, f"p{i}.parquet", ev.filter(pc.equal(pc.bit_wise_and(ev["event_id"], 7), i)), now + i)
    base = base_of(spark, "t1-sched")
    agg = streams.stream_counts(streams.file_stream(spark, d, max_files_per_trigger=1), "event_type")
    cur = streams.run_updates(agg, ["event_type"], base, compact_every=2)
    assert sum(r.n for r in cur.collect()) == 10000
    assert streams._complete(spark, f"{base}/snapshot", "upto") == [5, 7]
    assert streams._complete(spark, f"{base}/log", "batch") == [6, 7]


def test_unfinished_batches_are_not_read(spark):
    d = tempfile.mkdtemp(prefix="dfinsight-partial-")
    spark.read.parquet(f"{SF01}/events.parquet").write.mode("append").parquet(d)
    base = base_of(spark, "t1-partial")
    streams.run_updates(streams.stream_counts(streams.file_stream(spark, d), "event_type"), ["event_type"], base)
    spark.createDataFrame([("click", 10**9)], "event_type string, n long").write \
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/log/batch=99")
    cur = streams.current_table(spark, base, ["event_type"])
    assert sum(r.n for r in cur.collect()) == 10000
