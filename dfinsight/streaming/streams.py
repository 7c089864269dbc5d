"""Structured Streaming operators (T1-T5) and their batch forms.

Streams read files (``readStream`` with a fixed schema); event time must be ``timestamp`` for
watermarks, so timestamp_ntz columns are mapped to the same UTC instant and back. State lives in
the checkpoint folder under the session's shared ``spark.checkpoint.dir``.

Sinks: aggregations run in ``update`` mode; each micro-batch's changed rows are written with their
batch id (overwrite per batch id, so a retried batch is idempotent), and the current table is the
latest row per key over finished batches. Every n-th batch the log is compacted and old batches go.
Append-only results (dedupe) use the parquet file sink. The folder of a stream is always named by the
caller, because the state in it must be found again by the next process.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import instant_to_ntz, ntz_to_instant
from ..session import checkpoint_dir

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ----------------------------------------------------------------------------- sources
def file_stream(spark: SparkSession, directory: str, glob: str = "*.parquet", schema=None,
                max_files_per_trigger: int | None = None, sample_path: str | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A parquet file stream over ``directory`` (files matching ``glob``), schema fixed up front.

    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound each micro-batch, so a large
    backlog drains in several bounded batches even under ``availableNow``.
    """
    if schema is None:
        schema = spark.read.parquet(sample_path or f"{directory.rstrip('/')}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.parquet(directory)


def with_event_time(stream: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Add a ``timestamp`` event-time column for a timestamp_ntz ``ts`` (same wall clock, UTC)."""
    return stream.withColumn(out, ntz_to_instant(ts))


# ----------------------------------------------------------------------------- sinks
def stream_base(spark: SparkSession, name: str) -> str:
    """``<shared folder>/dfinsight-streams/<name>``: the same for every process with the same
    ``spark.checkpoint.dir``, and outside the scratch prefix that ``clean_scratch`` removes."""
    root = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
            or checkpoint_dir(spark))
    return f"{root.rstrip('/')}/dfinsight-streams/{name}"


def remove_base(spark: SparkSession, base: str) -> bool:
    """Delete the folder of a stream that will not be run again: its state, log and output."""
    if "/dfinsight-streams/" not in base:
        raise ValueError(f"{base} is not a folder of a stream")
    fs, jpath = _file_system(spark, base)
    return bool(fs.exists(jpath) and fs.delete(jpath, True))


@contextmanager
def _state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """Streams that start in this block keep their state in ``provider`` where the session has Spark's default."""
    before = spark.conf.get(STATE_STORE)
    if provider is None or not before.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_STORE, provider)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def start_updates(agg: DataFrame, base: str, trigger: dict | None = None, keys: list[str] | None = None,
                  compact_every: int | None = None):
    """Start an aggregating stream in update mode writing its change log under ``base``; return
    the ``StreamingQuery``. ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "1 minute"}`` for a long-running counter); default: drain what is there.

    ``base`` holds the state and the counts: give the same folder to resume, and keep it out of the
    scratch prefix (:func:`stream_base` is such a place). With ``keys`` and ``compact_every`` every
    n-th batch is followed by :func:`compact_updates`, which also removes old batches, so the folder
    does not grow with the life of the stream."""
    if f"{checkpoint_dir(agg.sparkSession).rstrip('/')}/dfinsight/" in f"{base}/":
        raise ValueError("a stream's folder must not lie under the scratch prefix; see stream_base")
    if compact_every and not keys:
        raise ValueError("compact_every needs the keys of the table")
    log = f"{base}/log"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_updates(batch.sparkSession, base, keys)

    writer = (agg.writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", f"{base}/checkpoint"))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _complete(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers N of the finished ``prefix=N`` sub-folders of ``path`` (those with the writer's _SUCCESS
    mark; a listing on the driver, no job). A folder that is still being written is left out."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(jpath)]
    done = [n for n in names if n.startswith(prefix + "=") and fs.exists(_file_system(spark, f"{path}/{n}/_SUCCESS")[1])]
    return sorted(int(n.split("=", 1)[1]) for n in done)


def _changes(spark: SparkSession, base: str, upto: int | None = None, before: int | None = None) -> DataFrame | None:
    """The newest snapshot (older than ``before``, if given) and the finished batches after it, up to
    ``upto``; None when there is neither."""
    snaps = [n for n in _complete(spark, f"{base}/snapshot", "upto") if before is None or n < before]
    since = snaps[-1] if snaps else -1
    batches = [n for n in _complete(spark, f"{base}/log", "batch") if n > since and (upto is None or n <= upto)]
    found = [spark.read.parquet(f"{base}/snapshot/upto={since}")] if snaps else []
    if batches:
        found.append(spark.read.option("basePath", f"{base}/log").parquet(*[f"{base}/log/batch={n}" for n in batches]))
    return None if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])


def current_table(spark: SparkSession, base: str, keys: list[str], schema=None) -> DataFrame:
    """The current result of a stream started with :func:`start_updates` (latest row per key):
    the newest snapshot written by :func:`compact_updates` plus the finished log batches after it.
    Before any batch is logged: an empty table of ``schema`` (the aggregate's schema)."""
    log = _changes(spark, base)
    if log is None:
        if schema is None:
            raise ValueError(f"no finished batch under {base}, and no schema for an empty table")
        return spark.createDataFrame([], schema)
    return latest_per_key(log, keys)


def compact_updates(spark: SparkSession, base: str, keys: list[str]) -> int | None:
    """Write the current table as a snapshot at the newest finished batch; later reads skip every
    batch up to it. Batches and snapshots that the snapshot before it already covered are removed; one
    generation stays for readers that listed the folder just before, and for a retry. Returns that
    batch id (None when nothing is logged yet)."""
    batches = _complete(spark, f"{base}/log", "batch")
    if not batches:
        return None
    upto = batches[-1]
    now = latest_per_key(_changes(spark, base, upto, before=upto), keys)
    now.withColumn("batch", F.lit(upto)).write.mode("overwrite").parquet(f"{base}/snapshot/upto={upto}")
    older = [n for n in _complete(spark, f"{base}/snapshot", "upto") if n < upto]
    if older:
        gone = [f"{base}/log/batch={n}" for n in batches if n <= older[-1]] + [f"{base}/snapshot/upto={n}" for n in older[:-1]]
        for path in gone:
            fs, jpath = _file_system(spark, path)
            fs.delete(jpath, True)
    return upto


def run_updates(agg: DataFrame, keys: list[str], base: str, compact_every: int | None = None) -> DataFrame:
    """Run an aggregating stream in update mode until the input is drained; return the current table.
    Running again with the same ``base`` resumes from its checkpoint."""
    handle = start_updates(agg, base, keys=keys, compact_every=compact_every)
    try:
        handle.awaitTermination()
    finally:
        handle.stop()
    return current_table(agg.sparkSession, base, keys, schema=agg.schema)


def latest_per_key(log: DataFrame, keys: list[str]) -> DataFrame:
    """Current table of an update log: per key, the row of the highest batch id."""
    values = [c for c in log.columns if c not in keys and c != "batch"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("_row"))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def run_append(stream: DataFrame, base: str, state_store: str | None = None) -> DataFrame:
    """Run an append-mode stream into a parquet file sink until drained; return the rows written so far.
    Running again with the same ``base`` resumes from its checkpoint. ``state_store``: the provider class of a
    stream that cannot run on Spark's default one; a session set to another class than that default keeps its own."""
    with _state_store(stream.sparkSession, state_store):  # a stream takes the session's settings as it starts
        handle = (stream.writeStream.outputMode("append").format("parquet")
                  .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
                  .trigger(availableNow=True).start())
    try:
        handle.awaitTermination()
    finally:
        handle.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/out")


# ----------------------------------------------------------------------------- operators
def stream_counts(stream: DataFrame, key: str) -> DataFrame:
    """Arrivals per key (a durable counter: the count survives restarts via the checkpoint)."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def latest_values(df: DataFrame, key: str, ts: str, tiebreak: str, values: list[str]) -> DataFrame:
    """T2 aggregate: per key, the row with the greatest (ts, tiebreak); works in batch and stream."""
    row = F.struct(*[F.col(c) for c in [ts, tiebreak, *values]])
    agg = df.groupBy(key).agg(F.max_by(row, F.struct(F.col(ts), F.col(tiebreak))).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in [ts, tiebreak, *values]])


def stream_dedupe(stream: DataFrame, id_col: str, event_time: str, delay: str) -> DataFrame:
    """Drop redelivered messages (same id) seen within ``delay`` of event time."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])


def metric_series(df: DataFrame, event_time: str, node: str, value: str, every: str = "1 day",
                  delay: str | None = None) -> DataFrame:
    """T4: count and mean of ``value`` per node per tumbling window (``window_start``)."""
    if delay:
        df = df.withWatermark(event_time, delay)
    return df.groupBy(F.window(event_time, every).alias("w"), node).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"))


def flatten_window(df: DataFrame, ntz: bool = True) -> DataFrame:
    start = F.col("w.start")
    return df.select(*[c for c in df.columns if c != "w"],
                     (instant_to_ntz(start) if ntz else start).alias("window_start"))


def metric_latest(df: DataFrame, key: str, ts: str, tiebreak: str, value: str) -> DataFrame:
    """T5: per key, the latest value (greatest (ts, tiebreak)), the mean, the maximum and the count."""
    return df.groupBy(key).agg(
        F.max_by(F.col(value), F.struct(F.col(ts), F.col(tiebreak))).alias("latest"),
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n"))


def stream_latest(stream: DataFrame, key: str, ts: str, tiebreak: str, values: list[str], base: str) -> DataFrame:
    """Run the latest-value aggregation over a stream until drained; the current table."""
    return run_updates(latest_values(stream, key, ts, tiebreak, values), [key], base)
