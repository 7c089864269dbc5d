"""Session helpers: a tuned local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "dfinsight",
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench; a cluster passes its own session to the operators."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stream state.

    Taken from the session (``SparkContext.getCheckpointDir`` or ``spark.checkpoint.dir``). A fresh
    temporary folder is used only when nothing is set and the master is local, as in tests; on a
    cluster an unset folder is an error, because a machine-local path does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="dfinsight-ckpt-"))
    return sc.getCheckpointDir()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state, landed tables)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/dfinsight/{name}-{uuid.uuid4().hex}"


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20,
                  min_partitions: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` so one shuffle partition of an input of ``input_bytes``
    holds about ``target_bytes`` (AQE then coalesces small ones and splits skewed joins), and the
    AQE advisory size to match. Returns the partition count. Range layouts use the same count."""
    n = max(min_partitions or spark.sparkContext.defaultParallelism, -(-input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n


def clean_scratch(spark: SparkSession) -> bool:
    """Delete this library's scratch prefix (``<checkpoint dir>/dfinsight``: range layouts, rank
    candidates, landed tables, stream logs and state) at the end of a job. Only call it once no
    DataFrame returned by the operators is used any more. Returns whether anything was deleted."""
    prefix = f"{checkpoint_dir(spark).rstrip('/')}/dfinsight"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(prefix)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath) and fs.delete(jpath, True))
