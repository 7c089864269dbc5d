"""Range-partitioned, sorted layout with stable positions.

Sequential operators (global numbering, running counts, lag per key) would otherwise need a
window with no partition (one task for the whole table) or one partitioned by a key that may hold
a third of all rows. Instead the table is range-partitioned on the full sort order, sorted within
partitions and written once to the shared checkpoint folder. Each row then carries

* ``_pid``: its range partition (ranges ascend with ``_pid``), and
* ``_pos``: its 0-based position inside that partition.

Per-partition facts are tiny (one row per partition, or per partition and key) and carry the
sequence across partition borders. A hot key simply spans several balanced partitions.

Later steps use ``_pid`` / ``_pos`` only as data (grouping, join and window keys), never the
physical partitioning, so the layout is stored as Parquet: each later pass reads just the columns
it needs (the per-partition counts read ``_pid`` alone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .sizing import materialize

PID = "_pid"
POS = "_pos"
RUN = "_run"


def ranged_layout(df: DataFrame, order: list[Column | str], n: int | None = None, run_of: str | None = None) -> DataFrame:
    """Range-partition on ``order`` (which must end in a unique key), sort, number, materialise.

    The numbered rows are written under the session's shared checkpoint folder and read back
    (columnar, pruned reads). That pins the sampled range bounds: every later read sees the same
    positions, and a lost executor re-reads files rather than re-sampling. The job runs when this is
    called. ``run_of`` adds ``_run``: the 1-based position among the partition's rows of that column's
    value, which must lead ``order``.
    """
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    pid = F.spark_partition_id()
    # monotonically_increasing_id = (partition index << 33) + row index inside the partition.
    ranged = ranged.withColumn(PID, pid).withColumn(
        POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    if run_of is not None:
        ranged = _with_runs(ranged, run_of)
    return materialize(ranged, "layout")


def changes(column) -> "np.ndarray":
    """Arrow column -> where its value differs from the one before (True for the first); NULL equals NULL."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not len(column):
        return np.zeros(0, bool)
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differs = pc.fill_null(pc.not_equal(a, b), pa.scalar(True))
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    rest = np.logical_and(differs.to_numpy(zero_copy_only=False), ~both_null.to_numpy(zero_copy_only=False))
    return np.concatenate([[True], rest])


def _with_runs(ranged: DataFrame, key: str) -> DataFrame:
    """Adds the position inside the run of ``key`` to sorted partitions: one Arrow batch at a time, with
    the last key and its count so far."""
    at = ranged.columns.index(key)

    def number(batches):
        import numpy as np
        import pyarrow as pa

        last, count = None, 0  # one-row column with the last key, rows of it so far
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(at)
            new = changes(x)
            if last is not None:
                new[0] = changes(pa.concat_arrays([last, x.slice(0, 1)]))[1]
            pos = np.arange(b.num_rows)
            starts = np.maximum.accumulate(np.where(new, pos, -1))
            run = np.where(starts >= 0, pos - starts + 1, pos + count + 1)
            last, count = x.slice(b.num_rows - 1, 1), int(run[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run.astype(np.int64))], names=[*b.schema.names, RUN])

    importable(ranged.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields), f"{RUN} long"])
    return ranged.mapInArrow(number, schema)


def partition_offsets(laid: DataFrame) -> DataFrame:
    """Rows before each partition and in it: (``_pid``, ``_offset``, ``_n``). One row per
    partition, so the unpartitioned window and the later broadcast are bounded by the partition
    count."""
    from pyspark.sql import Window

    counts = laid.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(PID, F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long").alias("_offset"), "_n")


def with_next(laid: DataFrame, cols: dict[str, str]) -> DataFrame:
    """A layout with the values of the next row in the whole order, ``cols`` naming them: {column: name}.

    Inside a range partition the next row is a ``lead`` (a window a partition, which the ranges keep even); the
    last row of a partition takes the first row of the next one, one row a partition."""
    from pyspark.sql import Window

    inside = Window.partitionBy(PID).orderBy(POS)
    firsts = laid.filter(F.col(POS) == 0).select(PID, F.struct(*cols).alias("_first"))
    after = firsts.select(PID, F.lead("_first").over(Window.orderBy(PID)).alias("_after"))
    rows = laid.withColumn("_lead", F.lead(F.struct(*cols)).over(inside)).join(F.broadcast(after), PID)
    following = F.coalesce("_lead", "_after")
    return rows.withColumns({name: following[c] for c, name in cols.items()}).drop("_lead", "_after")


def carried_before(laid: DataFrame, key: str, value: str) -> DataFrame:
    """(``_pid``, ``_key``, ``_value``): the last non-NULL ``value`` before each partition, with its key, one row a partition.

    Only the last key of a partition can go on in the next; a value of another key says that this one has none."""
    from pyspark.sql import Window

    last = laid.groupBy(PID).agg(F.max_by(key, POS).alias("_key"))
    own = laid.select(PID, POS, F.col(key).alias("_k"), F.col(value).alias("_v")).join(F.broadcast(last), PID).filter("_k <=> _key")
    known = own.groupBy(PID).agg(F.any_value("_key").alias("_key"), F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(POS))).alias("_value"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col("_value").isNotNull(), F.struct("_key", "_value")), ignorenulls=True).over(before)
    return known.select(PID, found.alias("_b")).select(PID, F.col("_b._key").alias("_key"), F.col("_b._value").alias("_value"))
