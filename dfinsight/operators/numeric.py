"""Numeric table jobs (M1 matrix products, M2 trapezoid integral whole and per window, J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ntz_micros
from ..plans.ranged import changes, ranged_layout, with_next
from ..session import importable


def matmul(a: DataFrame, b: DataFrame, combine_duplicates: bool = False) -> DataFrame:
    """C = A x B on coordinate tables (row, col, value).

    The product joins on the inner index and sums per output cell; the sum runs as a partial
    aggregate in the join's own stage, so joined pairs are never shuffled, and AQE splits a skewed
    inner index across tasks. Duplicate coordinates need no pre-sum (the product is linear);
    ``combine_duplicates=True`` sums them first, worth its extra shuffle only when many repeat.
    """
    if combine_duplicates:
        a = a.groupBy("row", "col").agg(F.sum("value").alias("value"))
        b = b.groupBy("row", "col").agg(F.sum("value").alias("value"))
    j = a.alias("a").join(b.alias("b"), F.col("a.col") == F.col("b.row"))
    return j.groupBy(F.col("a.row").alias("row"), F.col("b.col").alias("col")).agg(
        F.sum(F.col("a.value") * F.col("b.value")).alias("value"))


def gram_matrix(df: DataFrame, vec_col: str) -> DataFrame:
    """M1 for dense rows: G = X^T X of an array column, as (i, j, value) cells.

    Each task multiplies its own rows into one d x d partial sum: an Arrow list column flattens to
    one contiguous numpy block (no per-row Python objects), and ``X^T X`` runs in BLAS. Only those
    partials (d^2 cells per task, independent of the row count) are shuffled and added.
    """
    import numpy as np
    import pyarrow as pa

    def partial(batches):
        acc = None
        for batch in batches:
            arr = batch.column(0)
            if len(arr) == 0:
                continue
            offsets = arr.offsets.to_numpy()
            d = int(offsets[1] - offsets[0])
            if not np.all(np.diff(offsets) == d):
                raise ValueError("gram_matrix needs arrays of one length")
            x = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), d)
            g = x.T @ x
            acc = g if acc is None else acc + g
        if acc is not None:
            d = acc.shape[0]
            ii, jj = np.meshgrid(np.arange(d, dtype=np.int32), np.arange(d, dtype=np.int32), indexing="ij")
            yield pa.RecordBatch.from_arrays([pa.array(ii.ravel()), pa.array(jj.ravel()), pa.array(acc.ravel())],
                                             names=["i", "j", "value"])

    rows = df.select(vec_col).filter(F.col(vec_col).isNotNull())
    parts = rows.mapInArrow(partial, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def _tiles(df: DataFrame, tile: int, names: tuple[str, str]) -> DataFrame:
    """The cells of a coordinate matrix by tile: (names, r, c, v), repeated coordinates added up."""
    cells = df.filter("row is not null and col is not null and value is not null").groupBy("row", "col").agg(F.sum(F.col("value").cast("double")).alias("value"))
    inside = lambda c: F.pmod(F.col(c), F.lit(tile)).cast("int").alias(c[0])
    cell = F.struct(inside("row"), inside("col"), F.col("value").alias("v"))
    whole = cells.groupBy(*[F.expr(f"({c} - pmod({c}, {tile})) div {tile}").alias(n) for c, n in zip(("row", "col"), names)]).agg(F.collect_list(cell).alias("cells"))
    return whole.select(*names, *[F.col(f"cells.{x}").alias(x) for x in "rcv"])


def matmul_tiled(a: DataFrame, b: DataFrame, tile: int = 128, spread: int = 4) -> DataFrame:
    """M1 in blocks: C = A x B on coordinate tables (row, col, value: whole numbers and a number) by tiles of ``tile`` x ``tile``.

    Tiles that share their part of the inner index meet in pairs. Each side's tiles are dealt to ``spread`` groups and sent once to every
    group of the other side, so a part of the inner index that many rows and columns use is ``spread`` x ``spread`` keys, not one, and
    a tile moves ``spread`` times, however large the matrices. A task multiplies one pair at a time: it holds an Arrow batch of
    tiles (64 MB unless set otherwise), two dense tiles and one product; the cells of the products are added up by a
    partial and a final sum. Cells that are exactly 0 are left out; so are rows with a NULL."""
    importable(a.sparkSession)
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(spread)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    left = _tiles(a, tile, ("ti", "tk")).select("ti", "tk", *[F.col(x).alias(f"a{x}") for x in "rcv"], group("ti").alias("ga"), every.alias("gb"))
    right = _tiles(b, tile, ("tk", "tj")).select("tk", "tj", *[F.col(x).alias(f"b{x}") for x in "rcv"], group("tj").alias("gb"), every.alias("ga"))
    pairs = left.join(right, ["tk", "ga", "gb"]).select("ti", "tj", "ar", "ac", "av", "br", "bc", "bv")

    def products(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for n in range(batch.num_rows):
                ti, tj = (batch.column(i)[n].as_py() for i in (0, 1))
                ar, ac, av, br, bc, bv = (batch.column(i)[n].values.to_numpy(zero_copy_only=False) for i in range(2, 8))
                right_tile = np.zeros((tile, tile))
                right_tile[br, bc] = bv
                if len(av) * 8 < tile * tile:  # few cells: only the rows of the other tile that they name
                    rows, at = np.unique(ar, return_inverse=True)
                    part = np.zeros((len(rows), tile))
                    np.add.at(part, at, av[:, None] * right_tile[ac])
                else:
                    left_tile = np.zeros((tile, tile))
                    left_tile[ar, ac] = av
                    rows, part = np.arange(tile), left_tile @ right_tile
                i, j = np.nonzero(part)
                yield pa.RecordBatch.from_arrays([pa.array(ti * tile + rows[i], pa.int64()), pa.array(tj * tile + j, pa.int64()), pa.array(part[i, j])], names=["row", "col", "value"])

    return pairs.mapInArrow(products, "row long, col long, value double").groupBy("row", "col").agg(F.sum("value").alias("value")).filter("value <> 0")


def integrate(df: DataFrame, key: str, ts: str, value: str, tiebreak: str, n_partitions: int | None = None) -> DataFrame:
    """M2: per key, the trapezoid integral of ``value`` over ``ts`` (seconds), plus the point count.

    Same as ``sum((ts - lag(ts)) * (value + lag(value)) / 2) OVER (PARTITION BY key ORDER BY ts,
    tiebreak)`` summed per key (0 for a single point; a NULL time or value leaves out the two
    segments it ends), but a key holding a third of all rows never lands in one task: rows are
    range-partitioned on (key, ts, tiebreak) and every sorted partition is integrated as it streams
    by, one Arrow batch at a time. Only pieces leave it: count, area, first and last point of each
    key in each batch. The segment from one partition to the next comes from those.
    """
    spark = df.sparkSession
    importable(spark)
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    micros = ntz_micros(ts) if dict(df.dtypes)[ts] == "timestamp_ntz" else F.unix_micros(F.col(ts))
    points = (df.select(key, ts, tiebreak, value).repartitionByRange(n, key, ts, tiebreak).sortWithinPartitions(key, ts, tiebreak)
              .select(F.col(key).alias("k"), micros.alias("t"), F.col(value).cast("double").alias("v"), F.spark_partition_id().alias("p")))

    def pieces(batches):
        import numpy as np
        import pyarrow as pa

        last, number = None, 0  # one-row columns of the last point
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i) if last is None else pa.concat_arrays([last[i], b.column(i)]) for i in range(3)]
            new = changes(cols[0])
            t, v = (c.to_numpy(zero_copy_only=False).astype(float) for c in cols[1:])  # NULL becomes NaN
            area = np.concatenate([[0.0], np.diff(t) / 1e6 * (v[1:] + v[:-1]) / 2])
            area = np.where(new | np.isnan(area), 0.0, area)
            skip = 0 if last is None else 1
            new, area = new[skip:], area[skip:]
            starts = np.flatnonzero(np.concatenate([[True], new[1:]]))
            ends = np.append(starts[1:], len(new)) - 1
            opens = np.zeros(len(starts), bool)
            opens[0] = last is None  # what came before is in another partition
            idx, end = pa.array(starts), pa.array(ends)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(idx), b.column(3).take(idx), pa.array(number + np.arange(len(starts))), pa.array(opens), pa.array(ends - starts + 1),
                 pa.array(np.add.reduceat(area, starts)), b.column(1).take(idx), b.column(2).take(idx), b.column(1).take(end), b.column(2).take(end)],
                names=["k", "p", "i", "opens", "n", "inner", "t0", "v0", "t1", "v1"])
            number += len(starts)
            last = [b.column(i).slice(b.num_rows - 1, 1) for i in range(3)]

    kind = df.schema[key].dataType.simpleString()
    found = points.mapInArrow(pieces, f"k {kind}, p int, i long, opens boolean, n long, inner double, t0 long, v0 double, t1 long, v1 double")
    w = Window.partitionBy("k").orderBy("p", "i")
    edge = (F.col("t0") - F.lag("t1").over(w)) / F.lit(1e6) * (F.col("v0") + F.lag("v1").over(w)) / F.lit(2.0)
    whole = found.withColumn("edge", F.when(F.col("opens"), edge))
    return whole.groupBy(F.col("k").alias(key)).agg(
        F.sum("n").cast("long").alias("n_points"),
        (F.sum("inner") + F.coalesce(F.sum("edge"), F.lit(0.0))).alias("integral"))


def integrate_windows(df: DataFrame, key: str, ts: str, value: str, tiebreak: str, seconds: int, n_partitions: int | None = None) -> DataFrame:
    """M2 per window: (key, window_no, n_points, integral), windows of ``seconds`` counted from the epoch.

    A segment that crosses window edges is cut there, the value at an edge interpolated, so the windows of a
    key add up to :func:`integrate`. Rows lie in ranges of (key, ts, tiebreak), so a key with a third of all rows spans
    many; the segment between two ranges comes from one row a range. A window without points that a segment crosses
    is a row with 0 points. A row without time is in no window; one without value ends no segment."""
    width = seconds * 1_000_000
    micros = ntz_micros(ts) if dict(df.dtypes)[ts] == "timestamp_ntz" else F.unix_micros(F.col(ts))
    points = df.select(F.col(key).alias("k"), micros.alias("t"), F.col(tiebreak).alias("i"), F.col(value).cast("double").alias("v")).filter("t is not null")
    rows = with_next(ranged_layout(points, ["k", "t", "i"], n_partitions), {"k": "k2", "t": "t2", "v": "v2"})
    joined = F.expr("k <=> k2 and v is not null and v2 is not null and t2 > t")
    first = F.floor(F.col("t") / width)
    last = F.when(joined, F.greatest(first, F.floor((F.col("t2") - 1) / width))).otherwise(first)
    cut = rows.withColumns({"joined": F.coalesce(joined, F.lit(False)), "first": first}).withColumn("w", F.explode(F.sequence(first, F.coalesce(last, first))))
    lo, hi = F.greatest("t", F.col("w") * width), F.least("t2", (F.col("w") + 1) * width)
    at = lambda x: F.col("v") + (F.col("v2") - F.col("v")) * ((x - F.col("t")) / (F.col("t2") - F.col("t")))
    area = F.when(F.col("joined"), (hi - lo) / 1e6 * (at(lo) + at(hi)) / 2).otherwise(0.0)
    return cut.groupBy(F.col("k").alias(key), F.col("w").alias("window_no")).agg(
        F.count_if(F.col("w") == F.col("first")).alias("n_points"), F.sum(area).alias("integral"))
