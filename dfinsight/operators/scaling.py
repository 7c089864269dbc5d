"""Scaling reports over a timing table.

Input ``runs(query, n_workers, run, worker, secs)``; several rows per worker are summed, so a
task log works as well as one row per worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published method: clamp range of the parallel fraction, and the
# predicted-curve grid (50 points from 1 to 8 workers).
F_LOW, F_HIGH = 0.1, 0.95
CURVE_LO, CURVE_HI, CURVE_POINTS = 1.0, 8.0, 50


def run_times(runs: DataFrame) -> DataFrame:
    """B1: time of a run = its slowest worker; T(query, n) = mean over repeats.

    Output (query, n_workers, n_runs, secs).
    """
    per_worker = runs.groupBy("query", "n_workers", "run", "worker").agg(F.sum("secs").alias("secs"))
    per_run = per_worker.groupBy("query", "n_workers", "run").agg(F.max("secs").alias("secs"))
    return per_run.groupBy("query", "n_workers").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("secs").alias("secs"))


def scaling_report(runs: DataFrame) -> DataFrame:
    """B2 + B3: speedup S = T(1) / T(n) (0 when T(n) <= 0, NULL without a one-worker run) and the
    parallel fraction from Amdahl's law, f = (1 - 1/S) / (1 - 1/n) (for n = 2: 2(1 - 1/S)), 0 when
    S <= 0, clamped to [0.1, 0.95]; ``f_raw`` is the unclamped value. NULL for n = 1.

    The baseline T(1) is attached with a window over each query's few report rows (J2 as a
    partitioned window rather than a join).
    """
    t = run_times(runs)
    base = F.max(F.when(F.col("n_workers") == 1, F.col("secs"))).over(Window.partitionBy("query"))
    t = t.withColumn("base_secs", base)
    s = F.when(F.col("base_secs").isNull(), F.lit(None).cast("double")) \
        .when(F.col("secs") <= 0, F.lit(0.0)) \
        .otherwise(F.col("base_secs") / F.col("secs"))
    t = t.withColumn("speedup", s)
    n = F.col("n_workers").cast("double")
    f_raw = F.when((F.col("n_workers") <= 1) | F.col("speedup").isNull(), F.lit(None).cast("double")) \
        .when(F.col("speedup") <= 0, F.lit(0.0)) \
        .otherwise((F.lit(1.0) - F.lit(1.0) / F.col("speedup")) / (F.lit(1.0) - F.lit(1.0) / n))
    t = t.withColumn("f_raw", f_raw)
    clamped = F.greatest(F.lit(F_LOW), F.least(F.col("f_raw"), F.lit(F_HIGH)))
    return t.withColumn("f", F.when(F.col("f_raw").isNull(), F.lit(None).cast("double")).otherwise(clamped))


def amdahl_curve(report: DataFrame, lo: float = CURVE_LO, hi: float = CURVE_HI,
                 points: int = CURVE_POINTS) -> DataFrame:
    """Predicted speedup 1 / ((1 - f) + f / n) at ``points`` evenly spaced n in [lo, hi], next to
    the linear line S = n, for every report row with a fraction (query, n_workers the f came from).
    Each report row is exploded into its own points; no cross join."""
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    rows = report.filter(F.col("f").isNotNull()).select("query", "n_workers", "f")
    pts = rows.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    n = F.lit(lo) + F.col("point").cast("double") * F.lit(step)
    return pts.select("query", "n_workers", "point", n.alias("n"),
                      (F.lit(1.0) / ((F.lit(1.0) - F.col("f")) + F.col("f") / n)).alias("predicted"),
                      n.alias("linear"))
