"""T4: a metric series without holes, for charts with a regular time axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ntz_micros
from ..plans.ranged import PID, POS, carried_before, ranged_layout, with_next


def fill_gaps(series: DataFrame, node: str, start: str, value: str, seconds: int, n_partitions: int | None = None) -> DataFrame:
    """Every step of ``seconds`` between a node's first and last: the rows of ``series`` (node, start, value and others,
    one row a step) and, marked ``is_filled``, the missing steps. ``value`` is the last known one: NULL is replaced by the
    value before it, also across steps; it stays NULL before a node's first. Other columns are NULL in filled rows.

    The rows lie in ranges of (node, start), so a node with a third of all rows spans many; each row yields the steps up
    to the next row, and what a range needs from its neighbours is one row a range. Rows without a start are left out."""
    others = [c for c in series.columns if c not in (node, start, value)]
    micros = ntz_micros if dict(series.dtypes)[start] == "timestamp_ntz" else F.unix_micros
    laid = ranged_layout(series.filter(F.col(start).isNotNull()), [node, start], n_partitions)
    rows = with_next(laid, {node: "_node2", start: "_start2"})
    before = Window.partitionBy(PID, node).orderBy(POS)
    carried = carried_before(laid, node, value)
    rows = rows.join(F.broadcast(carried), PID, "left")
    own = F.last(value, ignorenulls=True).over(before)
    rows = rows.withColumn(value, F.coalesce(own, F.when(F.col("_key").eqNullSafe(F.col(node)), F.col("_value"))))
    steps = F.when(F.col("_node2").eqNullSafe(F.col(node)) & F.col("_start2").isNotNull(), F.floor((micros(F.col("_start2")) - micros(F.col(start))) / (seconds * 1_000_000)))
    rows = rows.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.coalesce(steps, F.lit(1)) - 1, F.lit(0)))))
    filled = F.col("_step") > 0
    at = F.col(start) + F.make_dt_interval(secs=F.col("_step") * seconds)
    return rows.select(node, at.alias(start), F.col(value), *[F.when(~filled, F.col(c)).alias(c) for c in others], filled.alias("is_filled"))
