"""Per-group ranking, running counts, global numbering and range sort."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranged import PID, POS, RUN, partition_offsets, ranged_layout

OrderKey = Column | str | tuple[str, str]


def _key_parts(order: list[OrderKey]) -> list[tuple[str, bool]] | None:
    """(name, descending) pairs when every sort key is named; None when one is a bare Column."""
    parts = []
    for o in order:
        if isinstance(o, str):
            parts.append((o, False))
        elif isinstance(o, tuple):
            parts.append((o[0], o[1].lower() == "desc"))
        else:
            return None
    return parts


def _sort_cols(parts: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(n).desc() if d else F.col(n).asc() for n, d in parts]


def _top_keys(keys: DataFrame, label: str, names: list[str], cols: list[Column], k: int, method: str,
              rank_name: str) -> DataFrame:
    """Per label, the distinct sort keys whose dense rank / rank is <= k, from (label, keys, _ties)."""
    w = Window.partitionBy(label).orderBy(*cols)
    top = keys.withColumn("_dr", F.dense_rank().over(w)).filter(F.col("_dr") <= F.lit(k))
    if method == "dense_rank":
        top = top.withColumn(rank_name, F.col("_dr"))
    else:  # rank = 1 + rows with a strictly better key; only the top k distinct keys can reach k
        before = Window.partitionBy(label).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
        top = top.withColumn(rank_name, (F.lit(1) + F.coalesce(F.sum("_ties").over(before), F.lit(0))).cast("int"))
        top = top.filter(F.col(rank_name) <= F.lit(k))
    return top.select(label, *names, F.col(rank_name).cast("int").alias(rank_name))


def top_per_label(df: DataFrame, label: str, order: list[OrderKey], k: int = 3,
                  method: str = "dense_rank", rank_name: str = "rank_in_label") -> DataFrame:
    """Rank rows inside each label and keep rank <= k.

    ``order``: sort keys as names (ascending), ``(name, "desc" | "asc")`` pairs, or Columns.

    ``dense_rank`` / ``rank`` keep every tie, so a label may return more than k rows; they need named
    keys. The distinct keys of each label (with their number of rows, for ``rank``) come from one
    aggregation, pre-aggregated in the scan's tasks, so rows that tie in a hot label cost one row per
    task; ``WindowGroupLimit`` cuts them to the top k, and an equi-join keeps the rows with such a
    key. A hot tied key is a skewed join key, which adaptive execution splits.

    ``row_number`` is one window and needs ``order`` to end in a unique column: then no two rows tie
    and ``WindowGroupLimit`` leaves at most k rows per label and task before the shuffle.
    """
    parts = _key_parts(order)
    cols = _sort_cols(parts) if parts is not None else list(order)
    if method == "row_number":
        w = Window.partitionBy(label).orderBy(*cols)
        return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= F.lit(k))
    if parts is None or method not in ("dense_rank", "rank"):
        raise ValueError("dense_rank and rank need named sort keys")
    names = [n for n, _ in parts]
    keys = df.groupBy(label, *names).agg(F.count(F.lit(1)).alias("_ties"))
    top = _top_keys(keys, label, names, cols, k, method, rank_name)
    on = [label, *names]
    top = top.select(*[F.col(c).alias(f"__r_{c}") for c in on], rank_name)
    same = reduce(and_, [df[c].eqNullSafe(top[f"__r_{c}"]) for c in on])
    return df.join(top, same).drop(*[f"__r_{c}" for c in on])


def running_count(df: DataFrame, key: str, ts: str, tiebreak: str, out: str = "running_count",
                  n_partitions: int | None = None) -> DataFrame:
    """Per key, the number of rows up to and including this one in (ts, tiebreak) order.

    Same result as ``count(*) OVER (PARTITION BY key ORDER BY ts, tiebreak ROWS UNBOUNDED
    PRECEDING)``, but no task ever holds a whole key: rows are range-partitioned on
    (key, ts, tiebreak), and while a sorted partition is written the position inside its key is
    counted. Only the first key of a partition can have rows in earlier ones, so what is carried in is
    one row per partition (broadcast: bounded by the partition count).
    """
    laid = ranged_layout(df, [key, ts, tiebreak], n_partitions, run_of=key)
    edges = laid.groupBy(PID).agg(F.min_by(F.struct(key), POS).alias("_head"), F.max_by(F.struct(key), POS).alias("_tail"),
                                  F.max_by(RUN, POS).alias("_n"))
    before = edges.select(F.col(PID).alias("_p"), F.col("_tail").alias("_t"), "_n")
    carried = (edges.select(PID, "_head").join(before, F.col("_head").eqNullSafe(F.col("_t")) & (F.col("_p") < F.col(PID)))
               .groupBy(PID, "_head").agg(F.sum("_n").alias("_carried")))
    joined = laid.join(F.broadcast(carried), PID, "left")
    first = F.struct(key).eqNullSafe(F.col("_head"))
    return (joined.withColumn(out, (F.col(RUN) + F.when(first, F.col("_carried")).otherwise(0)).cast("long"))
            .drop(PID, POS, RUN, "_head", "_carried"))


def global_sequence(df: DataFrame, order: list[Column | str], out: str = "seq",
                    n_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` without moving every row into one task.

    Offsets per range partition (one row each, a proven bound) are broadcast and added to the
    position inside the partition. ``order`` must end in a unique column.
    """
    laid = ranged_layout(df, order, n_partitions)
    offsets = partition_offsets(laid)
    return (laid.join(F.broadcast(offsets.select(PID, "_offset")), PID)
            .withColumn(out, F.col("_offset") + F.col(POS) + F.lit(1))
            .drop(PID, POS, "_offset"))


def sorted_ranges(df: DataFrame, key: str, n: int, unique: str) -> DataFrame:
    """Total-order sort of a big table into ``n`` range partitions, with proof rows
    (partition, n_rows, min_key, max_key); the key ranges ascend. ``unique`` breaks ties, so the
    rows of one hot key spread over several ranges (which then share that key at their ends)."""
    laid = ranged_layout(df, [key, unique], n)
    return (laid.groupBy(F.col(PID).alias("partition"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")))


def sort_in_ranges(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """O5 data side: the table itself, range-partitioned and sorted (written out in order)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
