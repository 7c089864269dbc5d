"""Filters, fills and the one-pass cleaning audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col_, is_missing, name_col, safe_cast


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows with no NULL in ``cols``."""
    return df.filter(reduce(and_, [name_col(c).isNotNull() for c in cols]))


def range_predicate(c: ColumnOrName, lo=None, hi=None, drop_nan: bool = True) -> Column:
    """C3 predicate: ``lo <= c <= hi``; NULL is never kept, NaN dropped unless ``drop_nan=False``.

    Numeric bounds are for numeric columns. NaN is above every number, so it is tested for only where
    no upper bound already drops it; columns of dates, timestamps or text are compared as they are.
    """
    c = col_(c)
    parts = []
    if lo is not None:
        parts.append(c >= F.lit(lo))
    if hi is not None:
        parts.append(c <= F.lit(hi))
    if drop_nan and hi is None and isinstance(lo, (int, float)) and not isinstance(lo, bool):
        parts.append(~F.isnan(c))
    if not parts:
        parts.append(c.isNotNull())
    return reduce(and_, parts)


def keep_range(df: DataFrame, c: ColumnOrName, lo=None, hi=None, drop_nan: bool = True) -> DataFrame:
    """Lower / upper bound filter."""
    return df.filter(range_predicate(c, lo, hi, drop_nan))


def present(c: ColumnOrName) -> Column:
    """C4 predicate: not NULL and not the empty text."""
    c = col_(c)
    return c.isNotNull() & (c != F.lit(""))


def keep_present(df: DataFrame, c: ColumnOrName) -> DataFrame:
    """C4: keep non-NULL, non-empty text."""
    return df.filter(present(c))


@dataclass(frozen=True)
class Rule:
    """One branch of C6: the text column contains ``text`` and every ``(column, bound)`` is exceeded."""

    text_col: str
    text: str
    greater: tuple[tuple[str, float], ...]

    def predicate(self) -> Column:
        parts = [F.col(self.text_col).contains(self.text)]
        parts += [safe_cast(c, "double") > F.lit(v) for c, v in self.greater]
        return reduce(and_, parts)


def any_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows matching at least one rule; a row matching several appears once (a filter, not a union)."""
    return df.filter(reduce(or_, [r.predicate() for r in rules]))


def fill_missing(df: DataFrame, values: dict[str, object], normalise_sentinels: bool = False) -> DataFrame:
    """Fill NULL with a per-column default (``fillna`` semantics).

    ``normalise_sentinels=True`` also replaces the text sentinels '' and 'null'.
    """
    cols = {}
    for name, value in values.items():
        c = name_col(name)
        if normalise_sentinels:
            cols[name] = F.when(is_missing(c), F.lit(value)).otherwise(c)
        else:
            cols[name] = F.coalesce(c, F.lit(value))
    return df.withColumns(cols)


@dataclass(frozen=True)
class Step:
    """A cleaning step for A10: ``keep`` is the predicate of rows that survive it."""

    name: str
    keep: Column


def _counters(steps: list[Step]) -> list[Column]:
    """The four counters of every step, as aggregates over one row set."""
    aggs = []
    passed = F.lit(True)
    for i, step in enumerate(steps):
        aggs += [
            F.count_if(passed).alias(f"in_{i}"),
            F.count_if(passed & (step.keep == F.lit(False))).alias(f"rule_{i}"),
            F.count_if(passed & step.keep.isNull()).alias(f"null_{i}"),
            F.count_if(passed & (step.keep == F.lit(True))).alias(f"out_{i}"),
        ]
        passed = passed & F.coalesce(step.keep, F.lit(False))
    return aggs


def _one_row_per_step(wide: DataFrame, steps: list[Step]) -> DataFrame:
    stack = ", ".join(
        f"{i + 1}, '{s.name.replace(chr(39), chr(39) * 2)}', in_{i}, rule_{i}, null_{i}, out_{i}"
        for i, s in enumerate(steps)
    )
    return wide.selectExpr(
        f"stack({len(steps)}, {stack}) AS (step_no, step, n_in, n_rule, n_null, n_out)"
    ).withColumn("step_no", F.col("step_no").cast("int"))


def cleaning_audit(df: DataFrame, steps: list[Step]) -> DataFrame:
    """A10 (+ C8, D1): rows in, removed by the rule, removed because the predicate was NULL, rows out.

    Steps run in sequence, so each counter only sees rows that passed every earlier step. All
    counters come from one aggregation pass; the wide row is unpivoted to one row per step.
    Output: (step_no int, step string, n_in, n_rule, n_null, n_out) with n_in = n_rule + n_null + n_out.
    """
    return _one_row_per_step(df.agg(*_counters(steps)), steps)


def land_audited(df: DataFrame, steps: list[Step], write: Callable[[DataFrame], object], finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A10 while the clean table is written: the rows of :func:`cleaning_audit`, counted by the job that lands the rows
    surviving ``steps`` (``Dataset.observe``), so the input is read once for both.

    ``write`` lands the clean table and must run exactly one job over it (e.g. ``lambda t: land_parquet(t, path)``);
    ``finish`` is applied to the surviving rows first (fills and projections). Counters are merged once per finished task of
    the writing stage, so a task that is run again is not counted twice, provided the input comes to that stage
    without a shuffle (scan, cleaning and write are then one stage). Only the counters reach the driver.
    """
    observed = Observation("cleaning")
    kept = apply_steps(df.observe(observed, *_counters(steps)), steps)
    write(finish(kept) if finish else kept)
    counted = observed.get  # waits for the write
    schema = ", ".join(f"{k} long" for k in counted)
    return _one_row_per_step(df.sparkSession.createDataFrame([tuple(int(v or 0) for v in counted.values())], schema), steps)


def apply_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    """The rows that survive every step (NULL predicates drop the row, as a filter does)."""
    return df.filter(reduce(and_, [F.coalesce(s.keep, F.lit(False)) for s in steps]))
