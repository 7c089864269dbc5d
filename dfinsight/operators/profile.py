"""Table profile (D1-D5): one scan per report, never one job per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MISSING_SENTINELS, bucket, explode_labels, is_missing, name_col, pct, safe_cast


def _unpivot(wide: DataFrame, n: int, row_sql: list[str], names: str) -> DataFrame:
    return wide.selectExpr(f"stack({n}, {', '.join(row_sql)}) AS ({names})")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def row_count(df: DataFrame) -> DataFrame:
    """A one-row DataFrame (n_rows)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def missing_profile(df: DataFrame, cols: list[str] | None = None,
                    sentinels: tuple[str, ...] = MISSING_SENTINELS) -> DataFrame:
    """Per column, rows that are NULL / '' / 'null' and their percentage of all rows.

    One aggregation pass over all columns, then ``stack`` to (column_name, n_missing, pct_missing).
    ``pct_missing`` is NULL for an empty table.
    """
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(is_missing(name_col(c), sentinels)).alias(f"__m{i}") for i, c in enumerate(cols)])
    long = _unpivot(wide, len(cols), [f"{i + 1}, {_q(c)}, __m{i}, __n" for i, c in enumerate(cols)],
                    "position, column_name, n_missing, n_rows")
    return long.select(F.col("position").cast("int").alias("position"), "column_name", "n_missing",
                       pct("n_missing", "n_rows").alias("pct_missing"))


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """D3: mean, sample stddev (NULL for one row), min, max per column; one pass, then unpivot."""
    aggs = []
    for i, c in enumerate(cols):
        x = safe_cast(name_col(c), "double")  # text that is not a number counts as NULL
        aggs += [F.avg(x).alias(f"__a{i}"), F.stddev_samp(x).alias(f"__s{i}"),
                 F.min(x).alias(f"__lo{i}"), F.max(x).alias(f"__hi{i}"), F.count(x).alias(f"__n{i}")]
    wide = df.agg(*aggs)
    return _unpivot(wide, len(cols),
                    [f"{_q(c)}, __n{i}, __a{i}, __s{i}, __lo{i}, __hi{i}" for i, c in enumerate(cols)],
                    "column_name, n, mean, stddev, min, max")


def label_counts(df: DataFrame, col: str, sep: str = "/", k: int | None = None, trim: bool = False,
                 drop_empty: bool = False, out: str = "label") -> DataFrame:
    """Explode a delimited label column and count rows per label, most frequent first.

    With ``k`` it is a top-k (``TakeOrderedAndProject``) with the label as tie-break.
    """
    counted = (explode_labels(df.select(col), col, out, sep, trim, drop_empty)
               .groupBy(out).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(out).asc_nulls_first()))
    return counted if k is None else counted.limit(k)


def bucket_counts(df: DataFrame, col: str, width: int | float = 10, out: str = "bucket_start",
                  k: int | None = None) -> DataFrame:
    """Rows per bucket of width ``width`` (e.g. decade), ascending; NULL values form a NULL bucket."""
    res = df.groupBy(bucket(col, width).alias(out)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(out).asc_nulls_first())
    return res if k is None else res.limit(k)


def profile_table(df: DataFrame, numeric: list[str] | None = None,
                  sentinels: tuple[str, ...] = MISSING_SENTINELS) -> DataFrame:
    """D1 + D2 + D3 in one scan: per column (position, column_name, n_rows, n_missing, pct_missing,
    n, mean, stddev, min, max). ``numeric`` columns (default: every numeric column) get the
    statistics; the others have NULL there. One aggregation, then ``stack``."""
    from pyspark.sql.types import NumericType

    cols = df.columns
    numeric = set(numeric if numeric is not None else
                  [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    aggs = [F.count(F.lit(1)).alias("__n")]
    rows = []
    for i, c in enumerate(cols):
        aggs.append(F.count_if(is_missing(name_col(c), sentinels)).alias(f"__m{i}"))
        if c in numeric:
            x = safe_cast(name_col(c), "double")
            aggs += [F.count(x).alias(f"__c{i}"), F.avg(x).alias(f"__a{i}"), F.stddev_samp(x).alias(f"__s{i}"),
                     F.min(x).alias(f"__lo{i}"), F.max(x).alias(f"__hi{i}")]
            stats = f"__c{i}, __a{i}, __s{i}, __lo{i}, __hi{i}"
        else:
            stats = "CAST(NULL AS BIGINT), " + ", ".join(["CAST(NULL AS DOUBLE)"] * 4)
        rows.append(f"{i + 1}, {_q(c)}, __n, __m{i}, {stats}")
    wide = df.agg(*aggs)
    long = _unpivot(wide, len(cols), rows, "position, column_name, n_rows, n_missing, n, mean, stddev, min, max")
    return long.select(F.col("position").cast("int").alias("position"), "column_name", "n_rows", "n_missing",
                       pct("n_missing", "n_rows").alias("pct_missing"), "n", "mean", "stddev", "min", "max")
