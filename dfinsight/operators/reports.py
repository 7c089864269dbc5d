"""Grouped reports, trends and deterministic top-k.

Aggregations are single ``groupBy().agg()`` calls, so Catalyst plans a partial (map-side)
aggregate before the shuffle: a label holding a third of all rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col_, ntz_micros_of_day, round_long, round_to


def _mean(c: ColumnOrName, places: int | None) -> Column:
    a = F.avg(col_(c))
    if places is None:
        return a
    return round_long(a) if places == 0 else round_to(a, places)


def measures(count_name: str | None = "n", means: dict[str, tuple[str, int | None]] | None = None,
             count_col: str | None = None) -> list[Column]:
    """Aggregate list for a report.

    ``count_name``: ``count(*)`` (or ``count(count_col)``, non-NULL values only, D11).
    ``means``: ``{alias: (column, places)}``; places 0 gives a rounded bigint, ``None`` the raw mean.
    """
    out = []
    if count_name:
        out.append((F.count(F.col(count_col)) if count_col else F.count(F.lit(1))).alias(count_name))
    for alias, (c, places) in (means or {}).items():
        out.append(_mean(c, places).alias(alias))
    return out


def top_k(df: DataFrame, order: list[Column], k: int, tiebreak: list[str] | None = None) -> DataFrame:
    """O1-O3: total-order sort then limit; planned as ``TakeOrderedAndProject`` (no global sort).

    ``tiebreak`` columns are appended ascending so equal sort keys never make the result random.
    """
    order = list(order) + [F.col(t).asc_nulls_first() for t in (tiebreak or [])]
    return df.orderBy(*order).limit(k)


def group_report(df: DataFrame, key: str | list[str], count_name: str = "n",
                 means: dict[str, tuple[str, int | None]] | None = None, count_col: str | None = None,
                 min_count: int | None = None, order: list[Column] | None = None,
                 k: int | None = None) -> DataFrame:
    """Grouped measures, HAVING ``count >= min_count``, optional ordered top-k.

    The group key is always the last sort column, so the top-k is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    res = df.groupBy(*keys).agg(*measures(count_name, means, count_col))
    if min_count is not None:
        res = res.filter(F.col(count_name) >= F.lit(min_count))
    if k is None:
        return res.orderBy(*order) if order else res
    return top_k(res, order or [F.col(count_name).desc()], k, tiebreak=keys)


def trend(df: DataFrame, bucket_col: Column, bucket_name: str, count_name: str = "n",
          means: dict[str, tuple[str, int | None]] | None = None, delta: str | None = None) -> DataFrame:
    """Measures per bucket (e.g. decade), ascending. ``delta`` adds W3, the change in the count
    against the previous bucket (``lag`` over the aggregated rows: one row per bucket, so the
    unpartitioned window holds few rows)."""
    res = df.groupBy(bucket_col.alias(bucket_name)).agg(*measures(count_name, means))
    if delta:
        w = Window.orderBy(F.col(bucket_name).asc_nulls_first())
        res = res.withColumn(delta, F.col(count_name) - F.lag(count_name).over(w))
    return res.orderBy(F.col(bucket_name).asc_nulls_first())


_DATE_UNITS = {"year", "quarter", "month", "week"}
_MICROS = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}


def time_bucket(ts: ColumnOrName, unit: str) -> Column:
    """D9 bucket start as timestamp_ntz, computed without the session time zone.

    ``year`` / ``quarter`` / ``month`` / ``week`` truncate the calendar date, ``day`` is the date,
    ``hour`` / ``minute`` / ``second`` round the wall clock down in microseconds; ``decade`` gives
    an int year. (``date_trunc`` on timestamp_ntz would detour through the session zone.)
    """
    ts = col_(ts)
    if unit == "decade":
        return (F.floor(F.year(ts) / F.lit(10)) * F.lit(10)).cast("int")
    day = ts.cast("date")
    if unit == "day":
        return day.cast("timestamp_ntz")
    if unit in _DATE_UNITS:
        return F.trunc(day, unit).cast("timestamp_ntz")
    step = _MICROS[unit]
    since_midnight = ntz_micros_of_day(ts)
    return F.timestamp_add("MICROSECOND", since_midnight - F.pmod(since_midnight, F.lit(step)),
                           day.cast("timestamp_ntz"))


def trend_by_time(df: DataFrame, ts: str, unit: str = "year", count_name: str = "n",
                  means: dict[str, tuple[str, int | None]] | None = None,
                  delta: str | None = None) -> DataFrame:
    """D9 (+W3): trend by calendar unit on a real timestamp column; output column ``period``, ascending.
    ``delta`` only for units of a day and more, whose number of buckets the calendar bounds."""
    if delta and unit in _MICROS:
        raise ValueError(f"delta needs a bounded number of buckets, not one per {unit}")
    return trend(df, time_bucket(ts, unit), "period", count_name, means, delta)


def leaderboard(df: DataFrame, key: str, score: str, weight: str | None = None, min_count: int = 3,
                k: int = 20, places: int = 2) -> DataFrame:
    """Groups with at least ``min_count`` rows, ranked by the rounded mean ``score`` then the
    count (then the key), top ``k``; ``weight`` adds its rounded (bigint) mean.
    Output (key, n, avg_<score>[, avg_<weight>])."""
    means = {f"avg_{score}": (score, places)}
    if weight:
        means[f"avg_{weight}"] = (weight, 0)
    return group_report(df, key, "n", means, min_count=min_count,
                        order=[F.col(f"avg_{score}").desc(), F.col("n").desc()], k=k)
