"""Column expressions (P1-P14, C1): all built-in Spark SQL functions, no Python on executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values shared with the reference's semantics.
# Missing-value sentinels: NULL, or the text forms below (case-sensitive, no trim).
MISSING_SENTINELS = ("", "null")
# Whitespace as Python's str.split() sees it: Java's Unicode \s plus the four separators 0x1c-0x1f.
WORD_SPLIT_REGEX = r"(?U)[\s\x1c-\x1f]+"
# Image normalisation constants of the training script (mean, standard deviation).
PIXEL_MEAN = 0.1307
PIXEL_STD = 0.3081

_INTEGRAL = {"byte", "tinyint", "short", "smallint", "int", "integer", "long", "bigint"}


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_col(name: str) -> Column:
    """A column by its exact name (dots, spaces and backticks taken literally)."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_cast(c: ColumnOrName, to: str) -> Column:
    """ANSI-safe cast: unparsable text gives NULL instead of failing the job.

    To an integral type the direct cast comes first, so every integer keeps all its digits; only what
    it cannot read goes through double, so that the text '8.0' becomes 8 (truncating '8.9' to 8).
    """
    c = col_(c)
    if to.lower() in _INTEGRAL:
        return F.coalesce(c.try_cast(to), c.try_cast("double").try_cast(to))
    return c.try_cast(to)


def retype(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Retype columns in place, e.g. ``{"year": "float", "rating_count": "bigint"}``."""
    return df.withColumns({name: safe_cast(name, to) for name, to in types.items()})


def is_missing(c: ColumnOrName, sentinels: tuple[str, ...] = MISSING_SENTINELS) -> Column:
    """C1 + P13: NULL, or the text form equal to one of ``sentinels`` (compared as string)."""
    c = col_(c)
    if not sentinels:
        return c.isNull()
    return c.isNull() | c.cast("string").isin(*sentinels)


def _literal_regex(sep: str) -> str:
    # split() takes a Java regex; quote the delimiter so '.', '|' etc. are literal.
    return sep if sep == "" else "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_labels(c: ColumnOrName, sep: str = "/", trim: bool = False, drop_empty: bool = False,
                 dedupe: bool = False) -> Column:
    """P5: delimited text to array<string>.

    Default is plain ``split``: no trim, empty tokens kept ('a/b/' -> [a, b, '']), NULL stays NULL.
    """
    arr = F.split(col_(c), _literal_regex(sep))
    if trim:
        arr = F.transform(arr, lambda x: F.trim(x))
    if drop_empty:
        arr = F.filter(arr, lambda x: x != F.lit(""))
    if dedupe:
        arr = F.array_distinct(arr)
    return arr


def explode_labels(df: DataFrame, src: str, out: str, sep: str = "/", trim: bool = False,
                   drop_empty: bool = False, dedupe: bool = False) -> DataFrame:
    """One row per label, other columns kept. Rows whose list is NULL vanish (explode)."""
    return df.withColumn(out, F.explode(split_labels(src, sep, trim, drop_empty, dedupe)))


def bucket(c: ColumnOrName, width: int | float = 10) -> Column:
    """Lower edge of the bucket, ``floor(x / width) * width`` (bigint for integral widths)."""
    return F.floor(col_(c) / F.lit(width)) * F.lit(width)


def round_to(c: ColumnOrName, places: int) -> Column:
    """Half-up rounding through a decimal, so that both Spark and a SQL oracle agree on ties.

    The value is first fixed to 8 places (decimal(38,8)) and then rounded to ``places``, so a value
    within half a unit of the eighth place below a tie rounds up. Values of 1e30 and above, where
    no place after the point is left in a double, come back as they are.
    """
    c = col_(c)
    return F.coalesce(F.round(c.try_cast("decimal(38,8)"), places).cast("double"), c.cast("double"))


def round_long(c: ColumnOrName) -> Column:
    """Round to 0 places, then bigint (Spark's bare cast would truncate); NULL beyond a bigint."""
    return F.round(col_(c).try_cast("decimal(38,8)"), 0).try_cast("bigint")


def contains(c: ColumnOrName, text: str) -> Column:
    """P10: substring test."""
    return col_(c).contains(text)


def pct(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part * 100 / whole`` in double; NULL for a zero whole instead of an error."""
    return F.try_divide(col_(part).cast("double") * F.lit(100.0), col_(whole).cast("double"))


def words(c: ColumnOrName) -> Column:
    """Whitespace tokens of a line as Python's ``str.split()`` gives them (no empty tokens)."""
    return F.filter(F.split(col_(c), WORD_SPLIT_REGEX), lambda w: w != F.lit(""))


def standardise(c: ColumnOrName, mean: float = PIXEL_MEAN, std: float = PIXEL_STD) -> Column:
    """Element-wise ``(x - mean) / std`` of an array, evaluated in the JVM."""
    return F.transform(col_(c), lambda x: (x.cast("double") - F.lit(mean)) / F.lit(std))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_micros_of_day(c: ColumnOrName) -> Column:
    """Microseconds since midnight of a timestamp_ntz, from its wall-clock fields (zone-free;
    ``timestamp_diff`` on timestamp_ntz would go through the session zone)."""
    c = col_(c)
    secs = F.date_part(F.lit("SECOND"), c)  # seconds with the microsecond fraction, decimal(8,6)
    return (F.hour(c).cast("long") * F.lit(3_600_000_000) + F.minute(c).cast("long") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("long"))


def ntz_micros(c: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz wall clock (zone-free)."""
    c = col_(c)
    return F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000) + ntz_micros_of_day(c)


def ntz_to_instant(c: ColumnOrName) -> Column:
    """timestamp_ntz wall clock -> timestamp at the same UTC instant, whatever the session zone.

    Structured Streaming watermarks need the ``timestamp`` type; going through microseconds keeps
    day and hour windows aligned with the wall clock.
    """
    return F.timestamp_micros(ntz_micros(c))


def instant_to_ntz(c: ColumnOrName) -> Column:
    """Inverse of :func:`ntz_to_instant` (``timestamp_add`` on timestamp_ntz is zone-free)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_(c)), _epoch_ntz())


def seconds_between(start: ColumnOrName, end: ColumnOrName, ntz: bool = True) -> Column:
    """Elapsed seconds (double) between two timestamps; exact to the microsecond.

    ``ntz=True``: timestamp_ntz wall clocks (zone-free); ``ntz=False``: zoned timestamps (instants).
    """
    micros = ntz_micros if ntz else (lambda c: F.unix_micros(col_(c)))
    return (micros(end) - micros(start)).cast("double") / F.lit(1e6)
