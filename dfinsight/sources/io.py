"""Sources and sinks (SRC1-SRC6, SNK1-SNK3).

Paths go through Hadoop's file systems, so local paths, HDFS and object stores (``s3a://``) all
work when the cluster has the connector; nothing here reads a file on the driver.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.columns import name_col

BOM = "\ufeff"
# Null marker used when landing CSV, so that NULL and the empty text survive a round trip.
CSV_NULL = "\\N"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multiline: bool = True, header: bool = True, encoding: str = "UTF-8",
             null_value: str | None = None) -> DataFrame:
    """SRC1: CSV with header, quote and escape ``"``, quoted newlines (``multiLine``).

    With ``schema`` there is no inference pass; without one, types are inferred (one extra scan).
    A multi-line file is one task here; :func:`~dfinsight.sources.split_csv.read_csv_split` spreads it.
    """
    reader = (spark.read.option("header", str(header).lower()).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", str(multiline).lower()))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return strip_bom(reader.csv(path))


def strip_bom(df: DataFrame) -> DataFrame:
    """SRC2: drop a leading U+FEFF from the first column name (a no-op when the reader already did)."""
    first = df.columns[0] if df.columns else None
    if first and first.startswith(BOM):
        return df.withColumnRenamed(first, first.lstrip(BOM))
    return df


def lines_from(spark: SparkSession, lines: list[str]) -> DataFrame:
    """SRC4: literal lines as a one-column (``value``) table, e.g. a fallback sample."""
    return spark.createDataFrame([(line,) for line in lines], "value string")


def read_lines(spark: SparkSession, path: str, fallback: list[str] | None = None) -> DataFrame:
    """SRC3: one row per line (column ``value``). The path is resolved at once. Only where ``fallback``
    is given and the path does not exist are those lines taken, with a warning; any other error is
    raised, and so is a missing path without a fallback."""
    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if fallback is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"{path} does not exist; {len(fallback)} fallback lines are read instead", stacklevel=2)
        return lines_from(spark, fallback)


def land_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> str:
    """SRC6: write columnar output (splittable, pruned and pushed-down on read)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def land_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = CSV_NULL) -> str:
    """Write CSV readable by :func:`read_csv` (header, ``"`` quote/escape, explicit NULL marker)."""
    (df.write.mode(mode).option("header", "true").option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("nullValue", null_value).option("emptyValue", '""').csv(path))
    return path


def schema_report(df: DataFrame) -> DataFrame:
    """SNK1: (position, column_name, data_type, nullable) from the schema (metadata, no scan)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")


def preview(df: DataFrame, n: int = 5, width: int = 50, order_by: list[str | Column] | None = None) -> DataFrame:
    """SNK2: first ``n`` rows by ``order_by`` (bare ``show`` is unordered), text cut to ``width``."""
    cut = [F.substring(name_col(f.name), 1, width).alias(f.name) if isinstance(f.dataType, StringType)
           else name_col(f.name) for f in df.schema.fields]
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(n).select(*cut)


def register(df: DataFrame, name: str) -> DataFrame:
    """SNK3: a temp view queryable with ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return df
