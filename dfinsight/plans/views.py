"""Derived input views over the driver tables.

Each view is one SQL text that Spark SQL and a SQL oracle (DuckDB) both run unchanged, so a query
and its oracle read the same rows. The views scale with the tables they are derived from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Movie-table stand-in over `orders`: dirty years, NULL / zero scores, NULL / empty / multi-label
# lists with a spaced and a trailing delimiter, NULL directors, NULL / '' / 'null' summaries.
TITLES_SQL = """
SELECT o_orderkey AS movie_id,
  concat('title-', CAST(o_orderkey AS STRING)) AS title,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'n/a'
       ELSE CAST(1880 + o_orderkey % 145 AS STRING) END AS year,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
       ELSE CAST((o_orderkey * 37) % 101 AS DOUBLE) / 10 END AS rating_score,
  (o_orderkey * 7919) % 200003 AS rating_count,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN ''
       ELSE concat('g', CAST(o_orderkey % 7 AS STRING), '/', substr(o_orderpriority, 3)) END AS genres,
  CASE o_orderkey % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'US/CN' WHEN 2 THEN 'JP / FR'
       WHEN 3 THEN '' WHEN 4 THEN 'CN/' ELSE NULL END AS countries,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL
       ELSE concat('d', CAST(o_orderkey % 1999 AS STRING)) END AS directors,
  (o_orderkey * 31) % 50021 AS collect_count,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null'
       ELSE concat('text ', o_orderstatus) END AS summary
FROM orders
"""

# The movie table with a geometric spread of labels: label r<j> is about exp(-1 / spread) times as
# frequent as the one before, so the first holds a third or more of the rows and the last a few.
LONG_TAIL_SQL = """
SELECT o_orderkey AS movie_id, CAST(1950 + o_orderkey % 70 AS STRING) AS year,
  CAST(10 + (o_orderkey * 37) % 91 AS DOUBLE) / 10 AS rating_score, (o_orderkey * 7919) % 200003 AS rating_count,
  concat('r', CAST(CAST(floor(-ln((((o_orderkey * 7919) % 1000003) + 1) / 1000004.0) * {spread}) AS INT) AS STRING),
         CASE WHEN o_orderkey % 5 = 0 THEN '/extra' ELSE '' END) AS countries
FROM orders
"""

# `events` with missing values in the three spellings (NULL, '' and 'null').
MESSY_EVENTS_SQL = """
SELECT event_id, ts, user_id,
  CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'null'
       WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  props
FROM events
"""

# `events` read as a task log: each event is one task of `value` seconds for query `event_type`,
# recorded under a worker count of 1, 2 or 4, in one of three repeats, on one worker.
TASK_LOG_SQL = """
SELECT query, n_workers, run, CAST(slot % n_workers AS INT) AS worker, secs
FROM (
  SELECT event_type AS query,
    CAST(CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS INT) AS n_workers,
    CAST(1 + event_id % 3 AS INT) AS run,
    CAST(event_id % 4 AS INT) AS slot,
    value AS secs
  FROM events
) t
"""


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES, register: bool = False) -> dict[str, DataFrame]:
    """Read the driver tables (one parquet each); optionally register them as temp views."""
    out = {}
    for name in names:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        if register:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def view(spark: SparkSession, sf_dir: str, sql: str, needs: tuple[str, ...]) -> DataFrame:
    """Run a derived-view SQL text over the driver tables, passed as DataFrame parameters
    (``FROM orders`` becomes ``FROM {orders}``), so no session view name is created or replaced."""
    text = re.sub(r"\bFROM (" + "|".join(needs) + r")\b", lambda m: "FROM {" + m.group(1) + "}", sql)
    return spark.sql(text, **load_tables(spark, sf_dir, needs))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TITLES_SQL, ("orders",))


def long_tail(spark: SparkSession, sf_dir: str, spread: float) -> DataFrame:
    return view(spark, sf_dir, LONG_TAIL_SQL.format(spread=spread), ("orders",))


def messy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, MESSY_EVENTS_SQL, ("events",))


def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TASK_LOG_SQL, ("events",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
