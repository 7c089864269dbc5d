import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from dfinsight.plans import catalog
from dfinsight.plans.views import TABLES
from tests.conftest import SF001

# Queries without a SQL twin: sampled range bounds.
ROWS_ONLY = {"sorted_ranges_orders"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "movie_count", "avg_rating", "avg_rating_count"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == ROWS_ONLY
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = catalog.queries()[name](spark, SF001)
    res = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    order = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [res.columns.index(c) for c in order]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
