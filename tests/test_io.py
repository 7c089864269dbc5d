import os
import tempfile

from dfinsight.sources.io import (CSV_NULL, land_csv, land_parquet, preview, read_csv, register, schema_report,
                                  strip_bom)

SCHEMA = "movie_id bigint, title string, summary string"


def _csv(text):
    d = tempfile.mkdtemp(prefix="dfinsight-csv-")
    p = os.path.join(d, "m.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_read_csv_quotes_newlines_bom(spark):
    p = _csv('﻿movie_id,title,summary\n1,"A ""quoted"", title","line one\nline two"\n2,B,\n')
    df = read_csv(spark, p, schema=SCHEMA)
    got = df.orderBy("movie_id").collect()
    assert df.columns == ["movie_id", "title", "summary"]
    assert got[0].title == 'A "quoted", title' and got[0].summary == "line one\nline two"
    assert got[1].summary is None


def test_read_csv_inferred_strips_bom(spark):
    p = _csv('﻿movie_id,title\n1,x\n')
    df = strip_bom(read_csv(spark, p))
    assert df.columns[0] == "movie_id"


def test_csv_round_trip_keeps_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, ""), (2, "null", "x")], SCHEMA)
    d = tempfile.mkdtemp(prefix="dfinsight-rt-")
    land_csv(df, f"{d}/csv")
    back = read_csv(spark, f"{d}/csv", schema=SCHEMA, null_value=CSV_NULL).orderBy("movie_id").collect()
    assert [tuple(r) for r in back] == [(1, None, ""), (2, "null", "x")]
    land_parquet(df, f"{d}/pq", partition_by=["movie_id"])
    assert spark.read.parquet(f"{d}/pq").count() == 2


def test_schema_report_and_preview(spark):
    df = spark.createDataFrame([(2, "b" * 80), (1, "a")], "k int, s string")
    rep = [tuple(r) for r in schema_report(df).collect()]
    assert rep == [(1, "k", "int", True), (2, "s", "string", True)]
    pv = preview(df, 5, 50, order_by=["k"]).collect()
    assert [r.k for r in pv] == [1, 2] and len(pv[1].s) == 50
    register(df, "t_preview")
    assert spark.sql("SELECT count(*) FROM t_preview").first()[0] == 2


def test_preview_and_drop_missing_with_dotted_names(spark):
    from dfinsight.operators.cleaning import drop_missing
    df = spark.createDataFrame([(1, "x" * 60), (2, None)], "`a.b` int, `c.d` string")
    assert [r[0] for r in preview(df, 5, 50, order_by=["`a.b`"]).collect()] == [1, 2]
    assert drop_missing(df, ["c.d"]).count() == 1
