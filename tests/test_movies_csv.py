"""The cleaning and analysis path end to end on a dirty movie CSV (the original input format)."""

import os
import tempfile

from pyspark.sql import functions as F

from dfinsight.plans import movies
from dfinsight.sources.io import read_csv

HEADER = "movie_id,title,original_title,year,rating_score,rating_count,genres,countries,directors,collect_count,summary"
LINES = [
    '1,"Big, ""Quoted"" Film",Été,1994,9.1,"200000",剧情/犯罪,美国,d1,1000,"line one\nline two"',
    "2,Two,Two,abc,8.0,8.0,剧情/,中国大陆/美国,d1,,null",
    "3,Three,Three,,7.5,100,,,d2,5,",
    "4,Four,Four,1890,8.2,60000,喜剧 / 剧情,中国大陆,,7,text",
    "5,Five,Five,2001,0,10,喜剧,日本,d1,3,text",
    "6,Six,Six,2003,,10,喜剧,日本,d1,3,text",
    "7,Seven,Seven,2010.0,8.4,70000,剧情,中国大陆,d1,9,text",
]
SCHEMA = ("movie_id bigint, title string, original_title string, year string, rating_score double, "
          "rating_count string, genres string, countries string, directors string, collect_count string, "
          "summary string")


def _path():
    d = tempfile.mkdtemp(prefix="dfinsight-movies-")
    p = os.path.join(d, "movies.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("﻿" + HEADER + "\n" + "\n".join(LINES) + "\n")
    return p


def test_clean_and_audit_from_csv(spark):
    raw = read_csv(spark, _path(), schema=SCHEMA)
    assert raw.count() == 7 and raw.columns[0] == "movie_id"
    audit = [(r.step, r.n_rule, r.n_null, r.n_out) for r in movies.clean_audit(raw).orderBy("step_no").collect()]
    assert audit == [("year present", 2, 0, 5), ("rating_score >= 1", 1, 1, 3), ("year >= 1900", 1, 0, 2)]
    clean = {r.movie_id: r for r in movies.clean_movies(raw).collect()}
    assert sorted(clean) == [1, 7]
    assert clean[1].rating_count == 200000 and clean[1].summary == "line one\nline two"
    assert clean[7].year == 2010.0


def test_analysis_queries_from_csv(spark):
    base = movies.analysis_base(read_csv(spark, _path(), schema=SCHEMA).withColumn(
        "rating_count", F.col("rating_count").try_cast("double").try_cast("bigint")))
    assert sorted(r.movie_id for r in base.collect()) == [1, 7]  # 'abc' and 1890 years fall out
    q1 = {r.country: r.movie_count for r in movies.country_report(base, min_count=1).collect()}
    assert q1 == {"美国": 1, "中国大陆": 1}
    q5 = [r.title for r in movies.two_region_high(base, rules=(("美国", 8.5, 100000), ("中国大陆", 8.0, 50000))).collect()]
    assert q5 == ['Big, "Quoted" Film', "Seven"]
    q4 = movies.top_per_genre(base).collect()
    assert sorted((r.genre, r.rank_in_genre, r.title) for r in q4) == [
        ("剧情", 1, 'Big, "Quoted" Film'), ("剧情", 2, "Seven"), ("犯罪", 1, 'Big, "Quoted" Film')]
