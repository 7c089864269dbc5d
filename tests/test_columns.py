import math

from pyspark.sql import functions as F

from dfinsight.functions.columns import (bucket, is_missing, round_long, round_to, safe_cast, split_labels,
                                         standardise, words)


def test_is_missing_sentinels(spark):
    df = spark.createDataFrame([(None,), ("",), ("null",), ("NULL",), (" ",), ("x",)], "v string")
    got = [r[0] for r in df.select(is_missing("v")).collect()]
    assert got == [True, True, True, False, False, False]


def test_is_missing_on_numbers_does_not_throw(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(is_missing("v")).collect()] == [False, True]


def test_split_labels_parity(spark):
    df = spark.createDataFrame([("a/b/",), ("",), (None,), ("JP / FR",)], "s string")
    got = [r[0] for r in df.select(split_labels("s")).collect()]
    assert got == [["a", "b", ""], [""], None, ["JP ", " FR"]]
    trimmed = [r[0] for r in df.select(split_labels("s", trim=True, drop_empty=True)).collect()]
    assert trimmed == [["a", "b"], [], None, ["JP", "FR"]]


def test_split_labels_delimiter_is_literal(spark):
    df = spark.createDataFrame([("a.b|c",)], "s string")
    assert df.select(split_labels("s", ".")).first()[0] == ["a", "b|c"]
    assert df.select(split_labels("s", "|")).first()[0] == ["a.b", "c"]


def test_safe_cast_ansi(spark):
    df = spark.createDataFrame([("8.0",), ("8.9",), ("abc",), (None,)], "s string")
    got = df.select(safe_cast("s", "bigint").alias("l"), safe_cast("s", "float").alias("f")).collect()
    assert [r.l for r in got] == [8, 8, None, None]
    assert got[2].f is None


def test_round_half_up_through_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (4.225,), (-2.5,)], "x double")
    got = df.select(round_to("x", 2).alias("r"), round_long("x").alias("l")).collect()
    assert [r.r for r in got] == [1.01, 2.5, 4.23, -2.5]
    assert [r.l for r in got] == [1, 3, 4, -3]


def test_bucket(spark):
    df = spark.createDataFrame([(1999.0,), (2000.0,), (1880.5,), (None,)], "y double")
    assert [r[0] for r in df.select(bucket("y", 10)).collect()] == [1990, 2000, 1880, None]


def test_words_match_python_split(spark):
    lines = ["hello spark", "  lead and trail  ", "tab\there", "nbsp x", "ideo　y", "",
             "sep\x1cx", "nl\nx", "a b"]
    df = spark.createDataFrame([(s,) for s in lines], "t string")
    got = [r[0] for r in df.select(words("t")).collect()]
    assert got == [s.split() for s in lines]


def test_words_equal_python_on_documents(spark):
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.w for r in docs.select("doc_id", words("text").alias("w")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == r.text.split()


def test_standardise(spark):
    df = spark.createDataFrame([([0.1307, 0.4388],)], "a array<float>")
    out = df.select(standardise("a")).first()[0]
    assert abs(out[0]) < 1e-6 and abs(out[1] - 1.0) < 1e-6
    assert all(not math.isnan(x) for x in out)


def test_ntz_instant_round_trip_in_dst_gap(spark):
    import datetime as dt

    from dfinsight.functions.columns import instant_to_ntz, ntz_to_instant, seconds_between
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 0, 0), dt.datetime(2024, 3, 31, 2, 30, 15, 250))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        r = df.select(instant_to_ntz(ntz_to_instant("b")).alias("back"),
                      F.unix_micros(ntz_to_instant("a")).alias("us"),
                      seconds_between("a", "b").alias("secs")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.back == dt.datetime(2024, 3, 31, 2, 30, 15, 250)
    assert r.us == int(dt.datetime(2024, 3, 31, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert r.secs == 9015.00025


def test_integers_keep_all_digits_and_dates_have_ranges(spark):
    import datetime as dt

    from dfinsight.functions.columns import retype, round_to
    from dfinsight.operators.cleaning import keep_range
    df = spark.createDataFrame([("9007199254740993", 9007199254740993, dt.date(2020, 1, 2), 1e31), ("8.9", -5, dt.date(2021, 1, 2), 0.125), ("x", None, None, None)],
                               "a string, b long, d date, x double")
    got = retype(df, {"a": "bigint", "b": "bigint"}).collect()
    assert [(r.a, r.b) for r in got] == [(9007199254740993, 9007199254740993), (8, -5), (None, None)]
    assert keep_range(df, "d", lo=dt.date(2020, 6, 1)).count() == 1
    stamped = df.withColumn("t", F.col("d").cast("timestamp_ntz"))
    assert keep_range(stamped, "t", hi=dt.datetime(2020, 6, 1)).count() == 1
    assert [r.y for r in df.select(round_to("x", 2).alias("y")).collect()] == [1e31, 0.13, None]
