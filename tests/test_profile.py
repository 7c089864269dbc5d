from dfinsight.operators.profile import bucket_counts, label_counts, missing_profile, numeric_summary, row_count
from dfinsight.plans.views import messy_events
from tests.conftest import SF01, plan_of


def test_missing_profile_events(spark):
    prof = {r.column_name: r for r in missing_profile(messy_events(spark, SF01)).collect()}
    assert prof["event_type"].n_missing == 2104
    assert prof["value"].n_missing == 1429
    assert abs(prof["value"].pct_missing - 14.29) < 1e-9
    assert prof["event_id"].n_missing == 0


def test_missing_profile_single_scan(spark):
    assert plan_of(missing_profile(messy_events(spark, SF01))).count("FileScan parquet") == 1


def test_missing_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double")
    out = missing_profile(df).collect()
    assert [(r.n_missing, r.pct_missing) for r in out] == [(0, None), (0, None)]


def test_numeric_summary_one_row_stddev_null(spark):
    df = spark.createDataFrame([(3.0, 1)], "x double, y int")
    out = {r.column_name: r for r in numeric_summary(df, ["x", "y"]).collect()}
    assert out["x"].mean == 3.0 and out["x"].stddev is None and out["y"].max == 1.0


def test_label_counts_sum_to_exploded_rows(spark):
    df = spark.createDataFrame([("a/b",), ("a/",), ("",), (None,)], "s string")
    counts = {r.label: r.n for r in label_counts(df, "s").collect()}
    assert counts == {"a": 2, "b": 1, "": 2}
    top = label_counts(df, "s", k=2).collect()
    assert [(r.label, r.n) for r in top] == [("", 2), ("a", 2)]


def test_bucket_counts_and_row_count(spark):
    df = spark.createDataFrame([(1991.0,), (1999.0,), (2001.0,)], "y double")
    assert sorted((r.bucket_start, r.n) for r in bucket_counts(df, "y").collect()) == [(1990, 2), (2000, 1)]
    assert row_count(df).first().n_rows == 3


def test_profile_odd_names_and_text_numbers(spark):
    df = spark.createDataFrame([("1.5", None), ("abc", "x"), ("", "")], "`a.b` string, `c d` string")
    prof = {r.column_name: r.n_missing for r in missing_profile(df).collect()}
    assert prof == {"a.b": 1, "c d": 2}
    summ = numeric_summary(df, ["a.b"]).first()
    assert summ.n == 1 and summ.mean == 1.5


def test_profile_table_one_scan(spark):
    from dfinsight.operators.profile import profile_table
    ev = messy_events(spark, SF01)
    prof = profile_table(ev)
    assert plan_of(prof).count("FileScan parquet") == 1
    rows = {r.column_name: r for r in prof.collect()}
    assert rows["event_type"].n_missing == 2104 and rows["event_type"].mean is None
    assert rows["value"].n_missing == 1429 and rows["value"].n == 10000 - 1429
    assert all(r.n_rows == 10000 for r in rows.values())


def test_label_counts_switches_and_bucket_limit(spark):
    df = spark.createDataFrame([("a / b/",), (" a",), ("",)], "s string")
    plain = {r.label: r.n for r in label_counts(df, "s").collect()}
    assert plain == {"a ": 1, " b": 1, "": 2, " a": 1}
    tidy = {r.label: r.n for r in label_counts(df, "s", trim=True, drop_empty=True).collect()}
    assert tidy == {"a": 2, "b": 1}
    years = spark.createDataFrame([(1995.0,), (1981.0,), (2001.0,), (None,)], "y double")
    assert [(r.bucket_start, r.n) for r in bucket_counts(years, "y", 10, k=2).collect()] == [(None, 1), (1980, 1)]
