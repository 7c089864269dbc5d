from pyspark.sql import functions as F

from dfinsight.operators.cleaning import (Rule, Step, any_rule, cleaning_audit, fill_missing, keep_range)
from dfinsight.plans import movies
from dfinsight.plans.views import titles
from tests.conftest import SF01, plan_of


def test_titles_audit_matches_fixture(spark):
    audit = movies.clean_audit(titles(spark, SF01)).orderBy("step_no").collect()
    assert [(r.n_in, r.n_rule, r.n_null, r.n_out) for r in audit] == [
        (15000, 517, 0, 14483), (14483, 1404, 275, 12804), (12804, 1774, 0, 11030)]
    for r in audit:
        assert r.n_in == r.n_rule + r.n_null + r.n_out
    assert movies.clean_movies(titles(spark, SF01)).count() == 11030


def test_audit_is_one_pass(spark):
    plan = plan_of(movies.clean_audit(titles(spark, SF01)))
    assert plan.count("FileScan parquet") == 1


def test_audited_landing_is_one_job_with_the_same_counters(spark, tmp_path):
    raw = titles(spark, SF01)
    spark.sparkContext.setJobGroup("landing", "landing")
    audit = movies.land_clean_movies(raw, str(tmp_path / "clean"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("landing")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 1  # cleaning, audit and landing read the input together
    assert audit.columns == movies.clean_audit(raw).columns
    assert sorted(audit.collect()) == sorted(movies.clean_audit(raw).collect())
    landed, want = spark.read.parquet(str(tmp_path / "clean")), movies.clean_movies(raw)
    assert landed.dtypes == want.dtypes and landed.count() == 11030 and landed.exceptAll(want).count() == 0


def test_audited_landing_of_nothing(spark, tmp_path):
    none = titles(spark, SF01).filter("false")
    audit = movies.land_clean_movies(none, str(tmp_path / "clean")).collect()
    assert [(r.n_in, r.n_rule, r.n_null, r.n_out) for r in audit] == [(0, 0, 0, 0)] * 3
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 0


def test_fillna_parity_and_normalised(spark):
    df = spark.createDataFrame([(None,), ("",), ("null",), ("x",)], "s string")
    assert [r[0] for r in fill_missing(df, {"s": "-"}).collect()] == ["-", "", "null", "x"]
    assert [r[0] for r in fill_missing(df, {"s": "-"}, normalise_sentinels=True).collect()] == ["-", "-", "-", "x"]


def test_keep_range_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.5,), (1.0,), (9.0,)], "x double")
    assert sorted(r[0] for r in keep_range(df, "x", lo=1.0).collect()) == [1.0, 9.0]
    kept = keep_range(df, "x", lo=1.0, drop_nan=False).collect()
    assert len(kept) == 3  # NaN >= 1.0 is true in Spark


def test_any_rule_row_once(spark):
    df = spark.createDataFrame([("US/CN", 9.0, 200000), ("US", 8.0, 200000), ("CN", 8.2, 60000)],
                               "countries string, rating_score double, rating_count bigint")
    rules = [Rule("countries", "US", (("rating_score", 8.5), ("rating_count", 100000))),
             Rule("countries", "CN", (("rating_score", 8.0), ("rating_count", 50000)))]
    assert sorted(r.countries for r in any_rule(df, rules).collect()) == ["CN", "US/CN"]


def test_audit_zero_rows(spark):
    df = spark.createDataFrame([], "x double")
    out = cleaning_audit(df, [Step("x >= 1", F.col("x") >= 1)]).collect()
    assert [(r.n_in, r.n_rule, r.n_null, r.n_out) for r in out] == [(0, 0, 0, 0)]
