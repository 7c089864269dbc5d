"""Property tests (few examples each: every example runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dfinsight.operators.cleaning import Step, apply_steps, cleaning_audit
from dfinsight.operators.profile import label_counts
from dfinsight.operators.ranking import global_sequence, running_count
from tests.conftest import rows

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

events = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, None]), st.one_of(st.none(), st.integers(0, 50))),
                  min_size=1, max_size=60)


@SETTINGS
@given(data=events, n=st.integers(1, 7))
def test_running_count_equals_window(spark, data, n):
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(data)], "id long, k long, t long")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(df.withColumn("running_count", F.count(F.lit(1)).over(w)), "id", "running_count")
    assert rows(running_count(df, "k", "t", "id", n_partitions=n), "id", "running_count") == want


@SETTINGS
@given(data=events, n=st.integers(1, 7))
def test_global_sequence_is_row_number(spark, data, n):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(data)], "id long, t long")
    got = rows(global_sequence(df, ["t", "id"], n_partitions=n), "id", "seq")
    want = rows(df.withColumn("seq", F.row_number().over(Window.orderBy("t", "id"))), "id", "seq")
    assert got == want


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.just(float("nan")), st.floats(-5, 5)), min_size=0, max_size=40))
def test_audit_adds_up(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    steps = [Step("x not null", F.col("x").isNotNull()), Step("x >= 0", F.col("x") >= 0),
             Step("x < 3", F.col("x") < 3)]
    audit = cleaning_audit(df, steps).orderBy("step_no").collect()
    assert audit[0].n_in == len(vals)
    for a, b in zip(audit, audit[1:]):
        assert b.n_in == a.n_out
    for r in audit:
        assert r.n_in == r.n_rule + r.n_null + r.n_out
    assert audit[-1].n_out == apply_steps(df, steps).count()


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="ab/ ", max_size=8)), max_size=20))
def test_label_counts_sum_to_exploded_rows(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    total = sum(r.n for r in label_counts(df, "s").collect())
    assert total == sum(len(t.split("/")) for t in texts if t is not None)
