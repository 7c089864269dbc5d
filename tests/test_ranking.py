from pyspark.sql import Window
from pyspark.sql import functions as F

from dfinsight.operators.ranking import global_sequence, running_count, sorted_ranges
from tests.conftest import SF01, rows


def _hot_events(spark):
    # a third of all rows on one key, the rest spread
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "ts")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))


def test_running_count_matches_window_with_hot_key(spark):
    ev = _hot_events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(ev.withColumn("running_count", F.count(F.lit(1)).over(w)), "event_id", "running_count")
    for n in (1, 4, 32):
        got = rows(running_count(ev, "user_id", "ts", "event_id", n_partitions=n), "event_id", "running_count")
        assert got == want


def test_global_sequence_is_a_stable_permutation(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "value")
    want = rows(ev.withColumn("seq", F.row_number().over(Window.orderBy("value", "event_id"))), "event_id", "seq")
    for n in (1, 4, 32):
        got = rows(global_sequence(ev, ["value", "event_id"], n_partitions=n), "event_id", "seq")
        assert got == want
    assert sorted(s for _, s in want) == list(range(1, len(want) + 1))


def test_sorted_ranges_ascend(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    proof = sorted_ranges(o, "o_totalprice", 6, unique="o_orderkey").orderBy("partition").collect()
    assert sum(r.n_rows for r in proof) == o.count()
    for a, b in zip(proof, proof[1:]):
        assert a.max_key <= b.min_key


def test_sort_in_ranges_is_globally_sorted(spark):
    from dfinsight.operators.ranking import sort_in_ranges
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_totalprice", "o_orderkey")
    parts = sort_in_ranges(o, ["o_totalprice", "o_orderkey"], 5).rdd.glom().collect()
    flat = [(r.o_totalprice, r.o_orderkey) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == o.count()


def test_running_count_with_more_keys_than_partitions_and_a_hot_key(spark):
    rows = [(None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"k{i % 997}"), i // 2, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, t long, id long").repartition(6)
    seen, want = {}, {}
    for k, _, i in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = seen[k] = seen.get(k, 0) + 1
    for n in (1, 5, 40):
        got = {r.id: r.running_count for r in running_count(df, "k", "t", "id", n_partitions=n).collect()}
        assert got == want
