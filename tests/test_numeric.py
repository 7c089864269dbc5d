import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dfinsight.operators.numeric import gram_matrix, integrate, matmul, matmul_tiled
from tests.conftest import SF01


def test_gram_matrix_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    x = np.vstack([np.asarray(r.embedding, dtype=np.float64) for r in emb.orderBy("vec_id").collect()])
    want = x.T @ x
    got = np.zeros_like(want)
    for r in gram_matrix(emb.repartition(5), "embedding").collect():
        got[r.i, r.j] = r.value
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


def test_matmul_matches_numpy_with_hot_inner_index(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 4, size=(12, 9)).astype(float)
    a[:, 3] = rng.integers(1, 5, size=12)  # inner index 3 is dense (hot)
    b = rng.integers(0, 4, size=(9, 7)).astype(float)
    b[3, :] = 2.0

    def coo(m):
        return spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))],
                                     "row int, col int, value double")
    got = np.zeros((12, 7))
    for r in matmul(coo(a), coo(b)).collect():
        got[r.row, r.col] = r.value
    assert np.array_equal(got, a @ b)


def test_tiled_product_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-3, 4, size=(70, 150)).astype(float) * (rng.random((70, 150)) < .05)
    a[:, 17] = rng.integers(1, 5, size=70)  # a hot inner index
    a[20:45, 30:60] = rng.normal(size=(25, 30))  # and dense tiles
    b = rng.normal(size=(150, 41)) * (rng.random((150, 41)) < .3)
    b[17] = 2.0

    def coo(m, shift):
        cells = [(int(i) + shift[0], int(j) + shift[1], float(m[i, j])) for i, j in zip(*np.nonzero(m))]
        half = cells[0]  # one cell in two parts
        cells = [(half[0], half[1], half[2] - 1.0), (half[0], half[1], 1.0), *cells[1:], (None, 1, 1.0), (1, None, 1.0), (1, 1, None)]
        return spark.createDataFrame(cells, "row long, col long, value double").repartition(3)

    for tile, spread in ((16, 3), (7, 1), (512, 2)):
        got = np.zeros((70, 41))
        rows = matmul_tiled(coo(a, (-20, 2**60)), coo(b, (2**60, 5)), tile, spread).collect()
        for r in rows:
            got[r.row + 20, r.col - 5] = r.value
        assert np.allclose(got, a @ b) and len(rows) == len({(r.row, r.col) for r in rows})
    assert matmul_tiled(coo(a, (0, 0)).filter("false"), coo(b, (0, 0))).count() == 0


def test_integrate_matches_pandas_with_hot_key(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    pdf = ev.toPandas().sort_values(["user_id", "ts", "event_id"])
    want = {}
    for k, g in pdf.groupby("user_id"):
        t = g["ts"].astype("int64").to_numpy() / 1e9 if g["ts"].dtype.kind == "M" else None
        t = (g["ts"] - pd.Timestamp("1970-01-01")).dt.total_seconds().to_numpy()
        v = g["value"].to_numpy()
        want[k] = float(np.sum(np.diff(t) * (v[1:] + v[:-1]) / 2.0))
    for n in (1, 4, 16):
        got = {r.user_id: r.integral for r in integrate(ev, "user_id", "ts", "value", "event_id", n).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert abs(got[k] - want[k]) <= 1e-6 * max(1.0, abs(want[k]))


def test_integral_across_partitions_batches_and_nulls(spark):
    rows = [("hot" if i % 3 else f"k{i % 200}", i * 1000, None if i % 11 == 0 else float(i % 7), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, v double, id long").withColumn("t", F.timestamp_micros("t"))
    want, last = {}, {}
    for k, t, v, _ in sorted(rows, key=lambda r: r[1]):
        n, area = want.get(k, (0, 0.0))
        p = last.get(k)
        want[k] = (n + 1, area + ((t - p[0]) / 1e6 * (v + p[1]) / 2 if p and v is not None and p[1] is not None else 0.0))
        last[k] = (t, v)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for n in (1, 7, 50):
            got = {r.k: (r.n_points, r.integral) for r in integrate(df, "k", "t", "v", "id", n_partitions=n).collect()}
            assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

def test_size_shuffles(spark):
    from dfinsight.session import size_shuffles
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * (256 << 20)) == 100
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_integrate_single_point_and_empty(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), 5.0),
                                (2, 2, dt.datetime(2024, 1, 1), 1.0), (3, 2, dt.datetime(2024, 1, 1, 0, 0, 10), 3.0)],
                               "id long, k long, ts timestamp_ntz, v double")
    got = {r.k: (r.n_points, r.integral) for r in integrate(df, "k", "ts", "v", "id").collect()}
    assert got == {1: (1, 0.0), 2: (2, 20.0)}
    assert integrate(df.limit(0), "k", "ts", "v", "id").count() == 0


def test_integrate_zoned_timestamps_across_dst(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, 1, dt.datetime(2024, 3, 31, 0, 0), 1.0), (2, 1, dt.datetime(2024, 3, 31, 4, 0), 1.0)],
                               "id long, k long, ts timestamp_ntz, v double")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))  # local 00:00 -> 04:00 is 3 real hours
        got_zoned = integrate(zoned, "k", "ts", "v", "id").first().integral
        got_ntz = integrate(df, "k", "ts", "v", "id").first().integral
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got_zoned == 3 * 3600.0 and got_ntz == 4 * 3600.0
