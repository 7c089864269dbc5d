"""T4 gaps filled and M2 per window, against plain loops, over ranges that cut nodes apart."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from dfinsight.operators.numeric import integrate, integrate_windows
from dfinsight.operators.series import fill_gaps

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hourly():
    """One node holds most rows; NULL values, gaps, a NULL node, a node of one row."""
    rnd = random.Random(3)
    rows = [("hot", T0 + dt.timedelta(hours=h), rnd.choice([None, 1.0, 2.5]), h) for h in range(400) if rnd.random() < .6]
    rows += [("nulls", T0 + dt.timedelta(hours=h), None, h) for h in range(0, 90, 7)] + [("one", T0, 4.0, 0)]
    rows += [(None, T0 + dt.timedelta(hours=h), float(h), h) for h in (3, 4, 9)] + [("zz", T0, None, 0), ("zz", T0 + dt.timedelta(hours=5), 7.0, 1), ("zz", None, 1.0, 1)]
    return rows


def plain_fill(rows):
    out = []
    for node in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == node and r[1] is not None}
        at, known = min(own), None
        while at <= max(own):
            r = own.get(at)
            known = r[2] if r and r[2] is not None else known
            out.append((node, at, known, r[3] if r else None, r is None))
            at += dt.timedelta(hours=1)
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 5, 40])
def test_gaps_are_filled_across_ranges(spark, hourly, n):
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(hourly, f"node string, start {kind}, v double, n int").repartition(3)
        got = fill_gaps(df, "node", "start", "v", 3600, n_partitions=n)
        assert got.columns == ["node", "start", "v", "n", "is_filled"]
        rows = [tuple(x.replace(tzinfo=None) if isinstance(x, dt.datetime) else x for x in r) for r in got.collect()]
        assert sorted(rows, key=repr) == plain_fill(hourly)
    assert fill_gaps(df.filter("false"), "node", "start", "v", 3600).count() == 0


@pytest.mark.parametrize("n", [1, 7])
def test_windows_add_up_to_the_integral(spark, n):
    rnd = random.Random(5)
    rows = [(rnd.choice("aaab"), T0 + dt.timedelta(seconds=rnd.choice([rnd.randint(0, 900_000), 86_400 * rnd.randint(0, 9)])), i, rnd.choice([None, *[rnd.uniform(-5, 5)] * 9]))
            for i in range(300)] + [("c", T0, 1, 2.0), ("c", T0 + dt.timedelta(days=4), 2, 4.0), ("d", None, 3, 1.0), ("e", T0, 4, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i int, v double")
    got = integrate_windows(df, "k", "ts", "v", "i", 86_400, n_partitions=n).collect()
    whole = {r.k: r for r in integrate(df.filter("ts is not null"), "k", "ts", "v", "i").collect()}
    for k in "abce":
        own = [r for r in got if r.k == k]
        assert len({r.window_no for r in own}) == len(own)
        assert sum(r.integral for r in own) == pytest.approx(whole[k].integral) and sum(r.n_points for r in own) == whole[k].n_points
    line = sorted((r.window_no, r.n_points, r.integral) for r in got if r.k == "c")  # straight from 2 to 4 over four whole days
    assert [x[1] for x in line] == [1, 0, 0, 0, 1] and [x[2] for x in line] == pytest.approx([86_400 * m for m in (2.25, 2.75, 3.25, 3.75, 0)])
    assert not [r for r in got if r.k == "d"]
