import pytest

from dfinsight.operators.scaling import amdahl_curve, run_times, scaling_report

# Fixed timing rows (query, n_workers, run, worker, secs).
RUNS = (
    [("q1", 1, r, 0, 8.0) for r in (1, 2, 3)]
    + [("q1", 2, 1, 0, 4.0), ("q1", 2, 1, 1, 5.0), ("q1", 2, 2, 0, 5.0), ("q1", 2, 2, 1, 4.0),
       ("q1", 2, 3, 0, 5.0), ("q1", 2, 3, 1, 5.0)]
    + [("q1", 4, r, w, s) for r in (1, 2, 3) for w, s in enumerate((2.0, 4.0, 3.0, 2.0))]
    + [("q2", 1, 1, 0, 4.0), ("q2", 2, 1, 0, 8.0), ("q3", 1, 1, 0, 4.0), ("q3", 2, 1, 0, 0.0),
       ("q4", 1, 1, 0, 8.0), ("q4", 2, 1, 0, 4.0)]
)


@pytest.fixture()
def runs(spark):
    return spark.createDataFrame(RUNS, "query string, n_workers int, run int, worker int, secs double")


def test_run_times_slowest_worker(runs):
    t = {(r.query, r.n_workers): r.secs for r in run_times(runs).collect()}
    assert t[("q1", 1)] == 8.0 and t[("q1", 2)] == 5.0 and t[("q1", 4)] == 4.0


def test_scaling_report_formulas(runs):
    rep = {(r.query, r.n_workers): r for r in scaling_report(runs).collect()}
    assert rep[("q1", 2)].speedup == pytest.approx(1.6) and rep[("q1", 2)].f == pytest.approx(0.75)
    assert rep[("q1", 4)].speedup == pytest.approx(2.0) and rep[("q1", 4)].f == pytest.approx(2 / 3)
    assert rep[("q2", 2)].speedup == pytest.approx(0.5)
    assert rep[("q2", 2)].f_raw == pytest.approx(-2.0) and rep[("q2", 2)].f == pytest.approx(0.1)
    assert rep[("q3", 2)].speedup == 0.0 and rep[("q3", 2)].f == pytest.approx(0.1)
    assert rep[("q4", 2)].f_raw == pytest.approx(1.0) and rep[("q4", 2)].f == pytest.approx(0.95)
    assert rep[("q1", 1)].speedup == 1.0 and rep[("q1", 1)].f is None


def test_amdahl_curve_bounds(runs):
    cur = amdahl_curve(scaling_report(runs)).collect()
    assert len(cur) == 50 * 5
    for r in cur:
        assert 1.0 - 1e-12 <= r.predicted <= r.n + 1e-12
    first = [r for r in cur if r.point == 0]
    assert all(abs(r.predicted - 1.0) < 1e-12 and r.n == 1.0 for r in first)
