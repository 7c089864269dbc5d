"""Operator 3: recall and share of vectors verified, the stop rule, and vectors outside the range of squares."""

from __future__ import annotations

import numpy as np
import pytest

from dfinsight.llm import collision_ann as ann


def searched(ids, vectors, queries, k=10):
    """Mean recall and share verified of the queries (positions)."""
    index = ann.CollisionIndex(ids, vectors)
    recall, share = [], []
    for q in queries:
        got, d = index.search(ids[q], vectors[q], k)
        exact = ann.distances(vectors, vectors[q])
        exact[q] = np.inf
        want = np.lexsort((ids, exact))[:k]
        assert (np.diff(d) >= 0).all() and d == pytest.approx(exact[np.searchsorted(ids, got)], rel=1e-15)
        recall.append(len(set(ids[want]) & set(got)) / k)
        share.append(index.verified / (len(ids) - 1))
    return np.mean(recall), np.mean(share)


def test_clustered_vectors_are_pruned():
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(40, 64)).repeat(150, 0) * 3 + rnd.normal(size=(6000, 64))
    recall, share = searched(np.arange(6000), vectors, range(0, 6000, 150))
    assert recall >= .95 and share <= .1


def test_recall_of_vectors_without_structure():
    vectors = np.random.default_rng(2).normal(size=(5000, 64))
    recall, share = searched(np.arange(5000), vectors, range(0, 5000, 200))
    assert recall >= .9 and share < .75


def test_sure_reach_is_the_binomial_law():
    rnd, lines, need = np.random.default_rng(3), 96, 77
    reach = ann.sure_reach(lines, need)
    inside = (np.abs(rnd.normal(size=(20_000, lines))) <= reach).sum(1) >= need
    assert inside.mean() == pytest.approx(1 - ann.MISS, abs=.01)


@pytest.mark.parametrize("size", [1e200, 1.7e308, 1e-200, 5e-324])
def test_large_and_small_vectors_are_found(spark, size):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.clip(rnd.uniform(.2, 1, 8) * rnd.choice([-1, 1], 8), -1, 1) * size]) for i in range(0, 300, 6)] + [(600, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id % 100 = 0"), k=100).collect()
    asked = {r[0] for r in rows if r[0] % 100 == 0 and any(r[1])}
    with_value = {r[0] for r in rows if any(r[1])}
    assert {(r.query_id, r.vec_id) for r in got} == {(q, v) for q in asked for v in with_value if v != q}
    for r in got:
        a, b = (np.array(dict(rows)[x]) for x in (r.query_id, r.vec_id))
        with np.errstate(over="ignore"):
            want = float(np.hypot.reduce(a / 2 - b / 2)) * 2 if size > 1 else float(np.hypot.reduce(a - b))
        assert r.score == pytest.approx(want, rel=1e-12)


def test_mixed_magnitudes_keep_their_distances():
    vectors = np.array([[1e200, 0.0], [3e-3, 4e-3], [6e-3, 8e-3], [0.0, 1e-3], [1e-180, 2e-180]])
    assert ann.distances(vectors, vectors[1]).tolist() == pytest.approx([1e200, 0, 5e-3, np.hypot(3e-3, 3e-3), 5e-3])
    assert ann.distances(vectors, np.array([0.0, 1e-180]))[4] == pytest.approx(np.hypot(1, 1) * 1e-180)


def test_windows_are_looked_up_for_several_widenings_at_once():
    class Counted(np.ndarray):
        calls = 0

        def searchsorted(self, *args, **kwargs):
            Counted.calls += 1
            return np.asarray(self).searchsorted(*args, **kwargs)

    vectors = np.random.default_rng(5).normal(size=(3000, 64))
    index = ann.CollisionIndex(np.arange(3000), vectors)
    want = index.search(0, vectors[0], 10)
    index.values = index.values.view(Counted)
    got = index.search(0, vectors[0], 10)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    assert 0 < Counted.calls <= ann.LINES * 17  # a search of 64 widenings; one by one it was 2 calls a line and widening
