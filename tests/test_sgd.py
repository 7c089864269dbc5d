"""L2 as synchronous SGD: equal for any number of ranks, equal to one loop over the whole table."""

from __future__ import annotations

import hashlib
import time

import numpy as np
import pytest

from dfinsight.operators import sgd
from dfinsight.operators.learning import classification_metrics
from tests.conftest import SF001

N, D, C, BATCH = 157, 5, 3, 32


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(C, D))
    y = rnd.integers(0, C, N)
    x = (centres[y] + rnd.normal(scale=.7, size=(N, D))).astype(np.float32)
    rows = [(i * 3, [float(v) for v in x[i]], int(y[i])) for i in range(N)] + [(-1, None, 1), (-2, [0.0] * D, None)]
    return x.astype(float), y, spark.createDataFrame(rows, "id long, x array<float>, y int").repartition(4)


def plain(x, y, epochs, rate, decay):
    """One loop over the whole table."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, losses = np.zeros((C, D + 1)), []
    for epoch in range(epochs):
        order = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"0-{epoch}-{i * 3}".encode()).hexdigest(), i))
        total = 0.0
        for at in range(0, len(x), BATCH):
            part = order[at:at + BATCH]
            g, loss = sgd._gradient(w, x[part], y[part])
            total += loss
            w = w - rate * (g / len(part) + decay * w)
        losses.append(total / len(x))
    return w, losses


@pytest.mark.parametrize("ranks", [1, 2, 4])
def test_ranks_agree_with_the_plain_loop(data, ranks):
    x, y, df = data
    model = sgd.train_sgd(df, "x", "y", "id", ranks=ranks, epochs=3, batch=BATCH, rate=.4, decay=.01, n_classes=C)
    w, losses = plain(x, y, 3, .4, .01)
    assert np.abs(model.weights - w).max() < 1e-9
    assert [h[:3] for h in model.history] == [(e, N, -(-N // BATCH)) for e in range(3)]
    assert [h[3] for h in model.history] == pytest.approx(losses, abs=1e-9)


def test_scores_and_epoch_table(spark, data):
    x, y, df = data
    model = sgd.train_sgd(df, "x", "y", "id", ranks=2, epochs=4, batch=BATCH, rate=.4, n_classes=C)
    z = np.hstack([x, np.ones((N, 1))]) @ model.weights.T
    want = {i * 3: (int(z[i].argmax()), float(np.log(np.exp(z[i]).sum()) - z[i][y[i]])) for i in range(N)}
    scored = model.scores(df.filter("x is not null and y is not null"), "x", "y", "id")
    for r in scored.collect():
        assert r.prediction == want[r.id][0] and r.loss == pytest.approx(want[r.id][1])
    assert classification_metrics(scored, label="y", batch=None).first().accuracy_pct > 80
    assert model.epochs(spark).count() == 4 and model.history[-1][3] < model.history[0][3]


def test_empty_table_keeps_zero_weights(data):
    model = sgd.train_sgd(data[2].filter("false"), "x", "y", "id", ranks=2, epochs=1, n_classes=C)
    assert model.history == [(0, 0, 0, None)] and not model.weights.any()


def test_exchange_runs_in_a_barrier_stage(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    model = sgd.train_sgd(emb, "embedding", "label", "vec_id", ranks=3, epochs=1, batch=64)
    one = sgd.train_sgd(emb, "embedding", "label", "vec_id", ranks=1, epochs=1, batch=64)
    assert np.abs(model.weights - one.weights).max() < 1e-9


def test_a_step_costs_far_less_than_a_second(data):
    def seconds(batch):
        began = time.monotonic()
        model = sgd.train_sgd(data[2], "x", "y", "id", ranks=3, epochs=1, batch=batch, n_classes=C)
        return time.monotonic() - began, model.history[0][2]

    seconds(N)
    (one, steps), (many, more) = seconds(N), seconds(3)
    assert (steps, more) == (1, 53) and many - one < 40
