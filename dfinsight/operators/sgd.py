"""L2 over the shards of L1: synchronous data-parallel SGD.

An epoch's shards are kept in partitions of some steps of a rank each. A step is a small Spark job with one task for every
rank, over the partitions that hold it: a rank adds up the gradient of its part of the global batch, the driver adds the
ranks' gradients in rank order and takes the step, and the next job carries the new weights. What goes to and fro is one
fixed-size gradient (features x classes numbers); rows stay where they are. (An ``allGather`` in a barrier stage does the
same, but Spark's takes a second each, because a waiting task looks for the answer once a second.) A rank that is alone has
nobody to wait for and takes all steps of a partition in one task. The global batch is the same whatever the number of
ranks, and the padding that evens the shards out weighs nothing, so one rank or many arrive at the same weights up to
the order of additions. A lost executor costs the partitions it held, which Spark makes anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .learning import BATCH_SIZE, N_CLASSES, epoch_shards

#: Steps in a partition at least, and blocks of steps in an epoch at most (longer epochs have larger blocks).
BLOCK_STEPS, MOST_BLOCKS = 32, 500
#: Rows of a record about, so that a rank never holds a large step as a whole.
PACK_ROWS = 4096


@dataclass
class SoftmaxModel:
    """Weights (classes x features, the bias last) and one row of facts an epoch."""

    weights: np.ndarray
    history: list[tuple] = field(default_factory=list)  # epoch, n_rows, n_steps, mean_loss

    def epochs(self, spark) -> DataFrame:
        """(epoch, n_rows, n_steps, mean_loss): the loss of each row under the weights before its step, averaged."""
        return spark.createDataFrame(self.history, "epoch int, n_rows long, n_steps long, mean_loss double")

    def scores(self, df: DataFrame, features: str, label: str, id_col: str) -> DataFrame:
        """(id, label, prediction, loss) of every row, by expressions of the JVM."""
        x = F.concat(F.transform(F.col(features), lambda v: v.cast("double")), F.array(F.lit(1.0)))
        dot = lambda w: F.aggregate(F.zip_with(x, F.array(*map(F.lit, w)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        rows = df.withColumn("_z", F.array(*[dot([float(v) for v in w]) for w in self.weights]))
        top = F.array_max("_z")
        lse = top + F.log(F.aggregate(F.transform("_z", lambda v: F.exp(v - top)), F.lit(0.0), lambda s, v: s + v))
        return rows.select(id_col, label, (F.array_position("_z", top) - 1).cast("int").alias("prediction"),
                           (lse - F.element_at("_z", F.col(label) + 1)).alias("loss"))


def _gradient(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Summed cross-entropy gradient and loss of some rows."""
    z = x @ w.T
    z -= z.max(1, keepdims=True)
    log_p = z - np.log(np.exp(z).sum(1, keepdims=True))
    loss = -log_p[np.arange(len(y)), y].sum()
    p = np.exp(log_p)
    p[np.arange(len(y)), y] -= 1
    return p.T @ x, float(loss)


def _packed(batches):
    """Rows (step, label, features, is_padding) sorted by step -> records (step, n, x, y) of at most ``PACK_ROWS`` rows of a step."""
    import pyarrow as pa

    step, xs, ys = None, [], []

    def record():
        n = sum(map(len, ys))
        x, y = (np.concatenate(v) if v else np.zeros(0) for v in (xs, ys))
        return pa.RecordBatch.from_pydict({"step": pa.array([step], pa.int64()), "n": pa.array([n], pa.int64()), "x": pa.array([x.astype(np.float64).tobytes()], pa.binary()),
                                           "y": pa.array([y.astype(np.int64).tobytes()], pa.binary())})

    for b in batches:
        if not b.num_rows:
            continue
        steps, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
        x = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
        real = ~b.column(3).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.flatnonzero(steps[1:] != steps[:-1]) + 1, b.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if ys and (steps[lo] != step or sum(map(len, ys)) >= PACK_ROWS):
                yield record()
                xs, ys = [], []
            step = int(steps[lo])
            xs.append(x[lo:hi][real[lo:hi]])
            ys.append(labels[lo:hi][real[lo:hi]])
    if ys:
        yield record()


def _rank_gradient(weights: np.ndarray, step: int):
    """Task of one rank: summed gradient and loss of its rows of a step."""
    def run(records):
        g, loss = np.zeros_like(weights), 0.0
        for r in records:  # to the end: a Python worker that leaves input unread is not used again
            if r.step == step and r.n:
                part, lost = _gradient(weights, *_rows_of(r))
                g, loss = g + part, loss + lost
        yield g, loss

    return run


def _rows_of(r) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.frombuffer(r.x).reshape(r.n, -1), np.frombuffer(r.y, np.int64)
    return np.hstack([x, np.ones((len(x), 1))]), y


def _rank_steps(weights: np.ndarray, descend):
    """Task of a rank that is alone, so that none waits for its gradient: all steps of its block -> weights, loss."""
    def run(records):
        from itertools import groupby

        w, loss = weights, 0.0
        for step, some in groupby(records, lambda r: r.step):
            g = np.zeros_like(w)
            for r in some:
                if r.n:
                    part, lost = _gradient(w, *_rows_of(r))
                    g, loss = g + part, loss + lost
            w = descend(w, g, step)
        yield w, loss

    return run


def train_sgd(df: DataFrame, features: str, label: str, id_col: str, ranks: int = 2, epochs: int = 2, batch: int = 4 * BATCH_SIZE,
              rate: float = 0.5, decay: float = 0.0, seed: int = 0, n_classes: int = N_CLASSES) -> SoftmaxModel:
    """Softmax regression by synchronous SGD from zero weights: every epoch in the shuffled order of
    :func:`~dfinsight.operators.learning.epoch_shards` of ``seed`` and epoch, ``batch`` rows a step over all ranks.

    ``id_col`` is unique and not null; labels are 0 to ``n_classes`` - 1; rows without label or features are left out."""
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    importable(spark)
    rows = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), F.col(features).alias("x"))
    width = rows.agg(F.max(F.size("x"))).first()[0]
    model = SoftmaxModel(np.zeros((n_classes, (width or 0) + 1)))
    for epoch in range(epochs):
        shards = epoch_shards(rows, "id", ranks, epoch, seed)
        n_rows = shards.filter("not is_padding").count()
        n_steps = -(-n_rows // batch)
        if not n_rows:
            model.history.append((epoch, 0, 0, None))
            continue
        block = max(BLOCK_STEPS, -(-n_steps // MOST_BLOCKS))
        step = F.floor(F.col("position") / F.lit(batch)).cast("long")
        # padding may begin a step of its own, which no rank takes
        placed = shards.select("id", "rank", "position", "is_padding", step.alias("step")).filter(F.col("step") < n_steps).join(rows, "id")
        part = (F.floor(F.col("step") / F.lit(block)) * ranks + F.col("rank")).cast("int")
        packed = (placed.repartitionById(-(-n_steps // block) * ranks, part).sortWithinPartitions("step", "position")
                  .select("step", "y", "x", "is_padding").mapInArrow(_packed, "step long, n long, x binary, y binary"))
        held = packed.rdd.persist(StorageLevel.MEMORY_AND_DISK)

        def descend(w, g, at, n_rows=n_rows):
            return w - rate * (g / min(batch, n_rows - at * batch) + decay * w)

        w, loss = model.weights, 0.0
        try:
            for first in range(0, n_steps, block):
                own = [first // block * ranks + r for r in range(ranks)]  # the partitions of this block, by rank
                if ranks == 1:
                    w, lost = sc.runJob(held, _rank_steps(w, descend), own)[0]
                    loss += lost
                    continue
                for at in range(first, min(first + block, n_steps)):
                    told = sc.runJob(held, _rank_gradient(w, at), own)  # in the order of the ranks
                    w, loss = descend(w, sum(g for g, _ in told), at), loss + sum(lost for _, lost in told)
        finally:
            held.unpersist()
        model.weights = w
        model.history.append((epoch, n_rows, n_steps, loss / n_rows))
    return model
