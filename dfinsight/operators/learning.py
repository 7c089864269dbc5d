"""Data-parallel learning over a table of feature arrays.

* L1 ``epoch_shards``: the per-epoch shuffled, padded, strided shard assignment of a distributed
  sampler, as a table (id, epoch, rank, slot, position).
* L2 ``train_classifier``: multinomial logistic regression from ``pyspark.ml``; gradients are
  summed across executors by Spark's tree aggregation.
* L3 ``classification_metrics``: n, correct, accuracy percent and the mean of per-batch mean
  losses (each batch weighs the same, as in a training log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import standardise
from ..plans.ranged import PID, POS, partition_offsets, ranged_layout

BATCH_SIZE = 64
N_CLASSES = 10


def shuffle_key(id_col: str, epoch: int, seed: int = 0):
    """Per-epoch shuffle key: the MD5 text of ``seed-epoch-id`` (128 bits, the same in SQL), so the orders
    of two epochs have nothing in common and ids of any size get keys of their own."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit(str(epoch)), F.col(id_col).cast("string")).cast("binary"))


def epoch_shards(df: DataFrame, id_col: str, world_size: int = 2, epoch: int = 0, seed: int = 0,
                 n_partitions: int | None = None, batch_size: int = BATCH_SIZE) -> DataFrame:
    """L1: position of every row in the epoch's shuffled order, padded by wrap-around so all ranks
    get the same number of rows; rank r takes positions r, r + world_size, ...

    Output (id, epoch, rank, slot, batch, position, is_padding); slot is the index inside the
    rank, batch = slot div ``batch_size`` (the rank's training step).
    The global order comes from a range layout with per-partition offsets (as in
    :func:`~dfinsight.operators.ranking.global_sequence`).
    """
    keyed = df.select(id_col).withColumn("_h", shuffle_key(id_col, epoch, seed))
    laid = ranged_layout(keyed, ["_h", id_col], n_partitions)
    offsets = partition_offsets(laid)  # one row per range partition (reads only `_pid`)
    # the row count comes from the layout's per-partition counts: no second scan of the input
    n = offsets.agg(F.sum("_n")).first()[0] or 0
    seq = (laid.join(F.broadcast(offsets.select(PID, "_offset")), PID)
           .select(id_col, (F.col("_offset") + F.col(POS)).alias("position")))
    total = -(-n // world_size) * world_size
    rows = seq.withColumn("is_padding", F.lit(False))
    if total > n:
        extra = (seq.filter(F.col("position") < F.lit(total - n))
                 .select(id_col, F.explode(F.sequence(F.col("position") + F.lit(n), F.lit(total - 1),
                                                      F.lit(n).cast("long"))).alias("position"))
                 .withColumn("is_padding", F.lit(True)))
        rows = rows.unionByName(extra)
    return rows.select(id_col, F.lit(epoch).alias("epoch"),
                       F.pmod(F.col("position"), F.lit(world_size)).cast("int").alias("rank"),
                       F.floor(F.col("position") / F.lit(world_size)).cast("long").alias("slot"),
                       F.floor(F.col("position") / F.lit(world_size * batch_size)).cast("long").alias("batch"),
                       "position", "is_padding")


def standardised(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """P14 on a table: ``(x - mean) / std`` per element, as a JVM higher-order function."""
    return df.withColumn(out or col, standardise(col))


def fixed_linear_scores(df: DataFrame, features: str, label: str, id_col: str,
                        batch_size: int = BATCH_SIZE, n_classes: int = N_CLASSES) -> DataFrame:
    """Score rows with a fixed linear model over all features: the logit of class c is the sum of the
    features whose 0-based index is c modulo ``n_classes``; prediction = arg max (the first of equals),
    loss = log-sum-exp(logits) - logit[label], batch = id div batch_size."""
    part = lambda c: F.filter(F.col(features), lambda x, i: F.pmod(i, F.lit(n_classes)) == c)
    total = lambda c: F.aggregate(part(c), F.lit(0.0), lambda a, x: a + x.cast("double"))
    rows = df.withColumn("_z", F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), total))
    z = F.col("_z")
    lse = F.log(F.aggregate(F.transform(z, lambda x: F.exp(x)), F.lit(0.0), lambda a, x: a + x))
    return rows.select(
        id_col, label,
        (F.array_position(z, F.array_max(z)) - 1).cast("int").alias("prediction"),
        (lse - F.element_at(z, F.col(label) + 1)).alias("loss"),
        F.floor(F.col(id_col) / F.lit(batch_size)).cast("long").alias("batch"))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                           loss: str = "loss", batch: str | None = "batch") -> DataFrame:
    """L3: one row (n, correct, accuracy_pct, mean_loss). With ``batch`` the loss is the mean of
    per-batch means (two-level aggregation, both levels partial + final)."""
    correct = (F.col(label) == F.col(prediction)).cast("int")
    if batch is None:
        return pred.agg(F.count(F.lit(1)).alias("n"), F.sum(correct).cast("long").alias("correct"),
                        F.avg(loss).alias("mean_loss")).withColumn(
            "accuracy_pct", F.try_divide(F.col("correct") * F.lit(100.0), F.col("n")))
    per_batch = pred.groupBy(batch).agg(F.count(F.lit(1)).alias("_n"), F.sum(correct).alias("_c"),
                                        F.avg(loss).alias("_l"))
    return per_batch.agg(F.sum("_n").cast("long").alias("n"), F.sum("_c").cast("long").alias("correct"),
                         F.avg("_l").alias("mean_loss")).withColumn(
        "accuracy_pct", F.try_divide(F.col("correct") * F.lit(100.0), F.col("n")))


def train_classifier(df: DataFrame, features: str, label: str, max_iter: int = 300, reg: float = 0.01, tol: float = 1e-6):
    """L2: multinomial logistic regression on an array<float> column (converted in the JVM).

    Each optimiser iteration is one pass over the blocks that Spark ML caches for the fit. It runs to
    the tolerance ``tol``; :func:`training_summary` tells whether it got there within ``max_iter``.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = df.select(array_to_vector(F.col(features)).alias("_features"), F.col(label).cast("double").alias(label))
    lr = LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial", maxIter=max_iter, regParam=reg, tol=tol)
    return lr.fit(data)


def training_summary(model) -> dict:
    """Whether the fit reached its tolerance, whether the objective never rose, and the iterations."""
    history = [float(v) for v in model.summary.objectiveHistory]
    return {"converged": model.summary.totalIterations < model.getMaxIter(), "iterations": int(model.summary.totalIterations),
            "never_rising": all(b <= a + 1e-9 for a, b in zip(history, history[1:]))}


def predict(model, df: DataFrame, features: str, label: str, id_col: str,
            batch_size: int = BATCH_SIZE) -> DataFrame:
    """Predictions of :func:`train_classifier` with the cross-entropy loss of each row."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = df.withColumn("_features", array_to_vector(F.col(features))).withColumn(
        label, F.col(label).cast("double"))
    out = model.transform(data)
    p = F.element_at(vector_to_array("probability"), F.col(label).cast("int") + 1)
    return out.select(id_col, F.col(label).cast("int").alias(label),
                      F.col("prediction").cast("int").alias("prediction"),
                      (-F.log(F.greatest(p, F.lit(1e-300)))).alias("loss"),
                      F.floor(F.col(id_col) / F.lit(batch_size)).cast("long").alias("batch"))
