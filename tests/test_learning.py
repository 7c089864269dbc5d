from collections import Counter

from dfinsight.operators.learning import (classification_metrics, epoch_shards, predict, train_classifier,
                                          training_summary)
from tests.conftest import SF001, SF01


def test_epoch_shards_equal_sizes_and_cover(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    n = emb.count()
    sh = epoch_shards(emb, "vec_id", world_size=3, epoch=1).collect()
    sizes = Counter(r.rank for r in sh)
    assert len(set(sizes.values())) == 1 and sum(sizes.values()) == -(-n // 3) * 3
    assert {r.vec_id for r in sh} == {r.vec_id for r in emb.select("vec_id").collect()}
    assert sum(r.is_padding for r in sh) == -(-n // 3) * 3 - n
    assert sorted(r.position for r in sh) == list(range(len(sh)))


def test_epoch_shards_depend_on_epoch_only(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    a = {r.vec_id: r.position for r in epoch_shards(emb, "vec_id", 2, epoch=0).collect()}
    b = {r.vec_id: r.position for r in epoch_shards(emb, "vec_id", 2, epoch=0, n_partitions=3).collect()}
    c = {r.vec_id: r.position for r in epoch_shards(emb, "vec_id", 2, epoch=1).collect()}
    assert a == b and a != c


def test_metrics_mean_of_batch_means(spark):
    pred = spark.createDataFrame([(0, 0, 1.0, 0), (1, 2, 3.0, 0), (2, 2, 5.0, 1)],
                                 "label int, prediction int, loss double, batch long")
    m = classification_metrics(pred).first()
    assert (m.n, m.correct) == (3, 2) and abs(m.accuracy_pct - 200 / 3) < 1e-9 and m.mean_loss == 3.5
    assert classification_metrics(pred, batch=None).first().mean_loss == 3.0


def test_train_classifier_runs(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    model = train_classifier(emb, "embedding", "label", max_iter=10)
    m = classification_metrics(predict(model, emb, "embedding", "label", "vec_id")).first()
    assert m.n == emb.count() and m.mean_loss > 0
    assert not training_summary(model)["converged"] and training_summary(model)["never_rising"]
    done = training_summary(train_classifier(emb, "embedding", "label"))
    assert done["converged"] and 10 < done["iterations"] < 300


def test_epoch_shards_fewer_rows_than_ranks(spark):
    one = spark.createDataFrame([(42,)], "vec_id long")
    sh = sorted((r.rank, r.position, r.is_padding) for r in epoch_shards(one, "vec_id", world_size=3).collect())
    assert sh == [(0, 0, False), (1, 1, True), (2, 2, True)]


def test_metrics_on_empty_predictions(spark):
    empty = spark.createDataFrame([], "label int, prediction int, loss double, batch long")
    m = classification_metrics(empty).first()
    assert m.n is None or m.n == 0
    assert m.accuracy_pct is None and m.mean_loss is None


def test_epoch_shard_batches(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    sh = epoch_shards(emb, "vec_id", world_size=2, epoch=0, batch_size=64).collect()
    per = Counter((r.rank, r.batch) for r in sh)
    assert max(per.values()) == 64 and all(r.batch == r.slot // 64 for r in sh)


def test_epochs_are_not_rotations_of_one_another(spark):
    ids = [*range(300), *(2**31 - 1 + i for i in range(50)), *(2**40 + i for i in range(50))]
    df = spark.createDataFrame([(i,) for i in ids], "id long")

    def order(epoch):
        return [r.id for r in epoch_shards(df, "id", 1, epoch).filter("not is_padding").orderBy("position").collect()]
    first, second = order(0), order(1)
    assert sorted(first) == sorted(second) == sorted(ids)
    at = second.index(first[0])
    assert second[at:] + second[:at] != first
    after = dict(zip(first, first[1:]))
    assert sum(after.get(a) == b for a, b in zip(second, second[1:])) < 20
