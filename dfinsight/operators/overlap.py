"""Cross-label overlap (J1): which ids carry label a, label b, or both; and the overlaps of all pairs of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import split_labels
from ..session import importable

#: Ids of one chunk: the bits of one of Spark's bitmaps.
CHUNK = 32768


def region_overlap(df: DataFrame, id_col: str, label_col: str, a: str, b: str, sep: str = "/",
                   trim: bool = False, ids_unique: bool = False) -> DataFrame:
    """(id, side) with side in {'both', 'a_only', 'b_only'} for ids carrying a or b.

    Semantically the intersection (semi join) and the two differences (anti joins) of the a-set
    and the b-set; computed as one aggregation on the id instead of three joins, so each id is
    shuffled once and a label shared by a third of all rows adds no hot join key. With
    ``ids_unique=True`` (the id is the table's key) the side is decided per row, with no shuffle.
    """
    labels = split_labels(label_col, sep, trim=trim)
    flags = (df.select(id_col, labels.alias("_l"))
             .select(id_col,
                     F.exists("_l", lambda x: x == F.lit(a)).alias("_a"),
                     F.exists("_l", lambda x: x == F.lit(b)).alias("_b"))
             .filter(F.col("_a") | F.col("_b")))
    if not ids_unique:
        flags = flags.groupBy(id_col).agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))
    side = (F.when(F.col("_a") & F.col("_b"), F.lit("both"))
            .when(F.col("_a"), F.lit("a_only")).otherwise(F.lit("b_only")))
    return flags.select(id_col, side.alias("side"))


def _chunk_overlaps(batches):
    """Rows (chunk, label, bits) sorted by chunk -> (a, b, n): ids in common of two labels (a < b) of a task's chunks, and
    with a = b the ids of one. The labels of a chunk are a 0/1 matrix; its products with itself count the bitwise ANDs."""
    import numpy as np
    import pyarrow as pa

    total: dict[tuple[str, str], int] = {}
    now, labels, bits = None, [], []

    def add():
        for at in range(0, len(labels), 512):  # blocks of labels, so that a block of products stays small
            rows = np.stack([np.frombuffer(b, np.uint8) for b in bits[at:at + 512]])
            for to in range(at, len(labels), 512):
                cols = rows if to == at else np.stack([np.frombuffer(b, np.uint8) for b in bits[to:to + 512]])
                n = np.zeros((len(rows), len(cols)), np.int64)
                for lo in range(0, rows.shape[1], 256):
                    x, y = (np.unpackbits(m[:, lo:lo + 256], axis=1).astype(np.float32) for m in (rows, cols))
                    n += (x @ y.T).astype(np.int64)
                for i, j in zip(*np.nonzero(n)):
                    a, b = sorted((labels[at + i], labels[to + j]))
                    if to > at or i <= j:
                        total[a, b] = total.get((a, b), 0) + int(n[i, j])

    def out():
        pairs = list(total)
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["a", "b", "n"])

    for batch in batches:
        for chunk, label, b in zip(*(c.to_pylist() for c in batch.columns)):
            if chunk != now:
                add()
                now, labels, bits = chunk, [], []
                if len(total) > 200_000:
                    yield out()
                    total.clear()
            labels.append(label)
            bits.append(b)
    add()
    yield out()


def label_overlaps(df: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """J1 for all labels: (label_a, label_b, n_both, n_a, n_b) of every pair (a < b) with an id in common.

    ``df`` holds one row an id (a whole number) and label; repeated rows count once, rows with a NULL are left out. Every
    label gets one bitmap a chunk of ids, built where the rows are (so ids move once, as bits), and the bitmaps of a chunk meet
    in one task: chunks are as many as the ids need, so a label on a third of all rows is spread like any other."""
    importable(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("string").alias("label")).filter("i is not null and label is not null")
    maps = rows.groupBy(F.floor(F.col("i") / CHUNK).alias("chunk"), "label").agg(F.bitmap_construct_agg(F.pmod("i", F.lit(CHUNK))).alias("bits"))
    found = maps.repartition(parts, "chunk").sortWithinPartitions("chunk", "label").mapInArrow(_chunk_overlaps, "a string, b string, n long")
    pairs = found.groupBy("a", "b").agg(F.sum("n").alias("n"))
    own = pairs.filter("a = b").select(F.col("a").alias("label"), F.col("n").alias("ids"))
    both = pairs.filter("a < b").select(F.col("a").alias("label_a"), F.col("b").alias("label_b"), F.col("n").alias("n_both"))
    return (both.join(own.select(F.col("label").alias("label_a"), F.col("ids").alias("n_a")), "label_a")
            .join(own.select(F.col("label").alias("label_b"), F.col("ids").alias("n_b")), "label_b").select("label_a", "label_b", "n_both", "n_a", "n_b"))
