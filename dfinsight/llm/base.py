"""Shared pieces of the training-data operators: table reading, scratch tables, Arrow map, connected
components by joins, and a fixed-size id bitmap that prunes a scan without ever dropping a match."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: Words of the contracts: runs of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH")) if x)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(fn, schema)


def pieces(batches, rows: int = 1024):
    """The batches in slices of at most ``rows`` rows, so that what a task holds as Python objects stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts lineage, survives lost
    executors and is not computed twice."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def release(*tables: DataFrame) -> None:
    """Deletes tables written by :func:`stored`, once every table made from them is written itself."""
    for df in tables:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if "/dfinsight/" not in folder:
                raise ValueError(f"{folder} is not a scratch table")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns called like the ones an operator adds: its own columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread_join(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner", salts: int = 64) -> DataFrame:
    """``rows`` with the columns of ``facts`` (one row a key). A key's rows are dealt to ``salts`` tasks; each salt of a
    key is in the small join once, however many rows it has."""
    salt = free_name(rows, "salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    each = salted.select(key, salt).distinct().join(facts, key, how)
    return salted.join(each, [key, salt]).drop(salt)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


# ------------------------------------------------------------------ id bitmaps
BITMAP_BITS, MOST_BITMAP_BITS = 1 << 23, 1 << 28


def bitmap_bits(ids: DataFrame) -> int:
    """Eight bits an id, rounded up to a power of two, from 1 MB up to 32 MB in all."""
    return min(MOST_BITMAP_BITS, max(BITMAP_BITS, 1 << max(0, 8 * ids.count() - 1).bit_length()))


def id_bitmap(ids: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of ``bits`` bits (1 MB by default, 32 MB at most by :func:`bitmap_bits`) of the hashed values of ``col``.
    Only whole 4 KB words of the bitmap reach the driver. With more ids than bits it fills
    up and prunes less, but never hides an id."""
    per = 32768  # positions in one bitmap of Spark's bitmap functions
    pos = F.pmod(F.xxhash64(F.col(col)), F.lit(bits))
    rows = (ids.select(pos.alias("p")).groupBy((F.col("p") / per).cast("int").alias("k"))
            .agg(F.expr(f"bitmap_construct_agg(p % {per})").alias("b")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r.k * per // 8:(r.k + 1) * per // 8] = np.frombuffer(bytes(r.b), np.uint8)
    return out


# ------------------------------------------------------------------ connected components
def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: long); comp is the smallest node reachable.

    Alternating large-star and small-star steps: every round is two grouped minima and two joins on
    the edge table, stored in the shared folder; the number of rounds grows with the logarithm of
    the longest path. Stops when a round leaves the edges as they were.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b"), F.col("a"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(low, "a")
        if large:
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = low.filter("m < a").select("a", F.col("m").alias("b"))
        return joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        return tuple(r)

    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b"))).distinct()
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    for _ in range(max_rounds):
        now = stored(stars(stars(now, True), False), "edges")
        if (after := mark(now)) == seen:
            break
        seen = after
    else:
        raise RuntimeError("connected components did not settle; raise max_rounds")
    return (nodes.join(now.select(F.col("a").alias("node"), "b"), "node", "left")
            .select("node", F.coalesce("b", "node").alias("comp")))
