"""Word count (P12, D10, O4, X9): text scan -> generate -> partial/final hash aggregate, all JVM; and the top k by thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import WORD_SPLIT_REGEX
from ..plans.sizing import materialize
from ..session import importable


def explode_words(df: DataFrame, col: str, out: str = "word") -> DataFrame:
    """One row per whitespace token of ``col`` (Python ``str.split()`` tokens, whole text).

    Split, explode, then drop the empty edge tokens with a plain filter (stays in whole-stage
    codegen, unlike an array ``filter`` lambda). The text itself is never shuffled: the tasks are
    the splits of the scan, so texts landed in small row groups spread by themselves.
    """
    return (df.select(F.explode(F.split(F.col(col), WORD_SPLIT_REGEX)).alias(out))
            .filter(F.col(out) != F.lit("")))


def word_count(df: DataFrame, col: str, k: int | None = None, out: str = "word") -> DataFrame:
    """Occurrences per word; with ``k`` the k most frequent, ties broken by the word.

    ``groupBy().count()`` combines map-side, so a word making up a third of all tokens costs one
    partial row per task; the top-k is a ``TakeOrderedAndProject``, never a full sort.
    """
    counted = explode_words(df, col, out).groupBy(out).agg(F.count(F.lit(1)).alias("n"))
    if k is None:
        return counted
    return counted.orderBy(F.col("n").desc(), F.col(out).asc()).limit(k)


# ----------------------------------------------------------------------------- top-k without shuffling the vocabulary
#: Words a task counts before it gives them out; a task with more is several sites.
SITE_WORDS = 500_000


def _count_site(batches):
    """Rows (word, pid) -> (pid, part, word, c, place): the counts of one task, most frequent first."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def out(table, pid, part):
        order = pc.sort_indices(table, sort_keys=[("c", "descending"), ("word", "ascending")])
        t = table.take(order).combine_chunks()
        n = t.num_rows
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, part, np.int32)), t["word"].combine_chunks(), t["c"].combine_chunks(),
                                           pa.array(np.arange(1, n + 1))], names=["pid", "part", "word", "c", "place"])

    held, pid, part = [], 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        pid = b.column(1)[0].as_py()
        counts = pc.value_counts(b.column(0))
        held.append(pa.table({"word": counts.field("values"), "c": counts.field("counts")}))
        if len(held) >= 64 or sum(t.num_rows for t in held) > SITE_WORDS:
            held = [pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["word", "c"])]
            if held[0].num_rows > SITE_WORDS:
                yield out(held[0], pid, part)
                held, part = [], part + 1
    if held:
        yield out(pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["word", "c"]), pid, part)


def top_words(df: DataFrame, col: str, k: int, out: str = "word") -> tuple[DataFrame, DataFrame]:
    """O4 by a three-phase threshold algorithm: the rows of ``word_count(df, col, k)`` (k most frequent, ties by the word), and
    one row of what it moved (sites, entries, moved_1, moved_2, moved_3, candidates).

    Every task counts its own words and stores them, unshuffled. Phase 1 adds up the sites' own top k: the k-th
    sum t is at most the true k-th count, so a word below t / sites everywhere cannot be among the k. Phase 2 adds up
    what sites hold at or above that share; a word whose sum, with just less than the share from each other site,
    stays below the k-th sum is out. Phase 3 counts the few that are left exactly, over all sites. Only entries of those
    phases are shuffled; the vocabulary is not."""
    spark = df.sparkSession
    importable(spark)
    words = explode_words(df, col, "word").select("word", F.spark_partition_id().alias("pid"))
    sites = materialize(words.mapInArrow(_count_site, "pid int, part int, word string, c long, place long"), "word-sites")
    n_sites, entries = sites.agg(F.count_if(F.col("place") == 1), F.count("*")).first()  # a site has one first place
    kth = lambda sums, n: min((r[0] for r in sums.select(n).orderBy(F.desc(n)).limit(k).collect()), default=0)
    first = sites.filter(F.col("place") <= k)
    sums = first.groupBy("word").agg(F.sum("c").alias("s"))
    t = kth(sums, "s") if sums.count() >= k else 0
    share = -(-t // n_sites) if n_sites else 0  # counts are whole: less than t / sites means less than this
    second = sites.filter(F.col("c") >= share)
    partial = materialize(second.groupBy("word").agg(F.sum("c").alias("s"), F.count("*").alias("told")), "word-sums")
    least = kth(partial, "s") if partial.count() >= k else 0
    candidates = materialize(partial.filter(F.col("s") + (n_sites - F.col("told")) * max(0, share - 1) >= least).select("word"), "word-candidates")
    third = sites.join(candidates, "word", "left_semi")
    moved = [(n_sites, entries, first.count(), second.count(), third.count(), candidates.count())]
    top = third.groupBy("word").agg(F.sum("c").alias("n")).orderBy(F.col("n").desc(), F.col("word").asc()).limit(k)
    report = spark.createDataFrame(moved, "sites long, entries long, moved_1 long, moved_2 long, moved_3 long, candidates long")
    return top.withColumnRenamed("word", out), report
