"""Operator 9 [native], mixing sources to target weights.

Each source gets a word budget: its weighted share of the mix, at most ``max_epochs`` times its own
size, the excess of capped sources shared again by weight among the others (a water level, solved
in closed form over one row per source). Documents get hash-random keys. The keys are uniform, so
their leading digits cut every source, however large, into even ranges; words are summed per range
(pre-aggregated before the shuffle), prefix sums over the few ranges give each range's offset, and
a window inside a range finishes the prefix sum of every document. A document is taken where its
words lie below the budget, once per epoch; the one document on the cut gives the words that are
left, so the words taken of a source equal its rounded budget.

Defined cases: null text has size 0 and is taken 0 times; sources of size 0 get target 0; a null
source is a source of its own, last in order; repeated rows are documents of their own (rows equal
in id and text are interchangeable); an empty table gives an empty result; extra columns are
kept; every rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .base import free_name, stored, table, word_count

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix-1"
#: Hex digits of the key that name a range: 4096 ranges of every source.
RANGE_DIGITS = 3


def random_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Drawn from id and text, so that documents without an id, or under one, spread like all others."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), own).cast("binary"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same plus ``target``. Windows here run over one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_cap = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    total = F.sum("source_size").over(W.partitionBy())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    rows = (sizes.withColumn("_w", w.cast("double")).withColumn("_cap", F.lit(float(max_epochs)) * F.col("source_size"))
            .withColumn("_ratio", F.col("_cap") / F.col("_w")).withColumn("_total", F.lit(float(share)) * total)
            .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            .withColumn("_free", F.sum("_w").over(W.partitionBy()) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    # with the sources in order of cap / weight, the water level is the first one that its own source can take
    level = F.min(F.when((F.col("_total") - F.col("_capped")) / F.col("_free") <= F.col("_ratio"),
                         F.struct(F.col("_ratio"), F.col("source").isNull().alias("_n"), F.col("source").alias("_s"),
                                  ((F.col("_total") - F.col("_capped")) / F.col("_free")).alias("_level")))).over(W.partitionBy())
    return (rows.withColumn("_l", level)
            .select("source", "source_size",
                    F.when(F.col("_l").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_l._level") * F.col("_w"))).alias("target")))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS,
        share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` (all columns, but named ``d``) with size, source_size, target, taken and budget_before
    (words of the source that come before the document in the random order)."""
    rows = docs.select(F.struct("*").alias("d"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       random_key(F.col(key), F.col(text), seed).alias("key"))
    return mixed(rows, weights, share, max_epochs)


def mixed(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The same for rows that already have (d, source, size, key); d must be orderable."""
    part = F.substring("key", 1, RANGE_DIGITS)
    ranges = rows.groupBy("source", part.alias("range")).agg(F.sum("size").alias("n"))
    per_source = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select("source", "range", F.coalesce(F.sum("n").over(per_source), F.lit(0)).alias("offset"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, max_epochs)
    known = offsets.alias("o").join(targets.alias("t"), F.expr("o.source <=> t.source")) \
        .select("o.source", "o.range", "o.offset", "t.source_size", "t.target")
    inside = W.partitionBy("source", "range").orderBy("key", "d").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("range", part).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.alias("p").join(known.alias("k"), F.expr("p.source <=> k.source and p.range = k.range"))
    start, budget = F.col("k.offset") + F.col("p.inside"), F.round("k.target").cast("long")
    taken = sum(F.greatest(F.lit(0), F.least(F.col("p.size"), budget - F.lit(e) * F.col("k.source_size") - start))
                for e in range(max_epochs))
    return joined.select("p.d", "p.source", "p.size", "k.source_size", "k.target", taken.cast("long").alias("taken"), start.alias("before"))


def q_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("d"), "source", word_count(F.col("text")).alias("size"),
                       random_key(F.col("doc_id"), F.col("text")).alias("key"))
    return mixed(stored(rows, "mix-keys")).select(F.col("d").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH docs AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                     md5(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS key FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w,
                    2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM sizes),
filled AS (SELECT *, cap / w AS ratio,
                  coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                  sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free
           FROM weighted),
level AS (SELECT (total - capped) / free AS v FROM filled WHERE (total - capped) / free <= ratio
          ORDER BY ratio, source ASC NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN (SELECT v FROM level) IS NULL THEN cap ELSE least(cap, (SELECT v FROM level) * w) END AS target FROM filled),
placed AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM docs)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CAST(greatest(0, least(p.size, CAST(round(t.target) AS BIGINT) - p.before))
          + greatest(0, least(p.size, CAST(round(t.target) AS BIGINT) - t.source_size - p.before)) AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""


def stage_source_mix(spark, docs, sf_dir):
    """Pipeline stage: each document comes as many times as the mix takes it (0, 1 or 2); the one on a
    source's cut comes once more where at least half its words are still in the budget."""
    out, copy = mix(docs), free_name(docs, "copy")
    times = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)))
    return (out.withColumn("times", times.cast("int")).filter("times > 0")
            .select("d.*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias(copy)).select(*[f"`{c}`" for c in docs.columns]))
