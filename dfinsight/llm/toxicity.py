"""Operator 2, toxicity severity by cumulative-link ordinal regression.

Severity grades 0 < 1 < ... < K share one weight vector over sparse word features and differ in K
ordered thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). The model is fitted by maximum
likelihood on a bounded sample of labelled documents; every document is then scored whole, and gets
its most likely grade and its expected severity (the sum of k P(grade = k)).

``labels`` marks documents as toxic or not. Grades are made from the mark: 0 is not toxic, and the
toxic documents of the sample are ranked by how much of their text is made of words typical of the
toxic class and cut into ``GRADES`` equal parts. With grades of your own, call ``fit`` with them.

Bounds: at most about ``MAX_PER_CLASS`` sampled documents per class (chosen by a hash), ``MAX_WORDS``
weights. The sampled label rows are the only broadcast of rows, and that bound holds for them. The
fit runs in one task over the sampled documents' sparse counts. Scoring is one map: no shuffle.

Defined cases: null or wordless text scores grade 0 and the severity of an empty vector; labels that
are null are not used; labels and rows that repeat count once in the sample, a document labelled both
ways once in each class; no toxic labels or no labels at all
give severity 0 for every document; extra columns are ignored; repeated rows repeat.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import map_arrow, pieces, stored, table, without

WORDS = re.compile(r"[^\W\d_]+")
MAX_PER_CLASS, MAX_WORDS, MIN_DOCS, MIN_ODDS, GRADES = 6000, 4000, 5, 1.0, 3
RIDGE, STEPS = 0.02, 250


def word_counts(text: str | None) -> Counter:
    return Counter(WORDS.findall((text or "").lower()))


def _class_words(batches):
    """(word, documents not toxic, documents toxic), pre-aggregated in the task."""
    held: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        words = list(held[0].keys() | held[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[0][w] for w in words], pa.int64()),
                                           pa.array([held[1][w] for w in words], pa.int64())], names=["word", "n0", "n1"])

    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held[int(toxic > 0)].update(word_counts(text).keys())
            if len(held[0]) + len(held[1]) > 300_000:
                yield out()
                held = (Counter(), Counter())
    yield out()


def choose_words(sample: DataFrame, max_words: int = MAX_WORDS) -> dict[str, float]:
    """Features: the words of ``sample`` (text, grade) whose document frequency differs most between
    grade 0 and the rest, with that difference in log odds (words under MIN_ODDS are no evidence)."""
    n = sample.agg(F.sum((F.col("grade") == 0).cast("long")), F.sum((F.col("grade") > 0).cast("long"))).first()
    n0, n1 = (n[0] or 0) + 1, (n[1] or 0) + 1
    found = map_arrow(sample.select("text", "grade"), _class_words, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) / n1) - F.log((F.col("n0") + 0.5) / n0)
    rows = (found.filter(F.col("n0") + F.col("n1") >= MIN_DOCS).withColumn("odds", odds).filter(F.abs("odds") >= MIN_ODDS)
            .withColumn("gain", F.abs(F.col("odds")) * F.sqrt(F.col("n0") + F.col("n1")))
            .orderBy(F.desc("gain"), "word").limit(max_words).collect())
    return {r.word: r.odds for r in rows}


def sparse(text: str | None, index: dict[str, int]) -> tuple[list[int], list[float]]:
    """Feature numbers and damped counts of a text. Counts, not rates: one insult counts in a long text too."""
    found = [(i, c) for w, c in word_counts(text).items() if (i := index.get(w)) is not None]
    return [i for i, _ in found], [float(np.log1p(c)) for _, c in found]


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(rows: list[tuple[list[int], list[float]]], grade: np.ndarray, dim: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by Adam on the whole (bounded) sample."""
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    idx = np.concatenate([np.array(i, np.int64) for i, _ in rows]) if rows else np.zeros(0, np.int64)
    val = np.concatenate([np.array(v, np.float64) for _, v in rows]) if rows else np.zeros(0)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=classes))[:-1] / max(1, len(grade)), 1e-3, 1 - 1e-3)
    cut = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(dim), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, gaps = p[:dim], np.exp(p[dim + 1:])
        theta = np.concatenate([p[dim:dim + 1], p[dim] + np.cumsum(gaps)])
        f = np.bincount(at, val * w[idx], len(rows))
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = _sigmoid(edge[grade + 1] - f), _sigmoid(edge[grade] - f)
        prob = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / prob, lo * (1 - lo) / prob
        g = np.zeros_like(p)
        df = (dhi - dlo) / len(rows)
        g[:dim] = np.bincount(idx, df[at] * val, dim) + RIDGE * w / max(1, len(rows)) * 10
        dtheta = np.bincount(grade, -dhi, classes)[:classes - 1] + np.bincount(grade, dlo, classes)[1:classes]
        dtheta /= len(rows)
        g[dim] = dtheta.sum()
        g[dim + 1:] = [dtheta[k + 1:].sum() * gaps[k] for k in range(classes - 2)]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:dim], np.concatenate([p[dim:dim + 1], p[dim] + np.cumsum(np.exp(p[dim + 1:]))])


def fit(sample: DataFrame, grades: int = GRADES, max_words: int = MAX_WORDS) -> dict:
    """``sample``: (text, grade) with integer grades 0..grades; a grade of -1 means toxic, not graded yet."""
    marked = sample.select("text", F.abs("grade").alias("grade"), F.col("grade").alias("given"))
    odds = choose_words(marked, max_words)
    words = list(odds)
    index, weight = {w: i for i, w in enumerate(words)}, np.array([odds[w] for w in words])

    def run(batches):
        rows, given, strength = [], [], []
        for b in batches:
            for text, g in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                i, v = sparse(text, index)
                rows.append((i, v))
                given.append(g)
                strength.append(float(np.dot(np.maximum(weight[i], 0), v)) if i else 0.0)
        grade = np.array(given, np.int64)
        if not len(grade) or (grade == 0).all():
            w, theta = np.zeros(len(words)), np.array([])
        else:
            open_ = np.flatnonzero(grade < 0)
            order = open_[np.argsort(np.array(strength)[open_], kind="stable")]
            grade[order] = 1 + np.arange(len(order)) * grades // max(1, len(order))
            w, theta = fit_ordinal(rows, grade, len(words), grades + 1)
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64())), pa.array([theta.tolist()], pa.list_(pa.float64()))], names=["w", "theta"])

    got = map_arrow(marked.coalesce(1), run, "w array<double>, theta array<double>").first()
    return {"words": words, "w": np.array(got.w), "theta": np.array(got.theta)} if got else {"words": [], "w": np.zeros(0), "theta": np.zeros(0)}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, plus expected ``severity``, most likely ``grade`` and
    ``toxic`` (grade 1 or higher is likelier than not) with its probability ``p_toxic``. Columns of these
    names are replaced."""
    docs = without(docs, "severity", "grade", "toxic", "p_toxic")
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        index, w, theta = {x: i for i, x in enumerate(model["words"])}, model["w"], model["theta"]
        for b in pieces(batches):
            f = np.array([float(np.dot(w[i], v)) if i else 0.0 for i, v in (sparse(t, index) for t in b.column(at).to_pylist())])
            up = 1 - _sigmoid(theta[None, :] - f.reshape(-1, 1)) if len(theta) else np.zeros((len(f), 1))
            prob = np.concatenate([1 - up[:, :1], up[:, :-1] - up[:, 1:], up[:, -1:]], 1)
            keep = [(c, n) for i, (c, n) in enumerate(zip(b.columns, b.schema.names)) if i != at]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in keep), pa.array(up.sum(1)), pa.array(prob.argmax(1).astype(np.int32)),
                                              pa.array(up[:, 0] > 0.5), pa.array(up[:, 0])], names=[*(n for _, n in keep), "severity", "grade", "toxic", "p_toxic"])

    rest = docs.drop(text)
    return map_arrow(docs, run, ", ".join([*(f"`{x.name}` {x.dataType.simpleString()}" for x in rest.schema.fields),
                                           "severity double", "grade int", "toxic boolean", "p_toxic double"]))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(text, grade): at most about ``max_per_class`` labelled documents of each class; grade 0 or -1."""
    rows = labels.filter("toxic is not null and doc_id is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("t")).distinct()
    n = {r.t: r.n for r in rows.groupBy("t").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("t") == 1, F.lit(min(1.0, max_per_class / max(1, n.get(1, 0))))).otherwise(F.lit(min(1.0, max_per_class / max(1, n.get(0, 0)))))
    few = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) < share * (1 << 30))
    joined = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id", "text", "t"])
    return stored(joined.select("text", (-F.col("t")).alias("grade")), "labelled")


def q_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(labelled_sample(docs, table(spark, sf_dir, "labels"))))
