"""Operator 13 against a plain version, its structures against counting, and odd inputs."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dfinsight.llm import fill_middle as fim

DOCS = "doc_id long, text string, n string, form string, id string"
TEXTS = [None, "", " \n\t", "a", "ab", "日本語 テキスト\n\nzweite Zeile é ü\n", "has <S> inside", "<P>", "x" * 30_000, "word " * 9_000, "🙂" * 501,
         "<", "<<<>>>", "S>M>P><", "<P <S <M", " lead and trail \n", "one\ntwo\nthree", "same", "same"]


def units_of(text: str, unit: str) -> list[int]:
    """Start (code point) of every unit but the first, then the end."""
    if unit == "char":
        return [*range(1, len(text)), len(text)][:len(text)]
    if unit == "word":
        starts = [i for i, c in enumerate(text) if c not in " \t\n\v\f\r" and (i == 0 or text[i - 1] in " \t\n\v\f\r")]
        return [*starts[1:], len(text)] if starts else []
    return [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)] + ([len(text)] if text else [])


def plain(doc_id, text, unit="char"):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    ends = [0, *units_of(text, unit)]
    n = len(ends) - 1
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[a], (ends[b] if b < n else len(text))
    a = len(text) if sorted((h1 % (n + 1), h2 % (n + 1)))[0] >= n and n else a
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k * 1000 + i, t, "x", "y", "z") for k in range(6) for i, t in enumerate(TEXTS)] + [(None, "no id here", None, None, None)] * 2
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_equals_plain_version(docs, unit):
    got = sorted((tuple(r) for r in fim.fill_middle(docs, unit=unit).collect()), key=repr)
    want = sorted((plain(r.doc_id, r.text, unit) for r in docs.select("doc_id", "text").collect()), key=repr)
    for g, w in zip(got, want):
        if w[1]:
            assert g == w
        else:  # a text without a unit: nothing stands before the cuts
            assert g[:3] == w[:3]
    assert len(got) == len(want)


def test_every_output_gives_its_text_back(docs):
    for unit in fim.UNITS:
        rows = fim.fill_middle(docs, unit=unit, transformed_percent=100, spm_percent=50)
        texts = docs.select(F.col("doc_id").alias("i"), F.coalesce("text", F.lit("")).alias("t"))
        back = rows.withColumn("back", fim.restored(F.col("output"), F.col("form"))).join(texts, F.expr("doc_id <=> i"))
        assert back.filter("back <> t").count() == 0 and back.filter("form <> 'plain'").select("form").distinct().count() == 2


def test_rank_and_select_equal_counting():
    rnd = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000, 4096):
        classes = rnd.choice(5, n, p=[.3, .5, .1, .07, .03]).astype(np.uint8)
        matrix, at = fim.WaveletMatrix(classes), np.arange(n + 1)
        for c in range(6):
            assert (matrix.rank(c, at) == np.concatenate([[0], np.cumsum(classes == c)])).all()
            where = np.flatnonzero(classes == c)
            assert (matrix.select(c, np.arange(len(where))) == where).all()


def test_slices_do_not_change_the_result(docs):
    want = sorted(map(repr, fim.fill_middle(docs).collect()))
    assert sorted(map(repr, fim.fill_middle(docs, slice_bytes=64).collect())) == want


def test_empty_table_and_unknown_unit(spark):
    none = spark.createDataFrame([], DOCS)
    assert fim.fill_middle(none).collect() == []
    with pytest.raises(ValueError):
        fim.fill_middle(none, unit="page")
