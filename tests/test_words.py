import random

import pytest
from pyspark.errors import AnalysisException

from dfinsight.operators.words import top_words, word_count
from dfinsight.sources.io import lines_from, read_lines
from tests.conftest import plan_of

SAMPLE = ["red fish blue fish", "one fish", "two red birds", "  blue\tbirds ", ""]


def test_word_count_sample(spark):
    got = {r.word: r.n for r in word_count(lines_from(spark, SAMPLE), "value").collect()}
    assert got == {"fish": 3, "red": 2, "blue": 2, "birds": 2, "one": 1, "two": 1}
    top = word_count(lines_from(spark, SAMPLE), "value", k=3).collect()
    assert [(r.word, r.n) for r in top] == [("fish", 3), ("birds", 2), ("blue", 2)]


def test_read_lines_fallback_is_eager(spark):
    with pytest.warns(UserWarning, match="does not exist"):
        df = read_lines(spark, "/nonexistent/path/sample.txt", fallback=SAMPLE)
    assert df.count() == len(SAMPLE)
    with pytest.raises(AnalysisException):
        read_lines(spark, "/nonexistent/path/sample.txt")


def test_word_count_plan_stays_in_jvm(spark):
    plan = plan_of(word_count(lines_from(spark, SAMPLE), "value", k=10))
    assert "PythonUDF" not in plan and "TakeOrderedAndProject" in plan and "HashAggregate" in plan


def test_word_count_shuffles_only_counts(spark):
    plan = plan_of(word_count(spark.range(100).selectExpr("concat('w', id % 7, ' x') AS value"), "value"))
    assert plan.count("Exchange hashpartitioning") == 1 and "RoundRobin" not in plan


def test_threshold_top_equals_the_full_count(spark):
    rnd = random.Random(3)
    rows = [(i % 16, " ".join(f"w{min(int(rnd.paretovariate(.7)), 20_000)}" for _ in range(80))) for i in range(600)]
    df = spark.createDataFrame(rows, "site int, text string").repartition(16, "site")
    for k in (1, 3, 10, 50, 100_000):
        got, report = top_words(df, "text", k)
        assert got.collect() == word_count(df, "text", k, out="word").collect()
        moved = report.first()
        if k <= 10:
            assert moved.sites > 4 and moved.moved_3 < moved.entries / 10
    none, report = top_words(df.filter("false"), "text", 5)
    assert none.collect() == [] and report.first().entries == 0


def test_threshold_top_moves_little_of_the_vocabulary(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8, "doc_id")
    got, report = top_words(df, "text", 10)
    assert got.collect() == word_count(df, "text", 10).collect()
    moved = report.first()
    assert moved.sites == 8 and max(moved.moved_1, moved.moved_2, moved.moved_3) < .05 * moved.entries


def test_a_site_of_many_words_is_cut(spark):
    from dfinsight.operators import words as w
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"word": [f"w{j}" for j in range(i * 10, i * 10 + 40)], "pid": [3] * 40}) for i in range(200)]
    limit, w.SITE_WORDS = w.SITE_WORDS, 300
    try:
        out = [b.to_pydict() for b in w._count_site(batches)]
    finally:
        w.SITE_WORDS = limit
    assert len(out) > 3 and [b["part"][0] for b in out] == list(range(len(out))) and sum(sum(b["c"]) for b in out) == 8000
    assert all(b["place"] == list(range(1, len(b["word"]) + 1)) and b["c"] == sorted(b["c"], reverse=True) for b in out)
