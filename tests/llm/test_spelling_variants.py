"""Operator 11 against comparing all pairs; splits, ties, long words, odd inputs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dfinsight.llm import spelling_variants as sv

DOCS = "doc_id long, text string, word string, n string, root string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_groups(words: dict[str, int]):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def words_over(rnd, alphabet, n, length=(7, 10), prefix=""):
    return {prefix + "".join(rnd.choice(alphabet) for _ in range(rnd.randint(*length) - len(prefix))) for _ in range(n)}


def as_table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)


def test_acceptor_pairs_equal_all_pairs():
    rnd = random.Random(1)
    for alphabet, n in (("ab", 150), ("abc", 300), ("aéÿz", 200), ("a", 8), ("abcdefgh", 300)):
        words = sorted(words_over(rnd, alphabet, n, (1, 9)))
        x, y = sv.Acceptor(words).one_edit_pairs()
        got = [frozenset((words[i], words[j])) for i, j in zip(x.tolist(), y.tolist())]
        assert len(got) == len(set(got)) and set(got) == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_acceptor_is_minimal_and_indexed():
    words = sorted(p + s for p in ("re", "un", "") for s in ("doing", "done", "do"))
    a = sv.Acceptor(words)
    assert a.size[a.root] == len(words) and len(a.size) < sum(map(len, words)) / 2
    for i, w in enumerate(words):
        q, at = a.root, 0
        for c in w:
            q, skip = a.arcs[q][c]
            at += skip
        assert a.final[q] and at == i


@pytest.mark.parametrize("max_chars", [1, 60, 1500, 10**6])
def test_splitting_groups_does_not_change_the_result(spark, max_chars):
    rnd = random.Random(7)
    words = words_over(rnd, "ab", 120) | words_over(rnd, "abcdeé", 150) | words_over(rnd, "ab", 120, (12, 14), "samesame") | {"a" * 7, "a" * 8, "a" * 9, "samesame", "samesamea"}
    counts = {w: rnd.choice([2, 3, 20, 20, 300, 5000]) for w in words}
    got = [tuple(r) for r in sv.group_variants(as_table(spark, counts), max_chars=max_chars).collect()]
    assert len(got) == len(words) and set(got) == plain_groups(counts)


def test_chains_of_forms_end_at_the_root(spark):
    words = {"colouring": 9 * 10**9, "coloring": 9 * 10**7, "colorng": 9 * 10**5, "colorngx": 9 * 10**3, "colorngxy": 90, "colorngxyz": 9, "alone": 2}
    assert {tuple(r) for r in sv.group_variants(as_table(spark, words)).collect()} == plain_groups(words)


def test_documents_equal_plain_version(spark):
    rnd = random.Random(11)
    base = sorted(words_over(rnd, "abcdefghijklmnopqrstuvwxyzéñ", 120))
    rows = [(i, " ".join(rnd.choice(base) + rnd.choice(["", ".", "1", "\n", " -- "]) for _ in range(60)), "x", "y", "z") for i in range(120)]
    rows += [(None, " ".join(base[:30]), None, None, None)] * 2 + [(200, None, "", "", ""), (201, "", "", "", ""), (202, "short words ONÉ ÀÉÎŸ", "", "", ""),
             (203, "L" * 20_000 + " " + "l" * 20_000 + " " + "l" * 20_001, "", "", ""), (204, ("l" * 20_001 + " ") * 3 + "ABCDEFG×÷ abcdefg×÷", "", "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    words = plain_words([(r[0], r[1]) for r in rows])
    got = sv.group_variants(sv.vocabulary(docs)).collect()
    assert {tuple(r) for r in got} == plain_groups(words) and len(got) == len(words)
    assert any(r.form for r in got) and any(r.n_near > 1 for r in got)
    assert [f.dataType.simpleString() for f in sv.group_variants(sv.vocabulary(docs)).schema] == ["string"] * 3 + ["bigint"] * 3


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert sv.group_variants(sv.vocabulary(none)).collect() == []
    assert sv.group_variants(spark.createDataFrame([("oneword", 2)], "word string, n long")).select("root", "n_near").collect()[0] == ("oneword", 0)


def test_damage_can_be_left_out(spark):
    docs = spark.createDataFrame([(i, "undamaged word") for i in range(200)], "doc_id long, text string")
    assert [tuple(r) for r in sv.vocabulary(docs, damaged=0).collect()] == [("undamaged", 200)]
    assert sv.vocabulary(docs).agg(F.sum("n")).first()[0] <= 200 and sv.vocabulary(docs).count() > 1
