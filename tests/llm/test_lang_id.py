"""Operator 10 against a plain scorer over whole counts; labels without words, many labels, letters and marks."""

from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dfinsight.llm import lang_id

SCHEMA = "doc_id long, text string, lang string"


def plain_words(text):
    out, now = [], ""
    for c in (text or "").lower() + " ":
        kind = unicodedata.category(c)[0]
        if kind == "L" or kind == "M" and now:
            now += c
        elif now:
            out.append(now)
            now = ""
    return out


def plain_model(rows):
    """{order: {gram: {lang: vote}}}, absent languages under None."""
    count = defaultdict(lambda: defaultdict(Counter))
    for text, lang in rows:
        for w in plain_words(text):
            count[0][w][lang] += 1
            for n in range(1, lang_id.ORDER + 1):
                p = w if n == 1 else f"\x02{w}\x03"
                for i in range(len(p) - n + 1):
                    count[n][p[i:i + n]][lang] += 1
    votes = {}
    for n, grams in count.items():
        grams = {g: c for g, c in grams.items() if sum(c.values()) > 1}
        size, every = Counter(), sum(sum(c.values()) for c in grams.values())
        for c in grams.values():
            size.update(c)
        votes[n] = {}
        for g, c in grams.items():
            total = sum(c.values())
            rate = {x: (k + lang_id.POOLED * total / every) / (size[x] + lang_id.POOLED) for x, k in c.items()}
            log = lambda share: max(lang_id.FLOOR, math.log((share * total + lang_id.UNSURE) / (total + lang_id.UNSURE)))
            votes[n][g] = {x: log(r / sum(rate.values())) for x, r in rate.items()} | {None: log(0)}
    return votes


def plain_predict(votes, text):
    langs = sorted({x for t in votes.values() for v in t.values() for x in v if x is not None})
    words = plain_words(text)
    if not words:
        return "und", 0.0
    total = dict.fromkeys(langs, 0.0)
    for w in words:
        found = [votes[0][w]] if w in votes[0] else []
        for n in range(lang_id.ORDER, 0, -1):
            p = w if n == 1 else f"\x02{w}\x03"
            found = found or [votes[n][p[i:i + n]] for i in range(len(p) - n + 1) if p[i:i + n] in votes[n]]
        for x in langs:
            total[x] += sum(v.get(x, v[None]) for v in found) / max(1, len(found))
    best = min(langs, key=lambda x: (-total[x], x))
    return best, 1 / sum(math.exp(t - total[best]) for t in total.values())


def texts(rnd, letters, n):
    words = ["".join(rnd.choices(letters, k=rnd.randint(2, 7))) for _ in range(40)]
    return [" ".join(rnd.choices(words, k=rnd.randint(1, 25))) for _ in range(n)]


def test_scores_equal_the_plain_scorer(spark):
    rnd = random.Random(2)
    rows = [(t, lang) for lang, letters, n in (("aa", "abcdé", 30), ("bb", "cdefß", 25), ("cc", "हिन्दीक", 8), ("dd", "dexyz", 3)) for t in texts(rnd, letters, n)]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], SCHEMA)
    asked = [t for letters in ("abcdé", "cdefß", "हिन्दीक", "dexyz", "qrs", "abxyz") for t in texts(rnd, letters, 12)] + [None, "", "½ ① ² Ⅷ 12", "don't", "É"]
    votes = plain_model(rows)
    got = lang_id.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), lang_id.fit(docs)).collect()
    for r in got:
        lang, score = plain_predict(votes, asked[r.doc_id])
        assert r.score == pytest.approx(score, rel=1e-3, abs=1e-4)
        assert r.lang_pred == lang or score < .51


def test_letters_and_marks():
    assert lang_id.LETTERS.findall("½ ① ² Ⅷ _ 12 ́") == []
    assert lang_id.LETTERS.findall("हिन्दी สวัสดี naïve naïve") == ["हिन्दी", "สวัสดี", "naïve", "naïve"]
    for text in ("हिन्दी", "สวัสดีครับ", "ünïcödé", "a½b", "́a", "x_y1z"):
        assert lang_id.LETTERS.findall(text) == plain_words(text)


def test_labels_without_words_never_win(spark):
    rnd = random.Random(4)
    rows = [(t, "aa") for t in texts(rnd, "abcde", 20)] + [(t, "bb") for t in texts(rnd, "cdefg", 20)]
    more = rows + [("123 ...", "empty"), (None, "empty"), ("½", "empty")]
    models = [lang_id.fit(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(some)], SCHEMA)) for some in (rows, more)]
    assert models[0]["langs"] == models[1]["langs"] == ["aa", "bb"]
    asked = texts(rnd, "abcdefgq", 60)
    one, two = (list(map(lang_id.Scorer(m).predict, asked)) for m in models)
    assert one == two


def test_a_label_of_few_words_does_not_take_those_of_others(spark):
    rnd = random.Random(5)
    common = ["the", "and", "house", "garden", "water"]
    rows = [(" ".join(rnd.choices(common, k=60)), "aa") for _ in range(40)] + [("the the", "tiny"), ("and", "tiny")]
    model = lang_id.fit(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], SCHEMA))
    assert lang_id.Scorer(model).predict("the house and the garden")[0] == "aa"


def test_any_number_of_labels_is_learned(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(1300):
        own = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9))
        rows.append((i, f"{own} {own}", f"l{i:04d}"))
    df = spark.createDataFrame(rows, SCHEMA)
    model = lang_id.fit(df)
    assert len(model["langs"]) == 1300
    assert lang_id.predict(df, model).filter(F.col("lang_pred") == F.col("lang")).count() == 1300
