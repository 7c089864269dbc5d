"""Operator 4 on writing other than Latin; operator 9 on documents without ids or under one id."""

from __future__ import annotations

from pyspark.sql import functions as F

from dfinsight.llm import line_quality, source_mix


def test_sentences_of_other_scripts_are_kept(spark):
    arabic = "هذا نص قصير جدا عن الكتب القديمة في المدينة الكبيرة، هل قرأته؟\nيحب الناس قراءة الكتب في المساء قرب النهر هناك؟"
    urdu = "یہ ایک مختصر متن ہے جو پرانی کتابوں کے بارے میں ہے۔\nلوگ شام کو دریا کے کنارے کتابیں پڑھنا پسند کرتے ہیں۔"
    hindi = "यह पुरानी किताबों के बारे में एक छोटा पाठ है।\nलोग शाम को नदी के किनारे किताबें पढ़ना पसंद करते हैं।"
    japanese = "これ は 古い 本 に ついて の 短い 文章 です！\n人々 は 夕方 に 川 の そば で 本 を 読む？"
    plain = "this line has many words but never ends as sentences do\nand neither does the other line of the very same text"
    texts = [arabic, urdu, hindi, japanese, plain]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.n_lines_removed) for r in line_quality.clean_lines(df).collect()}
    assert got == {0: (True, 0), 1: (True, 0), 2: (True, 0), 3: (True, 0), 4: (False, 2)}


def test_keys_without_ids_spread(spark):
    for key in (None, 7):
        df = spark.range(4000).select(F.lit(key).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"), F.lit("s").alias("source"))
        keys = df.select(F.substring(source_mix.random_key(F.col("doc_id"), F.col("text")), 1, source_mix.RANGE_DIGITS).alias("r"))
        assert keys.distinct().count() > 2000
        assert source_mix.mix(df).agg(F.sum("taken")).first()[0] == 18_000
