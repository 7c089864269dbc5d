r"""Operator 4 [native], line-first cleaning.

Every line of a text is judged by itself: a punctuation rule (sentences end somewhere; symbols do
not crowd out words; lines are not shouted), a navigation rule (separators between short items) and
a boilerplate rule (licence, copyright, cookie and policy notices of a line's length). Lines that
fail are removed; a document that loses more than ``max_lost`` of its words' characters is rejected,
as is one that fails the base rules on its whole text. All work is done inside a row with built-in
functions, so there is no shuffle and no group: partitions are those of the scan.

Repeated words are found by hashing every window of five words (64 bits), and only where a window
repeats are the windows sorted; a very long text costs n log n, never n squared.

Defined cases: null text has no words and is rejected; an empty table gives an empty result; a text
without a failing line keeps its text; lines without a word are neither counted nor judged; every
row is judged by itself, so ties and repeated rows need no rule; extra columns are kept, but for
those called like the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .base import WHITE, WORD, table, without

SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, MAX_LOST, WINDOW = 10, 20, 0.5, 5
# Characters that end a sentence, of Latin, Chinese, Arabic, Urdu, Indian, Armenian, Ethiopian, Khmer, Tibetan and Canadian writing.
SENTENCE_ENDS = ".!?…‼⁇⁈⁉。！？．｡؟۔।॥։።፧፨។།᙮"
SENTENCE = f"[{SENTENCE_ENDS}]"
SEPARATORS = r"[|»›•·]"
BOILERPLATE = (r"(?i)(all rights reserved|licen[sc]ed under|is licen[sc]ed|released under the|copyright (\(c\)|[0-9]{4})"
               r"|privacy policy|terms (of|and) (use|service|conditions)|cookie (policy|settings)|accept (all )?cookies|skip to (main )?content|powered by)")
BOILERPLATE_WORDS = 20


def bare(text: Column) -> Column:
    """The text without the white space that separates words."""
    return F.translate(text, WHITE, "")


def line_facts(line: Column) -> Column:
    """What the rules ask about a line, each counted once: n words, symbols, separators, letters (the line
    without white space, digits and common punctuation)."""
    return F.struct(line.alias("line"), F.regexp_count(line, F.lit(WORD)).alias("n"),
                    (F.length(line) - F.length(F.translate(line, SYMBOLS + "!", ""))).alias("symbols"),
                    F.regexp_count(line, F.lit(SEPARATORS)).alias("separators"),
                    F.translate(line, WHITE + "0123456789.,;:!?'\"()-", "").alias("letters"))


def passes(f: Column) -> Column:
    """The rules of one line that has a word."""
    n, letters = f["n"], f["letters"]
    punctuation = (n < 5) | f["line"].rlike(SENTENCE)
    crowded = (f["symbols"] >= 5) & (f["symbols"] * 2 >= n)
    shouted = (n >= 5) & (F.length(letters) >= 10) & (letters == F.upper(letters)) & (letters != F.lower(letters))
    navigation = (f["separators"] >= 3) & (f["separators"] * 4 >= n)
    boilerplate = (n <= BOILERPLATE_WORDS) & f["line"].rlike(BOILERPLATE)
    return punctuation & ~crowded & ~shouted & ~navigation & ~boilerplate


def repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds the number of words inside a five-word window that occurs twice or more in array ``words``."""
    h, s, p = (f"{out}_{x}" for x in "hsp")
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                          lambda i: F.xxhash64(*(F.get(F.col(words), i + j) for j in range(WINDOW))))
    df = df.withColumn(h, F.when(F.size(words) >= WINDOW, windows))
    # (hash, position) in order, and only for the texts in which a window repeats
    df = df.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    same = lambda e, j: F.coalesce(F.get(F.col(s), j)["x"] == e["x"], F.lit(False))
    at = F.transform(s, lambda e, j: F.when(same(e, j - 1) | same(e, j + 1), e["i"]))
    df = df.withColumn(p, F.sort_array(F.array_compact(at)))
    step = F.transform(p, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(p), j + 1) - v, F.lit(WINDOW))))
    return df.withColumn(out, F.coalesce(F.aggregate(step, F.lit(0), lambda a, v: a + v), F.lit(0)).cast("long")).drop(h, s, p)


def clean_lines(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """All columns of ``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    clean_text, n_lines, n_lines_removed, base_failed, kept; columns of these names are replaced."""
    rest = without(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "n_lines", "n_lines_removed", "base_failed", "kept")
    keep = F.struct(*[F.col(f"`{c}`") for c in rest.columns])
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(keep.alias("_d"), t.alias("_t"))
    df = df.withColumn("_words", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    df = df.withColumn("_facts", F.transform(F.split("_t", "\n", -1), line_facts))
    df = df.withColumn("_full", F.filter("_facts", lambda f: f["n"] > 0)["line"])
    df = repeated_words(df, "_words", "_repeat")
    df = df.withColumn("_kept", F.filter("_facts", lambda f: (f["n"] == 0) | passes(f))["line"])
    df = df.withColumn("_chars", F.length(bare(F.col("_t"))).cast("long")).withColumn("_clean", F.array_join("_kept", "\n"))
    base = (F.size("_words") < MIN_WORDS) | (100 * F.col("_repeat") > REPEAT_PERCENT * F.size("_words"))
    lost = F.col("_chars") - F.length(bare(F.col("_clean")))
    return df.select("_d.*", F.size("_words").cast("long").alias("n_words"), F.col("_chars").alias("word_chars"),
                     (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                     (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
                     F.col("_repeat").alias("n_repeat_words"), F.col("_clean").alias("clean_text"),
                     F.size("_full").cast("long").alias("n_lines"), (F.size("_facts") - F.size("_kept")).cast("long").alias("n_lines_removed"),
                     base.alias("base_failed"), (~base & (lost <= max_lost * F.col("_chars"))).alias("kept"))


def q_line_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "n_lines", "n_lines_removed", "base_failed", "kept")


_LINE_OK = rf"""(n < 5 OR regexp_matches(line, '{SENTENCE}'))
  AND NOT (sym >= 5 AND sym * 2 >= n)
  AND NOT (n >= 5 AND length(letters) >= 10 AND letters = upper(letters) AND letters <> lower(letters))
  AND NOT (sep >= 3 AND sep * 4 >= n)
  AND NOT (n <= {BOILERPLATE_WORDS} AND regexp_matches(line, '{BOILERPLATE}'))"""

ORACLE = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w,
                 generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM docs),
windows AS (SELECT doc_id, i, w, CASE WHEN lead(w, 4) OVER q IS NULL THEN NULL ELSE
              concat_ws(chr(31), w, lead(w, 1) OVER q, lead(w, 2) OVER q, lead(w, 3) OVER q, lead(w, 4) OVER q) END AS g
            FROM words WINDOW q AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS r FROM windows),
covered AS (SELECT doc_id, bool_or(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM again),
reps AS (SELECT doc_id, count(*) AS n, CAST(count_if(c) AS BIGINT) AS rep FROM covered GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
facts AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, regexp_replace(line, '[\x20\x09-\x0D]', '', 'g') AS body,
                 len(regexp_extract_all(line, '[#*$%&|<>!]')) AS sym, len(regexp_extract_all(line, '[|\x{{00BB}}\x{{203A}}\x{{2022}}\x{{00B7}}]')) AS sep,
                 regexp_replace(line, '[\x20\x09-\x0D0-9.,;:!?''"()-]', '', 'g') AS letters FROM lines),
judged AS (SELECT *, ({_LINE_OK}) AS ok FROM facts WHERE body <> ''),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, CAST(count_if(NOT ok) AS BIGINT) AS gone,
               CAST(sum(CASE WHEN ok THEN 0 ELSE length(body) END) AS BIGINT) AS lost FROM judged GROUP BY doc_id),
base AS (SELECT d.doc_id, coalesce(r.n, 0) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(p.dup, 0) AS n_dup_lines, coalesce(r.rep, 0) AS n_repeat_words,
                coalesce(p.n_lines, 0) AS n_lines, coalesce(p.gone, 0) AS n_lines_removed, coalesce(p.lost, 0) AS lost
         FROM docs d LEFT JOIN reps r USING (doc_id) LEFT JOIN per p USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_lines_removed,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AND lost <= {MAX_LOST} * word_chars AS kept
FROM base
"""
