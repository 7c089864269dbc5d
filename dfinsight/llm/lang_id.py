"""Operator 10, language identification: words first, character n-grams for words never seen.

A word known from training votes with its per-language log frequency. An unknown word is cut into
character n-grams (padded at both ends); the longest order with a known n-gram votes, so the score
falls back from long n-grams to short ones. The votes of a word are normalised over the languages
(a log posterior, floored), so known and unknown words are on one scale. Frequencies are smoothed towards
the entry's frequency in all languages, and votes towards none by how often the entry occurs, so a
language without evidence gains nothing. Words are runs of letters with their combining marks. A run of more than 64 letters, as
in scripts written without spaces, is cut into slices of 64 letters that overlap by three; each slice
votes like a word, so every letter and every n-gram of the run counts. In training the n-grams of such a
run are counted over the whole run, and its slices are its words.

The model is fitted on at most about ``max_docs_per_lang`` documents of each language, chosen by a
hash; its tables hold at most ``max_words`` words and ``max_grams`` n-grams, so its size is bounded
and it is broadcast. Every language has the same share of a table for its own most frequent entries; what
the shares leave free goes to the most frequent ones of all. Any number of labels can be learned: an entry holds votes only
for the languages it occurs in, and a label none of whose words is in the tables is left out. Every document
is then scored in one map over the table: no shuffle.

Defined cases: null text or a text without letters gives ``und`` with score 0; no training rows at
all give ``und`` for every document; ties go to the language first in code point order; a null id
counts as the empty text for the split; extra columns are ignored; repeated rows are repeated.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .base import free_name, map_arrow, pieces, stored, table, without

UNDETERMINED = "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MAX_DOCS_PER_LANG, MAX_WORDS, MAX_GRAMS, ORDER = 3000, 120_000, 60_000, 4
FLOOR, CACHE = -6.0, 500_000
#: Occurrences that count for the frequency in all languages, in a language's own; and for no vote at all, in an entry's.
POOLED, UNSURE = 1000.0, 0.5
#: Letters of a slice; the mark of a cut, where a slice has no padding; letters of long runs a task holds before it counts them.
SLICE, CUT, HELD_LETTERS = 64, "\x04", 500_000


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a padded word or slice, none across a cut; order 1 leaves the padding out."""
    own = word.strip(CUT)
    padded = own if n == 1 else ("" if word[0] == CUT else "\x02") + own + ("" if word[-1] == CUT else "\x03")
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def slices(words) -> list[str]:
    """The words, those longer than a slice cut into slices that together hold every n-gram."""
    out = []
    for w in words:
        if len(w) <= SLICE:
            out.append(w)
            continue
        for at in range(0, len(w) - ORDER + 1, SLICE - ORDER + 1):
            end = at + SLICE
            out.append((CUT if at else "") + w[at:end] + (CUT if end < len(w) else ""))
    return out


def _count_grams(batches):
    """Per task: (lang, order, gram, count), order 0 for whole words; n-grams of distinct words weigh
    as often as the word occurs."""
    def out(words: dict[str, Counter]):
        rows: tuple[list, list, list, list] = ([], [], [], [])
        for lang, count in words.items():
            per = [Counter() for _ in range(ORDER + 1)]
            for w, c in count.items():
                for x in slices((w,)):
                    per[0][x] += c
                for n in range(1, ORDER + 1):
                    for g in grams_of(w, n):
                        per[n][g] += c
            for n, each in enumerate(per):
                for lst, part in zip(rows, ([lang] * len(each), [n] * len(each), each.keys(), each.values())):
                    lst.extend(part)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()),
                                           pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int64())],
                                          names=["lang", "n", "gram", "c"])

    held: dict[str, Counter] = {}
    letters = 0
    for batch in pieces(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = LETTERS.findall((text or "").lower())
            held.setdefault(lang, Counter()).update(words)
            letters += sum(n for n in map(len, words) if n > SLICE)
            if sum(map(len, held.values())) > 60_000 or letters > HELD_LETTERS:
                yield out(held)
                held, letters = {}, 0
    if held:
        yield out(held)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
        max_docs_per_lang: int = MAX_DOCS_PER_LANG, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> dict:
    """Fit on rows with a label. Returns the bounded model (languages, grams, normalised votes)."""
    rows = labelled.filter(F.col(label).isNotNull()).select(F.col(text).alias("t"), F.col(label).alias("l"), F.col(key).alias("k"))
    counts = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}  # one row a label, as the model holds
    if not counts:
        return {"langs": [], "tables": [_votes([], np.zeros(1, np.int64), [], np.zeros(0), 0)] * (ORDER + 1)}
    share = F.create_map([x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(min(1.0, max_docs_per_lang / n) * (1 << 30))))])
    sample = rows.filter(F.pmod(F.xxhash64(F.coalesce(F.col("k").cast("string"), F.lit("")), F.lit(10)), F.lit(1 << 30)) < share[F.col("l")])
    found = stored(map_arrow(sample.select("t", "l"), _count_grams, "lang string, n int, gram string, c long").groupBy("n", "gram", "lang")
                   .agg(F.sum("c").alias("c")), "grams")
    parts = [_shared_out(found.filter(part), len(counts), most).toArrow().combine_chunks() for part, most in (("n = 0", max_words), ("n > 0", max_grams))]
    langs = sorted({x for p in parts for x in p["langs"].combine_chunks().flatten().unique().to_pylist()})
    number = {x: i for i, x in enumerate(langs)}
    tables = []
    for n in range(ORDER + 1):
        rows = parts[min(n, 1)]
        rows = rows.filter(pa.array(rows["n"].to_numpy() == n))
        own, c = (rows[x].combine_chunks() for x in ("langs", "counts"))
        starts = np.concatenate([[0], np.cumsum(own.value_lengths().to_numpy())]).astype(np.int64)
        tables.append(_votes(rows["gram"].to_pylist(), starts, [number[x] for x in own.flatten().to_pylist()], c.flatten().to_numpy().astype(float), len(langs)))
    return {"langs": langs, "tables": tables}


def _votes(grams: list[str], starts: np.ndarray, langs: list[int], counts: np.ndarray, n_langs: int) -> dict:
    """The entries of one order: entry i votes for ``langs[starts[i]:starts[i + 1]]``, each by how much more than the
    languages it never occurs in, which all get the same."""
    langs, entry = np.array(langs, np.int32), np.repeat(np.arange(len(grams)), np.diff(starts))
    total = np.bincount(entry, counts, len(grams))
    size = np.bincount(langs, counts, n_langs)
    rate = (counts + POOLED * total[entry] / max(1.0, counts.sum())) / (size[langs] + POOLED)
    rate /= np.bincount(entry, rate, len(grams))[entry]
    vote = np.maximum(np.log((rate * total[entry] + UNSURE) / (total[entry] + UNSURE)), FLOOR)
    absent = np.maximum(np.log(UNSURE / (total + UNSURE)), FLOOR)
    return {"grams": grams, "starts": starts, "langs": langs, "votes": (vote - absent[entry]).astype(np.float32)}


def _shared_out(found: DataFrame, n_langs: int, most: int) -> DataFrame:
    """(n, gram, langs, counts) of at most ``most`` entries (one a language, if that is more) that occur twice: the most
    frequent of each language up to its share, then those of all."""
    entries = found.groupBy("n", "gram").agg(F.sum("c").alias("total"), F.array_sort(F.collect_list(F.struct("lang", "c"))).alias("own")).filter("total > 1")
    first = W.partitionBy("lang").orderBy(F.desc("c"), "n", "gram")
    kept = (entries.select("n", "gram", F.inline("own")).withColumn("place", F.row_number().over(first))
            .filter(F.col("place") <= max(1, most // n_langs)).select("n", "gram").distinct().withColumn("kept", F.lit(True)))
    best = entries.join(kept, ["n", "gram"], "left").orderBy(F.col("kept").desc_nulls_last(), F.desc("total"), "n", "gram").limit(max(most, n_langs))
    return best.select("n", "gram", F.col("own.lang").alias("langs"), F.col("own.c").alias("counts"))


class Scorer:
    """Scores texts with a model; remembers the votes of the words it has met, up to a bound."""

    def __init__(self, model: dict):
        self.langs, self.tables = model["langs"], model["tables"]
        self.entry = [dict(zip(t["grams"], range(len(t["grams"])))) for t in self.tables]
        self.met: list[dict] = [{} for _ in self.tables]  # votes of the entries met
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.start, self.held = np.zeros(1025, np.int64), 0  # votes of the words met, one after another
        self.lang, self.vote = np.zeros(4096, np.int32), np.zeros(4096, np.float32)

    def votes_of(self, word: str) -> list[tuple[int, float]]:
        """The languages a word votes for, and its votes."""
        if (i := self.entry[0].get(word)) is not None:
            return self._votes(0, i)
        for n in range(ORDER, 0, -1):
            known = [i for i in map(self.entry[n].get, grams_of(word, n)) if i is not None]
            if known:
                total: dict[int, float] = {}
                for i in known:
                    for lang, vote in self._votes(n, i):
                        total[lang] = total.get(lang, 0.0) + vote
                return [(lang, vote / len(known)) for lang, vote in total.items()]
        return []

    def _votes(self, n: int, i: int) -> list[tuple[int, float]]:
        held = self.met[n].get(i)
        if held is None:
            t = self.tables[n]
            lo, hi = t["starts"][i:i + 2]
            held = self.met[n][i] = list(zip(t["langs"][lo:hi].tolist(), t["votes"][lo:hi].tolist()))
        return held

    def row_of(self, word: str) -> int:
        i = self.seen.get(word)
        if i is None:
            i = self.seen[word] = len(self.seen)
            votes = self.votes_of(word)
            end = self.held + len(votes)
            if i + 2 > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            while end > len(self.lang):
                self.lang, self.vote = (np.concatenate([x, np.zeros_like(x)]) for x in (self.lang, self.vote))
            for lang, vote in votes:
                self.lang[self.held], self.vote[self.held] = lang, vote
                self.held += 1
            self.start[i + 1] = end
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        if max(map(len, words)) > SLICE:
            words = slices(words)
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), 65536):
            if len(self.seen) > CACHE or self.held > 8 * CACHE:
                self.forget()
            total += self.total_of(words[at:at + 65536])
        p = np.exp(total - total.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())

    def total_of(self, words: list[str]) -> np.ndarray:
        get = self.seen.get
        idx = np.array([i if (i := get(w)) is not None else self.row_of(w) for w in words])
        lo, n = self.start[idx], self.start[idx + 1] - self.start[idx]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.lang[at], self.vote[at], len(self.langs))


def predict(docs: DataFrame, model: dict, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the predicted language and its posterior; columns of these names are replaced."""
    docs = without(docs, pred, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), [pred, score]

    def run(batches):
        scorer = Scorer(shared.value)
        for b in pieces(batches):
            got = [scorer.predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             names=[*b.schema.names, *names])

    schema = docs.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score)).schema
    return map_arrow(docs, run, schema)


def is_held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def q_lang_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


#: A document goes when its language cannot be told or the posterior is below this.
MIN_SCORE = 0.5


def stage_lang_id(spark, docs, sf_dir):
    """Pipeline stage: documents whose language cannot be told, or only with a posterior below 0.5, go."""
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))))
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    return (predict(docs, model, pred=pred, score=score)
            .filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= MIN_SCORE)).select(*[f"`{c}`" for c in docs.columns]))
