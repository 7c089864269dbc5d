"""Operator 11, spelling variant grouping by finite-state composition.

Two words are near if one edit (a code point inserted, deleted or replaced) turns one into the other. The pairs are
those accepted by the composition A . T . A of the minimised acceptor A of the vocabulary, the transducer T of exactly
one edit, and A again. Before the edit both words take the same arcs, so the composition is enumerated per initial
state: all words that share a prefix, from the state that prefix leads to.

- A group of words with a common prefix is enumerated in one task: its minimal acceptor is built from the sorted
  words, and pairs are kept as index pairs (an index is the number of smaller words the acceptor accepts), so a
  state that several prefixes share is composed once. At a state the edit is spent on two of its arcs (replace), or
  on one arc that the other side skips (insert, delete); the rest of both words is in the intersection of the two right
  languages.
- A group of more than ``max_chars`` code points is split at its initial state, the end of its longest common prefix: the
  edit arcs that leave it become an equality join on the rest of the word (at most one partner a letter of the
  alphabet), and each match arc leads to a group of its own. That repeats until every group is small, so a prefix
  with a third of all words is no larger a task than any other.

An insertion that several positions explain is accepted at the last of them only, so each pair is found once.
A word's form is its near word of largest count, if that is ``FACTOR`` times its own; the root follows the forms by
pointer jumping (counts grow tenfold a step, so five rounds reach the end of any chain).

Defined cases: a null text has no words; a null id hashes as the empty string; words of any length count; ties go to the
word first in code point order; extra columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import map_arrow, spread_join, stored, table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT, FACTOR, DAMAGED = 7, 2, 10, 31
MAX_CHARS = 200_000
#: Separates prefix and rest in a join key; no word holds it.
GAP = "\x01"


# ------------------------------------------------------------------ the acceptor and its composition
class Acceptor:
    """Minimal acyclic acceptor of ascending distinct words. States are numbered children first; a state's
    right language is indexed in code point order."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.size: list[int] = []  # words of the right language
        self.arcs: list[dict[str, tuple[int, int]]] = []  # character -> (state, index of the first word behind the arc)
        self.lengths: list[int] = []  # lengths of those words, modulo 64, as a bit set
        known: dict[tuple, int] = {}
        path: list[tuple[list, list]] = [([], [])]  # open states: characters, closed targets
        ends = [False]

        def close() -> int:
            (chars, targets), final = path.pop(), ends.pop()
            key = (final, *chars, *targets)
            if (state := known.get(key)) is None:
                state = known[key] = len(self.size)
                at, arcs, lengths = int(final), {}, 0
                for c, t in zip(chars, targets):
                    arcs[c] = (t, at)
                    at += self.size[t]
                    lengths |= self.lengths[t]
                self.final.append(final)
                self.size.append(at)
                self.arcs.append(arcs)
                self.lengths.append((lengths << 1 | lengths >> 63) & (1 << 64) - 1 | final)
            return state

        last = ""
        for w in words:
            n = 0
            for a, b in zip(last, w):
                if a != b:
                    break
                n += 1
            while len(path) - 1 > n:
                state = close()
                path[-1][1].append(state)
            for c in w[n:]:
                path[-1][0].append(c)
                path.append(([], []))
                ends.append(False)
            ends[-1] = True
            last = w
        while len(path) > 1:
            state = close()
            path[-1][1].append(state)
        self.root = close()

    def common(self, s: int, t: int, u: int, v: int, out: list) -> None:
        """Adds to ``out`` the words in the right languages of both states: (u + index in s, v + index in t, how many
        in a row)."""
        final, arcs, lengths, todo = self.final, self.arcs, self.lengths, [(s, t, u, v)]
        while todo:
            s, t, u, v = todo.pop()
            if s == t:
                out.append((u, v, self.size[s]))
                continue
            if final[s] and final[t]:
                out.append((u, v, 1))
            one, two = arcs[s], arcs[t]
            if len(one) <= len(two):
                for c, (x, i) in one.items():
                    if (other := two.get(c)) is not None and lengths[x] & lengths[other[0]]:
                        todo.append((x, other[0], u + i, v + other[1]))
            else:
                for c, (y, j) in two.items():
                    if (other := one.get(c)) is not None and lengths[other[0]] & lengths[y]:
                        todo.append((other[0], y, u + other[1], v + j))

    def edited_here(self, q: int) -> list:
        """Pairs whose edit is the first thing that happens after state ``q``."""
        out: list = []
        arcs, final = self.arcs, self.final
        own = list(arcs[q].items())
        for i, (a, (s, u)) in enumerate(own):
            for _, (t, v) in own[i + 1:]:  # replaced
                if self.lengths[s] & self.lengths[t]:
                    self.common(s, t, u, v, out)
            if final[q] and final[s]:  # deleted, nothing follows
                out.append((u, 0, 1))
            for c, (x, j) in arcs[s].items():  # deleted, and the next character is another one
                if c != a and (other := arcs[q].get(c)) is not None and self.lengths[x] & self.lengths[other[0]]:
                    self.common(x, other[0], u + j, other[1], out)
        return out

    def one_edit_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of the composition, each once, as indices of words."""
        none = np.zeros((2, 0), np.int64)
        found: list[np.ndarray] = []
        for q in range(len(self.size)):
            parts = [found[t] + i for t, i in self.arcs[q].values() if found[t].shape[1]]
            if len(self.arcs[q]) > 1 or self.final[q]:
                here = self.edited_here(q)
                if here:
                    u, v, n = np.array(here, np.int64).T
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    parts.append(np.stack([np.repeat(u, n) + step, np.repeat(v, n) + step]))
            found.append(none if not parts else parts[0] if len(parts) == 1 else np.concatenate(parts, 1))
        return found[self.root][0], found[self.root][1]


NEAR = "word string, n_near long, best_n long, best string"


def _compose(batches):
    """Rows (prefix, word, n) sorted by prefix and word -> near counts and best near words of every word that has any."""
    def done(words: list[str], counts: list[int]):
        x, y = Acceptor(words).one_edit_pairs()
        if not len(x):
            return None
        n = np.array(counts, np.int64)
        x, y = np.concatenate([x, y]), np.concatenate([y, x])
        order = np.lexsort((y, -n[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        text = pa.array(words, pa.string())
        return pa.RecordBatch.from_arrays([text.take(pa.array(x[first])), pa.array(np.diff(np.r_[first, len(x)])), pa.array(n[y[first]]), text.take(pa.array(y[first]))],
                                          names=["word", "n_near", "best_n", "best"])

    now, words, counts = None, [], []
    for b in batches:
        for prefix, word, n in zip(*(c.to_pylist() for c in b.columns)):
            if prefix != now:
                if len(words) > 1 and (out := done(words, counts)):
                    yield out
                now, words, counts = prefix, [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1 and (out := done(words, counts)):
        yield out


def _common_prefix(lo: Column, hi: Column) -> Column:
    """Length of the common prefix of two texts."""
    at = F.sequence(F.lit(1), F.least(F.length(lo), F.length(hi)))
    differs = F.filter(at, lambda i: F.substr(lo, i, F.lit(1)) != F.substr(hi, i, F.lit(1)))
    shortest = F.least(F.length(lo), F.length(hi))
    return F.when(shortest == 0, 0).otherwise(F.coalesce(F.array_min(differs) - 1, shortest))


def _edits_at(words: DataFrame) -> DataFrame:
    """Near words whose edit comes right after the first ``cut`` code points, for rows (word, n, cut): the words
    that are equal but for one code point there meet under what is left, as does the word without it."""
    head, rest = F.substr("word", F.lit(1), F.col("cut")), F.substr("word", F.col("cut") + 1)
    letter, after = F.substr(rest, F.lit(1), F.lit(1)), F.substr(rest, F.lit(2))
    member = lambda c: F.struct("n", "word", c.alias("letter"))
    rows = words.select(F.concat(head, F.lit(GAP), rest).alias("key"), member(F.lit("")).alias("m")).union(
        words.filter("length(word) > cut").select(F.concat(head, F.lit(GAP), after).alias("key"), member(letter).alias("m")))
    met = rows.groupBy("key").agg(F.collect_list("m").alias("ms")).filter("size(ms) > 1")
    each = met.select(F.substring_index("key", GAP, -1).alias("rest"), "ms", F.explode("ms").alias("x")).select("rest", "x", F.explode("ms").alias("y"))
    # the word without the code point is met only where the next one differs; otherwise the pair is found later in the word
    first = F.substr("rest", F.lit(1), F.lit(1))
    near = (F.col("x.letter") != F.col("y.letter")) & ((F.greatest("x.letter", "y.letter") != first) | (F.least("x.letter", "y.letter") != ""))
    return each.filter(near).select(F.col("x.word").alias("word"), F.lit(1).cast("long").alias("n_near"), F.col("y.n").alias("best_n"), F.col("y.word").alias("best"))


def near_words(words: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """(word, n_near, best_n, best): the number of near words of each word that has any, and the one of largest count.
    ``words``: (word, n), distinct."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    live, small, split = words.select("word", "n", F.substr("word", F.lit(1), F.lit(0)).alias("prefix")), [], []
    while True:
        groups = stored(live.groupBy("prefix").agg(F.count("*").alias("members"), F.sum(F.length("word")).alias("chars"), F.min("word").alias("lo"), F.max("word").alias("hi"))
                        .filter("members > 1").select("prefix", (F.col("chars") > max_chars).alias("large"), _common_prefix(F.col("lo"), F.col("hi")).alias("cut")), "groups")
        if groups.isEmpty():
            break
        placed = stored(spread_join(live, groups, "prefix"), "placed")
        small.append(placed.filter("not large").select("prefix", "word", "n"))
        if groups.filter("large").isEmpty():
            break
        large = placed.filter("large").select("word", "n", "cut")
        split.append(_edits_at(large))
        live = large.filter("length(word) > cut").select("word", "n", F.substr("word", F.lit(1), F.col("cut") + 1).alias("prefix"))
    found = []
    for some in small:
        found.append(map_arrow(some.repartition(parts, "prefix").sortWithinPartitions("prefix", "word"), _compose, NEAR))
    found += split
    if not found:
        return words.sparkSession.createDataFrame([], NEAR)
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    best = F.min(F.struct((-F.col("best_n")).alias("down"), "best"))
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.down")).alias("best_n"), F.col("b.best").alias("best"))


# ------------------------------------------------------------------ words, forms, roots
def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
               damaged: int = DAMAGED) -> DataFrame:
    """(word, n): the words of all texts. Where the checksum of id and word is a multiple of ``damaged``, the word
    counts without one code point, at a place the checksum names (0: no word is changed)."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= min_chars).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if damaged:
        h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % damaged == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(word)
    words = runs.select(word.alias("word"))
    return words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``: the last word that following the forms leads to; ``word`` itself without a form."""
    step = stored(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(spread_join(step, ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.filter("moved").isEmpty():
            break
        step = step.drop("moved")
    return forms.join(step.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(words: DataFrame, factor: int = FACTOR, max_chars: int = MAX_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n), distinct."""
    near = near_words(words, max_chars)
    has = F.col("best_n") >= factor * F.col("n")
    forms = stored(words.join(near, "word", "left").select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                           F.when(has, F.col("best_n")).alias("form_n")), "forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def q_spelling_variants(spark, sf_dir):
    return group_variants(stored(vocabulary(table(spark, sf_dir, "documents")), "vocabulary"))
