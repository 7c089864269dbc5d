"""Operator 13, fill-in-middle transformation with a wavelet matrix over character classes.

A text becomes prefix, middle and suffix, written in the order suffix first or last around three
sentinels (``psm``, ``spm``), or stays as it is (``plain``). Its two cuts are counted in units: code points,
words or lines. The UTF-8 bytes of a slice of texts are mapped to classes (continuation byte, inside of a
word, first of a word, white space, newline) and kept in one wavelet matrix of three bit levels, each with
a count per 64 bits. How many units begin before a byte is a sum of rank queries over the classes that begin
one. Words and lines are of one class, so ``select`` places a cut; a code point begins with any of four
classes, so bisection on the sum of their ranks does. All cuts of a slice are asked at once.

The form and the cuts depend on the id alone (SHA-256 of seed and id), so reruns agree. One map over the
table: no shuffle, and a task holds one slice of ``SLICE`` bytes, or one text if that is longer.

Defined cases: a null text is empty; empty texts and texts that hold a sentinel are plain; a null id hashes as
the empty string; texts of any length are read whole; repeated rows repeat; extra columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .base import map_arrow, pieces, sha256_hex, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, TRANSFORMED_PERCENT, SPM_PERCENT = 1, 90, 20
SLICE = 4 << 20
CONTINUED, INSIDE, WORD_START, SPACE, NEWLINE = range(5)
#: Classes of the byte that a unit begins with (a line: that it ends with).
UNITS = {"char": (INSIDE, WORD_START, SPACE, NEWLINE), "word": (WORD_START,), "line": (NEWLINE,)}


class Bits:
    """A bit vector with rank and select for arrays of positions."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
        packed[:(self.n + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.ones_before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position (0 to n)."""
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.ones_before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the ``k``-th (from 0) bit of this value; it must exist."""
        before = self.ones_before if bit else np.arange(len(self.ones_before)) * 64 - self.ones_before
        word = np.searchsorted(before, k, "right") - 1
        left, value = k - before[word], self.words[word] if bit else ~self.words[word]
        at = np.zeros(len(k), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count((value >> at) & np.uint64((1 << width) - 1)).astype(np.int64)
            right = low <= left
            left = np.where(right, left - low, left)
            at = np.where(right, at + np.uint64(width), at)
        return word * 64 + at.astype(np.int64)


class WaveletMatrix:
    """Rank and select of every class of a sequence of classes below ``2 ** levels``."""

    def __init__(self, classes: np.ndarray, levels: int = 3):
        self.n, self.levels, self.bits, self.zeros = len(classes), levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (classes >> level & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(self.n - int(bit.sum()))
            classes = np.concatenate([classes[~bit], classes[bit]])

    def _down(self, cls: int, at: np.ndarray) -> np.ndarray:
        for i, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            ones = bits.rank1(at)
            at = zeros + ones if cls >> (self.levels - 1 - i) & 1 else at - ones
        return at

    def rank(self, cls: int, at: np.ndarray) -> np.ndarray:
        """Members of the class before each position."""
        return self._down(cls, at) - self._down(cls, np.zeros(1, np.int64))

    def select(self, cls: int, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th (from 0) member of the class; it must exist."""
        at = self._down(cls, np.zeros(1, np.int64)) + k
        for i in range(self.levels - 1, -1, -1):
            bit = cls >> (self.levels - 1 - i) & 1
            at = self.bits[i].select(at - self.zeros[i] if bit else at, bit)
        return at


def classes_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte; ``starts`` are the first bytes of the texts."""
    out = np.full(len(data), INSIDE, np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    opens = np.ones(len(data), bool)
    opens[1:] = white[:-1]
    opens[starts[starts < len(data)]] = True
    out[opens] = WORD_START
    out[(data & 0xC0) == 0x80] = CONTINUED
    out[white] = SPACE
    out[data == 10] = NEWLINE
    return out


class Boundaries:
    """The units of texts that lie one after another in ``data``, text i from ``edges[i]`` to ``edges[i + 1]``."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, unit: str):
        self.matrix, self.unit = WaveletMatrix(classes_of(data, edges[:-1])), unit
        self.lo, self.hi = edges[:-1], edges[1:]
        self.before = self.count(self.lo)
        self.n = self.count(self.hi) - self.before
        if unit == "line":  # a last line without a newline
            filled = self.hi > self.lo
            self.n += filled & (data[np.maximum(self.hi - 1, 0)] != 10) if len(data) else 0

    def count(self, at: np.ndarray, unit: str | None = None) -> np.ndarray:
        return sum(self.matrix.rank(c, at) for c in UNITS[unit or self.unit])

    def place(self, k: np.ndarray) -> np.ndarray:
        """Byte at which the first ``k[i]`` units of text i end and the next one begins."""
        out = np.where(k <= 0, self.lo, self.hi)
        inner = np.flatnonzero((k > 0) & (k < self.n))
        target = self.before[inner] + k[inner]
        if self.unit == "word":
            out[inner] = self.matrix.select(WORD_START, target)
        elif self.unit == "line":
            out[inner] = self.matrix.select(NEWLINE, target - 1) + 1
        else:  # the last byte with no more than ``target`` code points before it
            lo, hi = self.lo[inner], self.hi[inner]
            while (open_ := lo < hi).any():
                mid = (lo + hi + 1) >> 1
                low = self.count(mid) <= target
                lo, hi = np.where(open_ & low, mid, lo), np.where(open_ & ~low, mid - 1, hi)
            out[inner] = lo
        return out


def _word32(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def fill_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", seed: int = SEED,
                transformed_percent: int = TRANSFORMED_PERCENT, spm_percent: int = SPM_PERCENT,
                sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), slice_bytes: int = SLICE) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): units of the text, its form, the code points of
    prefix and middle (null if plain) and the transformed text."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    pre, suf, mid = (s.encode() for s in sentinels)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), whole.alias("whole"),
                       F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias("digest"))
    plain = (F.col("whole") == "") | (_word32(F.col("digest"), 2) % 100 >= transformed_percent)
    for s in sentinels:
        plain = plain | F.contains("whole", F.lit(s))
    form = F.when(plain, "plain").when(_word32(F.col("digest"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("id", "whole", form.alias("form"), _word32(F.col("digest"), 0).alias("h1"), _word32(F.col("digest"), 1).alias("h2"))

    def cut(batches):
        for wide in batches:
            for b in _slices(wide, slice_bytes):
                texts = b.column(1).cast(pa.large_binary())
                edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
                raw = memoryview(texts.buffers()[2] or b"")[edges[0]:edges[-1]]
                units = Boundaries(np.frombuffer(raw, np.uint8), edges - edges[0], unit)
                forms = b.column(2).to_pylist()
                h1, h2 = (b.column(i).to_numpy() % (units.n + 1) for i in (3, 4))
                first, second = units.place(np.minimum(h1, h2)), units.place(np.maximum(h1, h2))
                at = [units.count(x, "char") for x in (units.lo, first, second)]
                plain_rows = np.array([f == "plain" for f in forms], bool)
                out = []
                for f, lo, x, y, hi in zip(forms, units.lo, first, second, units.hi):
                    if f == "plain":
                        out.append(bytes(raw[lo:hi]))
                    elif f == "psm":
                        out.append(b"".join((pre, raw[lo:x], suf, raw[y:hi], mid, raw[x:y])))
                    else:
                        out.append(b"".join((suf, raw[y:hi], pre, raw[lo:x], mid, raw[x:y])))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(units.n.astype(np.int64)), b.column(2), pa.array(at[1] - at[0], pa.int64(), mask=plain_rows),
                     pa.array(at[2] - at[1], pa.int64(), mask=plain_rows), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", key)


def _slices(batch: pa.RecordBatch, most: int):
    """The batch in slices of at most ``most`` bytes of text, or of one row."""
    for b in pieces((batch,)):
        ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield b.slice(at, to - at)
            at = to


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text an output was made of: its parts are told by the first sentinel of each kind after its opening one."""
    pre, suf, mid = sentinels

    def parts(opening: str, between: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(opening) + 1))
        one = F.substring_index(rest, between, 1)
        rest = F.substr(rest, F.length(one) + len(between) + 1)
        two = F.substring_index(rest, mid, 1)
        return one, two, F.substr(rest, F.length(two) + len(mid) + 1)

    prefix, suffix, middle = parts(pre, suf)
    suffix2, prefix2, middle2 = parts(suf, pre)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output)


def q_fill_middle(spark, sf_dir):
    rows = fill_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256_hex(F.col("output")).alias("output_sha256"),
                       sha256_hex(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
     w AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
                  CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
     f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                          WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form, least(c1, c2) AS a, greatest(c1, c2) AS b FROM w),
     p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
