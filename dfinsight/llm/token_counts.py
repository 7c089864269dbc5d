"""Operator 1, token counts by offset-mapped attribution.

Every document is encoded whole, once. Each token's bytes are mapped back to the characters they came
from, and the token spans are interval-joined to the document's sections (sentences, fields or any list of
disjoint spans). A token inside one section counts there. A token that crosses a border counts once,
for the section that holds most of its characters, the earlier one on a tie; a token that meets no
section is reported under section -1. So the counts of a document always add up to its token count.

The join runs inside the row: both interval lists belong to one document, so binary search over the
sorted section borders replaces a shuffle. A token that holds part of a character covers it whole.

Defined cases: a null or empty text has one empty section of 0 tokens; an empty section counts 0;
a text of any length is encoded whole; every row is counted by itself, so repeated rows repeat; extra
columns are ignored; an empty table gives an empty result. Sections must be disjoint and ascending.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from .base import map_arrow, pieces, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
OUTSIDE = -1
SENTENCE_END = re.compile(r"[.!?…。]\s+")


class Offsets:
    """Encodes texts and maps tokens to character spans."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("offsets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            self.lengths[i] = len(t)

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end (exclusive) of every token."""
        ends = np.cumsum(self.lengths[self.ids(text)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if text.isascii():
            return starts, ends
        first = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80  # bytes that begin a character
        char = np.cumsum(first)  # of each byte, counted from 1
        return char[starts] - 1, char[ends - 1]


def attribute(starts, ends, sec_start, sec_end) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token (OUTSIDE if none) and whether it meets more than one."""
    if not len(sec_start):
        return np.full(len(starts), OUTSIDE), np.zeros(len(starts), bool)
    first = np.searchsorted(sec_end, starts, "right")  # first section that ends after the token begins
    last = np.searchsorted(sec_start, ends, "left") - 1  # last section that begins before the token ends
    owner = np.where(first <= last, first, OUTSIDE)
    crossing = last > first
    two = np.flatnonzero(last == first + 1)  # the usual case at once
    left = sec_end[first[two]] - np.maximum(starts[two], sec_start[first[two]])
    right = np.minimum(ends[two], sec_end[last[two]]) - sec_start[last[two]]
    owner[two] = np.where(left >= right, first[two], last[two])
    for i in np.flatnonzero(last > first + 1):
        s = np.arange(first[i], last[i] + 1)
        owner[i] = s[np.argmax(np.minimum(ends[i], sec_end[s]) - np.maximum(starts[i], sec_start[s]))]
    return owner, crossing


def sentence_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sentences, each with the white space after it; the first word of the next one begins a section,
    so a token made of a space and a word crosses the border."""
    ends = np.array([*(m.end() for m in SENTENCE_END.finditer(text) if m.end() < len(text)), len(text)], np.int64)
    return np.concatenate([[0], ends[:-1]]), ends


def with_fields(df: DataFrame, fields: list[str], separator: str = "\n") -> DataFrame:
    """Adds ``text`` (the fields joined, null as empty) and ``sections`` (the span of each field)."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    spans, at = [], F.lit(0)
    for v in values:
        spans.append(F.struct(at.alias("start"), (at + F.length(v)).alias("end")))
        at = at + F.length(v) + len(separator)
    return df.withColumns({"text": F.concat_ws(separator, *values), "sections": F.array(*spans)})


def section_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", sections: str | None = None,
                   path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, section, start, end, n_tokens, n_crossing, doc_tokens), one row per section. ``sections``
    names a column array<struct<start,end>> of character spans; without it the sentences are taken.
    ``n_crossing`` counts the tokens given to the section that also touch another one."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *([F.col(sections).alias("sections")] if sections else []))

    def run(batches):
        name = hash((pattern, len(shared.value[0]), path))
        if name not in _LOADED:
            _LOADED[name] = Offsets(*shared.value)
        offsets = _LOADED[name]
        for b in pieces(batches, 512):
            given = b.column(2).to_pylist() if sections else [None] * b.num_rows
            counts, parts = [], []
            for t, s in zip(b.column(1).to_pylist(), given):
                t = t or ""
                lo, hi = sentence_sections(t) if not sections else \
                    (np.array([x["start"] for x in s or []], np.int64), np.array([x["end"] for x in s or []], np.int64))
                starts, ends = offsets.spans(t)
                owner, crossing = attribute(starts, ends, lo, hi)
                n, c = np.bincount(owner + 1, minlength=len(lo) + 1), np.bincount(owner + 1, crossing, len(lo) + 1).astype(np.int64)
                numbers = np.arange(OUTSIDE, len(lo))
                rows_ = np.stack([numbers, np.r_[0, lo], np.r_[0, hi], n, c, np.full(len(n), len(starts))])
                rows_ = rows_[:, 0 if n[0] or not len(lo) else 1:]
                parts.append(rows_)
                counts.append(rows_.shape[1])
            cols = np.concatenate(parts, 1) if parts else np.zeros((6, 0), np.int64)
            keys = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), counts)))
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c.astype(np.int64)) for c in cols)],
                                             names=["key", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_arrow(rows, run, f"key {kind}, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long") \
        .withColumnRenamed("key", key)


_LOADED: dict[int, Offsets] = {}


def q_token_counts(spark, sf_dir):
    return section_tokens(table(spark, sf_dir, "documents"))
