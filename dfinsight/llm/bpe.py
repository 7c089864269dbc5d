"""Operator 8, byte-level BPE encoding and decoding by backtracking over longest matches.

The vocabulary's bytes are mapped to Latin-1 text, so that an Aho-Corasick automaton (pyahocorasick)
finds every token that occurs in a piece in one pass; the longest one that starts at each position is
the first choice there. Two tokens may stand side by side only if no merge would cross the border
between them before both are complete; that test walks the two merge trees along the border and is
memoised. When no token fits after the last one, the last one is shortened to the next longest token
that is its prefix, or given up; a position that was given up is never tried again, so a piece takes
linear time. The result is exactly that of merging the lowest-ranked pair again and again.

Encoded pieces are kept in a bounded cache per Python worker. One map over the table: no shuffle. The
vocabulary (bounded by its file) is read on the driver and broadcast.

Defined cases: a null text is empty (0 tokens, digests of nothing); every other text, however long,
is encoded whole; rows are independent, so repeated rows repeat; extra columns are kept.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from .base import map_arrow, pieces, table, without

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NEVER = 1 << 60
CACHED_PIECES, CACHED_PAIRS = 500_000, 500_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return tokens


def _merged(data: bytes, rank: dict[bytes, int], below: int) -> list[bytes]:
    """Plain merging with the ranks under ``below``; only for building the merge trees and for tests."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = min((rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
        if best >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def merge_trees(tokens: list[bytes]) -> list[tuple[int, int]]:
    """For each token the two it is merged from; a token that merging never makes (single bytes) has itself."""
    rank = {t: i for i, t in enumerate(tokens)}
    out = []
    for i, t in enumerate(tokens):
        parts = _merged(t, rank, i) if len(t) > 1 else [t]
        out.append((rank[parts[0]], rank[parts[1]]) if len(parts) == 2 else (i, i))
    return out


class Pieces(dict):
    """piece -> its token ids, computed when first asked for."""

    def __init__(self, bpe: "BytePairs"):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.bpe.encode_piece(piece.encode()))
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class BytePairs:
    def __init__(self, tokens: list[bytes], trees: list[tuple[int, int]], pattern: str):
        self.tokens, self.trees = tokens, trees
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.lengths = [len(t) for t in tokens]
        self.names = [str(i) for i in range(len(tokens))]
        self.words = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter_: dict[int, int] = {}
        self.pieces = Pieces(self)

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, -1 if none."""
        got = self.shorter_.get(token)
        if got is None:
            t = self.tokens[token]
            got = self.shorter_[token] = next((r for n in range(len(t) - 1, 0, -1) if (r := self.rank.get(t[:n])) is not None), -1)
        return got

    def border(self, token: int, side: int) -> list[int]:
        """The tokens at one end of a token's merge tree, from the single byte up to the token."""
        out = [token]
        while (child := self.trees[out[-1]][side]) != out[-1]:
            out.append(child)
        return out[::-1]

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart. Going up both borders in the order of merging, at every
        moment the two tokens that face each other must not merge before one of them is taken up by
        its own parent; equal ranks merge from left to right."""
        got = self.pairs.get((left, right))
        if got is None:
            a, b = self.border(left, 1), self.border(right, 0)
            i = j = 0
            while True:
                ends_a = a[i + 1] if i + 1 < len(a) else NEVER
                ends_b = b[j + 1] if j + 1 < len(b) else NEVER
                cross = self.rank.get(self.tokens[a[i]] + self.tokens[b[j]], NEVER)
                if cross < ends_a and cross <= ends_b:
                    got = False
                    break
                if ends_a == ends_b == NEVER:
                    got = True
                    break
                if ends_a <= ends_b:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = got
        return got

    def encode_piece(self, data: bytes) -> list[int]:
        if not data:
            return []
        if (whole := self.rank.get(data)) is not None:
            return [whole]
        longest = [-1] * len(data)
        lengths = self.lengths
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # later ends are longer
        open_at = bytearray(b"\x01") * (len(data) + 1)  # 0: given up
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(data):
            while token >= 0 and not (open_at[at + lengths[token]] and (not out or self.fit(out[-1], token))):
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at += lengths[token]
                token = longest[at] if at < len(data) else -1
            else:
                open_at[at] = 0
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                last = out.pop()
                at -= lengths[last]
                token = self.shorter(last)
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.words.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def listed(self, ids) -> str:
        return ",".join(map(self.names.__getitem__, ids))


_LOADED: dict[str, BytePairs] = {}


def shared_vocabulary(spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN):
    """A function for tasks that gives the encoder; a worker builds it once and keeps it."""
    tokens = read_ranks(path or public_tokenizers.path(VOCABULARY))
    name = hashlib.sha256(pattern.encode() + b"".join(tokens)).hexdigest()
    if (name, "trees") not in _TREES:
        _TREES[name, "trees"] = merge_trees(tokens)
    value = spark.sparkContext.broadcast((tokens, _TREES[name, "trees"], pattern))

    def get() -> BytePairs:
        if name not in _LOADED:
            _LOADED[name] = BytePairs(*value.value)
        return _LOADED[name]

    return get


_TREES: dict[tuple, list] = {}


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` plus the ids (array<int>) of the text."""
    docs = without(docs, ids)
    get, at = shared_vocabulary(docs.sparkSession, path), docs.columns.index(text)

    def run(batches):
        bpe = get()
        for b in pieces(batches, 256):
            got = pa.array([bpe.encode(t or "") for t in b.column(at).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, got], names=[*b.schema.names, ids])

    return map_arrow(docs, run, _ddl(docs, f"`{ids}` array<int>"))


def decode(rows: DataFrame, ids: str = "token_ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns of ``rows`` plus the bytes that the ids stand for."""
    rows = without(rows, text)
    get, at = shared_vocabulary(rows.sparkSession, path), rows.columns.index(ids)

    def run(batches):
        bpe = get()
        for b in pieces(batches, 256):
            got = pa.array([bpe.decode(x or ()) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, got], names=[*b.schema.names, text])

    return map_arrow(rows, run, _ddl(rows, f"`{text}` binary"))


def _ddl(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def digests(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` without the text, with n_tokens, ids_sha256 and decoded_sha256: encodes, and decodes the
    ids again, without moving the ids out of the task. Columns of the new names are replaced."""
    docs = without(docs, "n_tokens", "ids_sha256", "decoded_sha256")
    get, at = shared_vocabulary(docs.sparkSession, path), docs.columns.index(text)
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        bpe = get()
        for b in pieces(batches):
            n, of_ids, of_bytes = [], [], []
            for t in b.column(at).to_pylist():
                ids = bpe.encode(t or "")
                n.append(len(ids))
                of_ids.append(sha(bpe.listed(ids).encode()))
                of_bytes.append(sha(bpe.decode(ids)))
            rest = [(c, x) for i, (c, x) in enumerate(zip(b.columns, b.schema.names)) if i != at]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in rest), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                                             names=[*(x for _, x in rest), "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs, run, _ddl(docs.drop(text), "n_tokens long", "ids_sha256 string", "decoded_sha256 string"))


def q_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage_bpe(spark, docs, sf_dir):
    """Last pipeline stage: every document copy with its source, language, token count and digests."""
    return digests(docs.select("doc_id", "source", "lang", "text"))
