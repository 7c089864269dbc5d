"""Operator 7, n-gram Jaccard join with filters under several token orders.

Documents are sets of hashed five-word shingles (64 bits). Two sets with |x & y| >= t |x | y| must
share a token within their prefixes under every global token order, so a pair is verified only if it
passes under several: one order brings the pairs together, two others are asked again before the
exact count.

1. One pass makes each text's set, a 64-bit signature of it (equal sets are one class, so exact
   copies are never paired) and its tokens under the first order: the prefix, and with it all tokens
   of a fixed quarter U of the token space.
2. Posting lists (shuffled by token, sorted, streamed) of up to ``LIST`` classes give pairs with their
   number of common tokens. A longer list never gives all its pairs: its members meet the list's
   first class, the hub. For a pair without a common token in a short list all common tokens lie in
   long lists, so a class with too few tokens there (counted inside U) cannot be in such a pair and
   leaves its hub groups. That empties the groups made by a passage or a line many texts share.
3. Pairs are kept if sizes and the common tokens inside U still allow the threshold, then verified:
   the hub's text and its members' texts meet (salted by hub), members stream past one set in memory.
4. Links give components. What is left in a hub group are members outside the hub's component; they
   are indexed in blocks of bounded size, and the members that can link to them stream past the
   index. These links close the components.

A link between different texts is only left out if its ends are connected already; the result is the
component of every document. Texts move only if they are in a candidate pair (a fixed-size bitmap
prunes the scan). Every table that is used again is stored in the shared folder.

Defined cases: a null text or one without words has no shingles, links with nothing and is its own
component; null ids take part, a component's id is its smallest non-null id; repeated rows are copies;
rows that share an id but not the text are different documents; an empty table gives an empty result;
extra columns are ignored. Two different sets share a signature with odds 2^-64 a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import (WHITE, bitmap_bits, connected_components, free_name, id_bitmap, map_arrow, pieces, release, spread_join,
                   stored, table)

WORDS, PERCENT, LIST, BLOCK, STREAM, SALT_ROWS = 5, 80, 32, 512, 1024, 256
#: U: the tokens below this bound, a quarter of the (signed, uniform) token space.
QUARTER = -(1 << 62)
#: Odd multipliers that re-order the token space, for the second and third order.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SEEN_CLASSES = 200_000
_MIX, _FOLD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25)


def shingles(text: str | None) -> np.ndarray:
    """Ascending distinct tokens of a text: hashes of five words in a row, of all words if fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(WORDS, len(h))
    k = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        k = k * _FOLD + h[j:len(h) - width + 1 + j]
    k ^= k >> np.uint64(32)
    k *= _MIX
    k ^= k >> np.uint64(29)
    return np.unique(k.view(np.int64))


def signature(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


def prefix_length(n: int) -> int:
    """Any partner shares one of so many first tokens under any global order."""
    return n - -(-PERCENT * n // 100) + 1


def linked(common, a, b):
    return 100 * common >= PERCENT * (a + b - common)


def _sets(batches):
    seen: set[int] = set()
    for b in pieces(batches):
        n, sig, u, tokens, counts = [], [], [], [], []
        for t in b.column(1).to_pylist():
            s = shingles(t)
            k, inside = signature(s), int(np.searchsorted(s, QUARTER))
            n.append(len(s))
            sig.append(k)
            u.append(inside)
            if len(s) and k not in seen:
                if len(seen) >= SEEN_CLASSES:
                    seen.clear()
                seen.add(k)
                tokens.append(s[:max(inside, prefix_length(len(s)))])
                counts.append(len(tokens[-1]))
            else:
                counts.append(0)
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(u, pa.int64()), lists],
                                         names=["doc_id", "text_hash", "n", "sig", "u", "tokens"])


MATCH = "hub boolean, a long, b long, na long, nb long, inside int"


def _lists(batches):
    """Rows (token, sig, n) sorted by token and sig -> matches. Holds one batch and at most LIST rows
    of an unfinished list; a longer list is passed on member by member."""
    def emit(hub, a, b, na, nb, inside):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hub)), pa.array(a), pa.array(b), pa.array(na), pa.array(nb),
                                           pa.array(inside.astype(np.int32))], names=["hub", "a", "b", "na", "nb", "inside"])

    def short(tok, sig, n, starts, sizes):
        for g in np.unique(sizes[sizes > 1]):
            rows = starts[sizes == g][:, None] + np.arange(g)
            i, j = np.triu_indices(g, 1)
            for at in range(0, len(rows), max(1, 400_000 // len(i))):
                part = rows[at:at + max(1, 400_000 // len(i))]
                x, y = part[:, i].ravel(), part[:, j].ravel()
                ok = PERCENT * np.maximum(n[x], n[y]) <= 100 * np.minimum(n[x], n[y])
                x, y = x[ok], y[ok]
                yield emit(False, sig[x], sig[y], n[x], n[y], tok[x] < QUARTER)

    def long(tok, sig, n, hub):
        return emit(True, sig, np.full(len(sig), hub[0]), n, np.full(len(sig), hub[1]), tok < QUARTER)

    rest = tuple(np.zeros(0, np.int64) for _ in range(3))
    open_hub, open_token = None, None  # the list that goes on has a hub already
    last = None
    for batch in batches:
        tok, sig, n = (np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns))
        if not len(tok):
            continue
        keep = np.ones(len(tok), bool)  # copies of a class from several tasks
        keep[1:] = (tok[1:] != tok[:-1]) | (sig[1:] != sig[:-1])
        if last is not None and not len(rest[0]) and (tok[0], sig[0]) == last:
            keep[0] = False
        last = (tok[-1], sig[-1])
        tok, sig, n = tok[keep], sig[keep], n[keep]
        if open_hub is not None:
            end = int(np.searchsorted(tok, open_token, "right"))
            if end:
                yield long(tok[:end], sig[:end], n[:end], open_hub)
            tok, sig, n = tok[end:], sig[end:], n[end:]
            if len(tok):
                open_hub = None
        if not len(tok):
            rest = tuple(np.zeros(0, np.int64) for _ in range(3))
            continue
        starts = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
        sizes = np.diff(np.r_[starts, len(tok)])
        big = np.flatnonzero(sizes > LIST)
        for g in big:
            s, e = starts[g], starts[g] + sizes[g]
            yield long(tok[s:e], sig[s:e], n[s:e], (sig[s], n[s]))
        if len(big) and big[-1] == len(sizes) - 1:
            open_hub, open_token = (sig[starts[-1]], n[starts[-1]]), tok[-1]
            rest = tuple(np.zeros(0, np.int64) for _ in range(3))
            yield from short(tok, sig, n, starts[sizes <= LIST], sizes[sizes <= LIST])
        else:
            done = sizes[:-1] <= LIST
            yield from short(tok, sig, n, starts[:-1][done], sizes[:-1][done])
            rest = (tok[starts[-1]:], sig[starts[-1]:], n[starts[-1]:])
    if len(rest[0]) > 1:
        yield from short(*rest, np.array([0]), np.array([len(rest[0])]))


def _first_tokens(tokens: np.ndarray, order: int) -> np.ndarray:
    """The prefix of a set under another order."""
    p = prefix_length(len(tokens))
    return np.partition(tokens.view(np.uint64) * np.uint64(order), p - 1)[:p]


def _verify(batches):
    """Rows (hub, salt, role, sig, text), hub's own row (role 0) first -> (a, b) of links."""
    key = own = firsts = None
    for batch in pieces(batches):
        a, b = [], []
        hubs, salts, roles, sigs, texts = (c.to_pylist() for c in batch.columns)
        for hub, salt, role, sig, text in zip(hubs, salts, roles, sigs, texts):
            tokens = shingles(text)
            if signature(tokens) != sig:  # another text under the same id
                continue
            if role == 0:
                key, own, firsts = (hub, salt), tokens, [_first_tokens(tokens, o) for o in ORDERS]
            elif key == (hub, salt):
                if all(np.isin(_first_tokens(tokens, o), f).any() for o, f in zip(ORDERS, firsts)):
                    if linked(len(np.intersect1d(own, tokens, assume_unique=True)), len(own), len(tokens)):
                        a.append(hub)
                        b.append(sig)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _against_blocks(batches):
    """Rows (hub, salt, role, sig, text, comp), the indexed ones (role 0) first -> links between components."""
    key, index, built = None, [], None
    found: set[tuple[int, int]] = set()

    def build():
        owner = np.repeat(np.arange(len(index)), [len(t) for _, t in index])
        tokens = np.concatenate([t for _, t in index])
        order = np.argsort(tokens, kind="stable")
        return tokens[order], owner[order], np.array([len(t) for _, t in index]), np.array([c for c, _ in index], np.int64)

    def compare(members):
        tokens, owner, size, comp = built
        q = np.concatenate([t for _, t in members])
        who = np.repeat(np.arange(len(members)), [len(t) for _, t in members])
        lo, hi = np.searchsorted(tokens, q, "left"), np.searchsorted(tokens, q, "right")
        n = hi - lo
        hits = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        common = np.bincount(np.repeat(who, n) * len(size) + owner[hits], minlength=len(members) * len(size)).reshape(len(members), -1)
        sizes, comps = np.array([len(t) for _, t in members]), np.array([c for c, _ in members], np.int64)
        ok = linked(common, sizes[:, None], size[None, :]) & (comps[:, None] != comp[None, :])
        m, o = np.nonzero(ok)
        found.update(zip(comps[m].tolist(), comp[o].tolist()))

    for batch in pieces(batches):
        waiting: list = []
        for hub, salt, role, sig, text, comp in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (hub, salt):
                if waiting and built:
                    compare(waiting)
                key, index, built, waiting = (hub, salt), [], None, []
            tokens = shingles(text)
            if signature(tokens) != sig:
                continue
            if role == 0:
                index.append((comp, tokens))
            elif index:
                built = built or build()
                waiting.append((comp, tokens))
                if len(waiting) >= 64:
                    compare(waiting)
                    waiting = []
        if waiting and built:
            compare(waiting)
        pairs = sorted(found)
        found.clear()
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])


def _with_texts(docs: DataFrame, reps: DataFrame, need: DataFrame) -> DataFrame:
    """``need`` (sig, ...) with the text of one document of each class, column ``text``."""
    wanted = stored(need.join(reps, "sig"), "wanted")
    size = bitmap_bits(wanted)
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(wanted, "doc_id", size))

    def prune(batches):
        for b in batches:
            pos = b.column(0).to_numpy()
            yield b.filter(pa.array((bits.value[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1))

    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(size)).alias("pos"), F.col("doc_id").alias("id"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    few = map_arrow(rows, prune, f"pos long, id {kind}, text string")
    return wanted.join(few, F.expr("doc_id <=> id")).drop("doc_id", "id", "pos")


def _streamed(rows: DataFrame, fn, columns: list[str]) -> DataFrame:
    """Groups (hub, salt) in one task each, indexed rows first, streamed through ``fn``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(rows.select(*columns).repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", "role"), fn, "a long, b long")


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc_id, text): the sets of all rows, and (doc_id, text_hash, n, comp) of every row with words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = stored(map_arrow(docs.withColumn("text_hash", F.xxhash64("text")), _sets, f"doc_id {kind}, text_hash long, n long, sig long, u long, tokens array<long>"), "sets")
    sets = stored(whole.drop("tokens"), "set-sizes")
    classes = sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("u").alias("u"))
    reps = classes.select("sig", "doc_id")

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = whole.select(F.explode("tokens").alias("token"), "sig", "n").repartition(parts, "token").sortWithinPartitions("token", "sig")
    matches = stored(map_arrow(postings, _lists, MATCH).groupBy("hub", "a", "b").agg(
        F.min("na").alias("na"), F.min("nb").alias("nb"), F.sum("inside").alias("inside")), "matches")
    release(whole)

    # tokens of a class in long lists, inside U; what a class needs there to be in a pair at all, or to be the smaller one
    in_long = matches.filter("hub").groupBy(F.col("a").alias("sig")).agg(F.sum("inside").alias("hot"))
    stats = stored(classes.select("sig", "n", "u").join(in_long, "sig", "left").withColumn("hot", F.coalesce("hot", F.lit(0))), "stats")
    groups = stored(matches.filter("hub").select(F.col("a").alias("sig"), F.col("b").alias("hub"), F.col("nb").alias("n_hub"))
                    .join(stats, "sig").filter(f"hot >= ceil({PERCENT} * n / 100) - n + u")
                    .withColumn("smaller", F.expr(f"hot >= ceil({2 * PERCENT} * n / {100 + PERCENT}) - n + u")), "groups")

    a, b = (stats.select(*(F.col(c).alias(f"{c}_{x}") for c in ("sig", "n", "u", "hot"))) for x in "ab")
    close = (matches.filter("not hub").select("a", "b", "inside").join(a, F.col("a") == F.col("sig_a")).join(b, F.col("b") == F.col("sig_b"))
             .filter(f"inside + least(hot_a, hot_b) >= ceil({PERCENT} * (n_a + n_b) / {100 + PERCENT}) - least(n_a - u_a, n_b - u_b)")
             .select(F.col("a").alias("hub"), F.col("b").alias("sig")))
    to_hub = groups.filter(f"sig <> hub and {PERCENT} * greatest(n, n_hub) <= 100 * least(n, n_hub)").select("hub", "sig")
    pairs = stored(close.union(to_hub).distinct(), "pairs")
    release(matches, stats)
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SALT_ROWS).alias("k"))
    need = pairs.join(salts, "hub").select("sig", "hub", F.pmod(F.xxhash64("sig"), F.col("k")).alias("salt"), F.lit(1).alias("role"))
    own = salts.select(F.col("hub").alias("sig"), "hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("salt"), F.lit(0).alias("role"))
    links = stored(_streamed(_with_texts(docs, reps, need.union(own)), _verify, ["hub", "salt", "role", "sig", "text"]), "links")

    comps = stored(connected_components(links), "comps")
    links = stored(links.union(_left_in_groups(docs, reps, groups, comps)), "all-links")
    comps = connected_components(links).select(F.col("node").alias("sig"), "comp")
    placed = stored(spread_join(sets.filter("n > 0").select("doc_id", "text_hash", "n", "sig"), comps, "sig", "left")
                    .select("doc_id", "text_hash", "n", F.coalesce("comp", "sig").alias("comp")), "placed")
    return sets, placed


def similarity_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    sets, placed = _placed(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    ids = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return (spread_join(placed, ids, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def _left_in_groups(docs: DataFrame, reps: DataFrame, groups: DataFrame, comps: DataFrame) -> DataFrame:
    """Links (between components) of hub-group members that are not in their hub's component."""
    comp_of = comps.select(F.col("node").alias("sig"), "comp")
    hub_comp = comps.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
    members = stored(groups.select("sig", "hub", "smaller").join(comp_of, "sig", "left").join(hub_comp, "hub", "left")
                     .select("sig", "hub", "smaller", F.coalesce("comp", "sig").alias("comp"), F.coalesce("hub_comp", "hub").alias("hub_comp"))
                     .withColumn("out", F.col("comp") != F.col("hub_comp")), "members")
    need = None
    for family, (index, stream) in enumerate((("out and smaller", "true"), ("out and not smaller", "smaller and not out"))):
        # k blocks of the index and s slices of the stream; every block meets every slice in a task of its own
        cut = members.groupBy("hub").agg(F.ceil(F.count_if(F.expr(index)) / BLOCK).alias("k"), F.ceil(F.count_if(F.expr(stream)) / STREAM).alias("s")) \
            .filter("k > 0 and s > 0")
        whole = members.join(cut, "hub").withColumn("h", F.xxhash64("sig"))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        salted = lambda df, role: df.select("sig", "hub", ((F.col("block") * F.col("s") + F.col("slice")) * 2 + family).alias("salt"),
                                            F.lit(role).alias("role"), "comp")
        streamed = whole.filter(stream).withColumns({"slice": F.pmod(F.col("h"), F.col("s")), "block": every("k")})
        indexed = whole.filter(index).withColumns({"block": F.pmod(F.col("h"), F.col("k")), "slice": every("s")})
        both = salted(streamed, 1).union(salted(indexed, 0))
        need = both if need is None else need.union(both)
    return _streamed(_with_texts(docs, reps, need), _against_blocks, ["hub", "salt", "role", "sig", "text", "comp"]).distinct()


def q_ngram_join(spark, sf_dir):
    return similarity_components(table(spark, sf_dir, "documents"))


def stage_ngram_join(spark, docs, sf_dir):
    """Pipeline stage: of each group of linked documents one row stays, that with the smallest id (rows
    without an id last; of several texts under that id, the one with the smallest hash). Documents without
    words are linked with nothing and stay."""
    _, placed = _placed(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    id_, hash_ = free_name(docs, "first_id"), free_name(docs, "first_hash")
    stays = placed.groupBy("comp").agg(first).select(F.col("first.doc_id").alias(id_), F.col("first.text_hash").alias(hash_))
    free = F.translate(F.coalesce("text", F.lit("")), WHITE, "") == ""
    one = docs.filter(~free).join(stays, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left_semi")
    return one.dropDuplicates(["doc_id", "text"]).select(*docs.columns).unionByName(docs.filter(free))


def brute_force(rows: list[tuple]) -> dict:
    """{position: (n_shingles, component id)} by comparing word tuples; for tests."""
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set())

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where: dict = {}
    for i, s in enumerate(sets):
        common: dict[int, int] = {}
        for t in s:
            for j in where.setdefault(t, []):
                common[j] = common.get(j, 0) + 1
            where[t].append(i)
        for j, c in common.items():
            if linked(c, len(s), len(sets[j])):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {i: (len(sets[i]), least.get(root(i))) for i in range(len(rows))}
