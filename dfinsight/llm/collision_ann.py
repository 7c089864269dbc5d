"""Operator 3, approximate nearest neighbours by collision counting.

A vector's projections on random lines are kept in one sorted array per line. A query looks at a window
centred on its own projection in every array; virtual rehashing widens all windows together by a ratio,
and only the newly covered entries are counted. A vector that lies inside the windows of at least a
threshold share of the lines is verified by its exact distance. A query is done when the windows are so wide
that a vector as near as its k-th would have been verified with 95 % chance, by the binomial law of the number of
windows that hold it, or when every vector is verified (then the answer is exact). No cap is set on candidates.

Vectors are dealt by a hash of their id into blocks of bounded size, queries into blocks as well; every
pair of blocks is a group with an index of its own, and a query's answers from all blocks are merged by
rank. So equal vectors, however many, spread over the blocks. Nothing is broadcast or collected.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part;
only vectors of the same length are compared; a query never meets rows of its own id; rows repeated
exactly count once, rows with one id and different vectors count as one candidate at the nearer; a query
id with several vectors uses the smallest; fewer candidates than k give all of them; ties go to the
smaller id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .base import importable, table

K, LINES, SHARE, RATIO, MISS, SEED = 10, 96, 0.8, 1.1, 0.05, 17
BLOCK_VALUES, QUERY_BLOCK, AHEAD = 1 << 21, 2048, 8


def sure_reach(lines: int, need: int) -> float:
    """Half width of the windows, in distances of a vector, at which it is verified with the chance 1 - ``MISS``: on a
    line it lies as far from the query as a normal deviate of its distance, and it must be inside ``need`` windows."""
    def caught(reach: float) -> float:
        p = math.erf(reach / math.sqrt(2))
        return sum(math.comb(lines, i) * p ** i * (1 - p) ** (lines - i) for i in range(need, lines + 1))

    lo, hi = 0.0, 8.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if caught(mid) < 1 - MISS else (lo, mid)
    return hi


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, also where squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        apart = vectors - query
        out = np.sqrt((apart ** 2).sum(1))
        top = np.abs(apart).max(1)
        odd = np.flatnonzero(~(top < 1e150) | (top < 1e-150) & (top > 0))
        if len(odd):
            by = np.where(top[odd] < 1, top[odd], np.maximum(np.abs(vectors[odd]).max(1), np.abs(query).max()))[:, None]
            apart = np.where(by < 1, apart[odd] / by, vectors[odd] / by - query / by)
            out[odd] = by[:, 0] * np.sqrt((apart ** 2).sum(1))
    return out


class CollisionIndex:
    """Sorted projections of the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: int = LINES):
        self.ids, self.vectors = ids, vectors
        self.axes = np.random.default_rng(SEED).standard_normal((vectors.shape[1], lines))
        top = np.abs(vectors).max()
        #: A power of two by which lines see the vectors, 1 unless projections could overflow or vanish.
        self.scale = 1.0 if 1e-150 < top < 1e150 else 2.0 ** -np.clip(np.frexp(top)[1], -1000, 1000)
        projected = (vectors * self.scale) @ self.axes
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.sort(projected, axis=0).T.copy()
        self.need = int(np.ceil(SHARE * lines))
        self.reach = sure_reach(lines, self.need)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, by distance, then id; ``verified``: how many vectors were compared."""
        self.verified = 0
        n = len(self.ids)
        at = (query * self.scale) @ self.axes
        own = self.ids == query_id
        left = n - int(own.sum())
        if not left:
            return self.ids[:0], np.zeros(0)
        lo = hi = [int(v.searchsorted(a)) for v, a in zip(self.values, at)]
        # first window: about one vector in fifty on the middle line
        step = max(1, min(n - 1, max(k, n // 50)))
        around = [np.sort(np.abs(v[max(0, m - step):m + step] - a)) for v, m, a in zip(self.values, lo, at)]
        half = max(float(np.median([x[min(step, len(x)) - 1] for x in around])), 1e-300)
        counts = np.zeros(n, np.int32)
        waits = ~own  # not verified yet
        ids, found = np.zeros(0, self.ids.dtype), np.zeros(0)
        bounds: list = []  # of the next windows, looked up for some at a time
        while True:
            if not bounds:
                widths = half * np.cumprod([1.0] + [RATIO] * (AHEAD - 1))
                below = np.array([v.searchsorted(a - widths, "left") for v, a in zip(self.values, at)])
                above = np.array([v.searchsorted(a + widths, "right") for v, a in zip(self.values, at)])
                bounds = [*zip(widths.tolist(), below.T.tolist(), above.T.tolist())][::-1]
            half, wider_lo, wider_hi = bounds.pop()
            fresh = [ids_of[a:b] for ids_of, a, b in zip(self.order, wider_lo, lo)] + [ids_of[a:b] for ids_of, a, b in zip(self.order, hi, wider_hi)]
            lo, hi = wider_lo, wider_hi
            counts += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int32)
            new = np.flatnonzero((counts >= self.need) & waits)
            if len(new):
                waits[new] = False
                ids, found = self._nearest_of(np.concatenate([ids, self.ids[new]]), np.concatenate([found, distances(self.vectors[new], query)]), k)
            if len(ids) == k and half >= self.reach * found[-1] * self.scale or not waits.any():
                self.verified = left - int(waits.sum())
                return ids, found
            half *= RATIO  # the next, where the bounds run out

    @staticmethod
    def _nearest_of(ids: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest, each id once."""
        order = np.lexsort((found, ids))
        first = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
        best = first[np.lexsort((ids[first], found[first]))[:k]]
        return ids[best], found[best]


def usable(vec: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & sound & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(query_id, rank, <key>, score): for every row of ``queries`` its k nearest rows of ``vectors``."""
    importable(vectors.sparkSession)

    def sound(df):
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
        return rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))

    data, asked = sound(vectors), sound(queries).groupBy("dim", "id").agg(F.min("v").alias("v"))
    sizes = data.groupBy("dim").agg(F.ceil(F.count("*") * F.col("dim") / BLOCK_VALUES).alias("blocks")) \
        .join(asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("parts")), "dim")  # one row per length
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    rows = (data.join(sizes, "dim").select("dim", hashed("blocks").alias("block"), spread("parts").alias("part"), F.lit(False).alias("ask"), "id", "v")
            .unionByName(asked.join(sizes, "dim").select("dim", spread("blocks").alias("block"), hashed("parts").alias("part"), F.lit(True).alias("ask"), "id", "v")))

    def search(t: pa.Table) -> pa.Table:
        ask = t["ask"].to_numpy()
        ids = t["id"].to_numpy()
        flat = t["v"].combine_chunks()
        m = flat.flatten().to_numpy().reshape(len(ids), -1)
        out: tuple[list, list, list] = ([], [], [])
        if (~ask).any():
            both = np.concatenate([ids[~ask][:, None].view(np.float64), m[~ask]], 1)
            keep = np.unique(np.ascontiguousarray(both).view(np.dtype((np.void, both.dtype.itemsize * both.shape[1]))).ravel(), return_index=True)[1]
            index = CollisionIndex(ids[~ask][keep], m[~ask][keep])
            for q, v in zip(ids[ask], m[ask]):
                found, d = index.search(q, v, k)
                out[0].append(np.full(len(found), q))
                out[1].append(found)
                out[2].append(d)
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        return pa.table({"query_id": cat(out[0], np.int64), key: cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    # an explicit number of tasks: groups are small in bytes and long in work, so they must not be merged by size
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "dim", "block", "part")
    found = rows.groupBy("dim", "block", "part").applyInArrow(search, f"query_id long, {key} long, score double")
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", key)).cast("int"))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", key, "score")


def q_collision_ann(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.filter("vec_id % 100 = 0"))
