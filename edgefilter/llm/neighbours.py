"""Approximate nearest neighbours by collision-counting hashing.

Vectors are dealt into segments and queries into blocks; every pair of a
segment and a block is one bounded group. In it each of ``PROJECTIONS`` random
projections of the segment is one sorted array. For a query, the window
centred on its projection is cut from every array; a vector collides where it
falls into the window. Windows grow by virtual rehashing: for radius R their
half width is ``WIDTH`` R / 2, so a vector at distance R collides with the same
probability p at every radius. Vectors with at least

    l = p m - RECALL_Z sqrt(m p (1 - p))

collisions of the m projections are verified by their distance. The first radius
is a little under the least distance to a sample of the segment. It
doubles until there are k of them, then it becomes the k-th distance found, if
that is larger than the radius: whatever is nearer has been met with the
probability that RECALL_Z stands for (1.65: 0.95). The k best of all segments
are the answer. A window that grows counts only what is new on either side; if
that is more than what lies outside, it is counted by the latter. A search ends
at the latest when every vector is verified.

Defined cases: a vector that is null, zero or has null or non-finite components
takes no part, nor does one without an id; vectors are compared with those of
their own length; of rows with one id the smallest vector stands; with fewer
than k candidates all are returned; ties go to the smaller id; distances of very
large components (1e200) are exact as long as they are doubles; an empty table
gives no rows; other columns are ignored, so their names can't clash. Very long
vectors make segments of fewer rows. The queries are a fixed share of the rows,
so the whole work grows with their product: see the README for figures.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgefilter.llm.common import register, table
from edgefilter.session import materialize

K = 10
PROJECTIONS = 128
WIDTH = 2.9
RECALL_Z = 1.65
#: Probability that a vector at distance R falls into a window of radius R.
NEAR = math.erf(WIDTH / 2 / math.sqrt(2))
SEED = 20
#: A segment's memory, vectors and arrays, about; queries of a block.
SEGMENT_BYTES, BLOCK = 64 << 20, 8_192
#: Vectors of a segment that a query's first radius is taken from, and its share of the least distance to them.
SAMPLE, START = 256, 0.85


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).groupBy(
        F.col(id_col).cast("long").alias("vec_id")).agg(F.min(v.cast("array<double>")).alias("v"))


def projections(dim: int) -> np.ndarray:
    """``PROJECTIONS`` directions, each a unit of scale for any distance: orthogonal sets of normal length."""
    rng = np.random.default_rng(SEED)
    sets = []
    while sum(s.shape[1] for s in sets) < PROJECTIONS:
        q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        sets.append(q * np.sqrt(dim))
    return np.concatenate(sets, axis=1)[:, :PROJECTIONS]


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; of very large components by their scaled differences, so that no square overflows."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = vectors - query
        out = np.sqrt((gap ** 2).sum(axis=1))
        big = np.flatnonzero(~np.isfinite(out))
        if len(big):
            halves = vectors[big] / 2 - query / 2
            top = np.abs(halves).max(axis=1, keepdims=True)
            out[big] = np.sqrt(((halves / top) ** 2).sum(axis=1)) * top[:, 0] * 2
    return out


class Segment:
    """Sorted projections of a set of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n = len(ids)
        #: Projections are of the vectors at this scale, so that they and their spread are finite.
        self.scale = max(float(np.abs(vectors).max()), 1e-300)
        self.directions = projections(vectors.shape[1])
        p = (vectors / self.scale) @ self.directions
        order = np.argsort(p, axis=0, kind="stable").T
        values = np.take_along_axis(p, order.T, axis=0).T
        self.order = order.astype(np.int32).ravel()
        # all arrays one after the other, each above the one before: one search finds a bound in all of them
        self.start = np.arange(len(values)) * n
        self.low = values[:, 0]
        gap = 4 * float((values[:, -1] - self.low).max()) + 1.0
        self.lift = np.arange(len(values)) * gap
        self.flat = (values - self.low[:, None] + self.lift[:, None]).ravel()
        self.reach = gap / 4
        self.sample = np.linspace(0, n - 1, min(n, SAMPLE)).astype(np.int64)

    def _bounds(self, at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the window around each projection, as places of all arrays."""
        at = np.clip(at - self.low, -self.reach, 2 * self.reach)
        half = min(half, 4 * self.reach)
        lo = np.searchsorted(self.flat, np.maximum(at - half, -self.reach / 2) + self.lift, "left")
        hi = np.searchsorted(self.flat, np.minimum(at + half, 1.5 * self.reach) + self.lift, "right")
        n = len(self.ids)
        lo, hi = np.clip(lo, self.start, self.start + n), np.clip(hi, self.start, self.start + n)
        return lo, np.maximum(lo, hi)

    def _count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([self.order[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]),
                           minlength=len(self.ids))

    def _all(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Collisions of whole windows; of those over half of all places by what lies outside."""
        n, m = len(self.ids), len(lo)
        if 2 * (hi - lo).sum() <= n * m:
            return self._count(lo, hi)
        return m - self._count(np.append(self.start, hi), np.append(lo, self.start + n))

    def collisions(self, at: np.ndarray, half: float) -> np.ndarray:
        """How many windows around the projections ``at`` each vector is in."""
        return self._all(*self._bounds(at / self.scale, half / self.scale))

    def nearest(self, query_id: int, query: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, the query's own row apart."""
        at = (query / self.scale) @ self.directions
        others = self.ids != query_id
        n, m, p = len(self.ids), len(at), NEAR
        enough = p * m - RECALL_Z * np.sqrt(m * p * (1 - p))
        k = min(k, int(others.sum()))
        distance = np.full(n, np.inf)
        verified = ~others
        near = distances(self.vectors[self.sample], query)
        near = near[others[self.sample] & (near > 0)]
        # first radius: under the nearest of a sample
        radius = START * float(near.min()) if len(near) else self.scale
        lo = hi = np.zeros(m, np.int64)
        counts = np.zeros(n, np.int64)
        while k and not verified.all():
            a, b = self._bounds(at, WIDTH * (radius / self.scale) / 2)
            if not hi.any() or (b - a).sum() - (hi - lo).sum() > n * m - (b - a).sum():
                counts = self._all(a, b)
            else:                                       # windows only grow: what is new on either side
                counts = counts + self._count(np.append(a, hi), np.append(lo, b))
            lo, hi = a, b
            fresh = np.flatnonzero((counts >= enough) & ~verified)
            distance[fresh] = distances(self.vectors[fresh], query)
            verified[fresh] = True
            if (verified & others).sum() >= k:
                kth = float(np.partition(distance, k - 1)[k - 1])
                if kth <= radius:
                    break
                radius = kth
            else:
                radius *= 2
        found = np.flatnonzero(verified & others)
        best = found[np.lexsort((self.ids[found], distance[found]))][:k]
        return self.ids[best], distance[best]


def _search(group: pa.Table) -> pa.Table:
    is_query = group.column("is_query").to_numpy()
    ids = group.column("vec_id").to_numpy()
    rows = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    out: list[tuple[np.ndarray, ...]] = []
    if (~is_query).any() and is_query.any():
        segment = Segment(ids[~is_query], rows[~is_query])
        for query_id, query in zip(ids[is_query], rows[is_query], strict=True):
            near, far = segment.nearest(query_id, query)
            out.append((np.full(len(near), query_id), near, far))
    cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                     "score": pa.array(cols[2], pa.float64())})


def search(vectors: DataFrame, every: int = 100, k: int = K, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each vector whose id ``every`` divides."""
    rows = materialize(usable(vectors, id_col, vec_col), "vectors")
    asks = F.col("vec_id") % every == 0
    size, n_queries = rows.agg(F.sum(8 * F.size("v") + 12 * PROJECTIONS), F.count_if(asks)).first()
    segments, query_blocks = max(1, -(-(size or 0) // SEGMENT_BYTES)), max(1, -(-n_queries // BLOCK))
    dealt = lambda salt, parts: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    data = rows.select("vec_id", "v", F.lit(False).alias("is_query"), dealt(1, segments).cast("int").alias("segment"),
                       each(query_blocks).alias("block"))
    queries = rows.where(asks).select("vec_id", "v", F.lit(True).alias("is_query"),
                                      dealt(2, query_blocks).cast("int").alias("block"), each(segments).alias("segment"))
    found = data.unionByName(queries).groupBy(F.size("v").alias("dim"), "segment", "block").applyInArrow(
        _search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


@register("op7_neighbours")
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
