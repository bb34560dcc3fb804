"""Exact and locality-sensitive nearest-neighbour search, and recall@k.

Vectors are ``array<float|double>`` columns; arithmetic is JVM-side
higher-order expressions, but for the tuning grid, whose tasks compare blocks of
rows (numpy, same order of sums).

Query set: a sampling operator, like the original evaluation's
``sample(0.1).limit(50)`` but repeatable: rows whose md5 bucket of the id
is below ``percent``, the ``max_queries`` smallest by md5. Its size is
bounded by ``max_queries``, which is what makes broadcasting it safe.

Exact kNN: every data row is compared with the bounded query table
(broadcast nested-loop join, work linear in the data), then the k nearest
per query are kept by :func:`topk`.

Bucketed random-projection LSH: ``h_t(v) = floor(v . r_t / b)`` for unit
random directions ``r_t`` (md5-seeded, so every engine draws the same
ones). A data row is a candidate of a query when they share a bucket in at
least one table; the equi-join on (table, bucket) keeps the pair only in the
first table where the buckets agree, so no de-duplication shuffle follows.
The query side is broadcast (bounded); the data side is never shuffled for
the join, so bucket skew (Q12: half the rows in one bucket) costs no task
imbalance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.functions.hashing import hash_bucket, md5_u32
from edgefilter.functions.vectors import dot, l2
from edgefilter.session import materialize

DIGITS = 6


# -- query set ------------------------------------------------------------

def query_set(df: DataFrame, id_col: str, vec_col: str, percent: int = 10,
              max_queries: int = 50) -> DataFrame:
    """Bounded, repeatable sample of query rows: (q_id, q_vec)."""
    picked = (df.filter(hash_bucket(F.col(id_col), 100) < percent)
                .orderBy(md5_u32(F.col(id_col)), F.col(id_col))
                .limit(max_queries))
    return picked.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec"))


# -- top-k per group ------------------------------------------------------

def topk(df: DataFrame, group: list[str], order: list[Column], k: int,
         fan_in: int | None = None) -> DataFrame:
    """k first rows per group by ``order`` (a total order), with ``rank``.

    Two rounds: first per (group, block of input partitions), then per
    group. Spark's window group limit cuts each map partition to k rows per
    window group before the shuffle, so a group never receives more than
    ``fan_in * k`` rows in round two, and a round-one group only the
    partial top-k of its block, however large or skewed the group is.
    The default fan-in grows with the square root of the cluster's
    parallelism (counting the input partitions would plan, and under AQE
    run, the upstream stages).
    """
    if fan_in is None:
        par = df.sparkSession.sparkContext.defaultParallelism
        fan_in = max(2, int(math.ceil(math.sqrt(4 * par))))
    salted = df.withColumn("_blk", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    w1 = Window.partitionBy(*group, "_blk").orderBy(*order)
    first = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_blk")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)
#: Rows of a query table up to which it may be broadcast.
QUERY_LIMIT = 10_000


def is_bounded(queries: DataFrame, limit: int = QUERY_LIMIT) -> bool:
    """At most ``limit`` rows; reads no more than one beyond it."""
    return queries.select(F.lit(1)).limit(limit + 1).count() <= limit


# -- exact kNN --------------------------------------------------------------

def exact_knn(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int,
              exclude_self: bool = True, dim: int | None = None) -> DataFrame:
    """(q_id, id, dist, rank) of the k nearest rows to each query.

    Up to ``QUERY_LIMIT`` queries (see :func:`query_set`; checked) are broadcast
    to every row; more go to :func:`knn_join.knn_join`, which shuffles.
    The query row itself is excluded by id, not by distance 0, so exact
    duplicates of the query still count as neighbours.
    """
    if not is_bounded(queries):
        from edgefilter.operators.knn_join import knn_join
        return knn_join(data, queries, id_col, vec_col, k, exclude_self)
    pairs = data.select(id_col, vec_col).join(F.broadcast(queries), how="cross")
    if exclude_self:
        pairs = pairs.filter(F.col(id_col) != F.col("q_id"))
    scored = pairs.select("q_id", id_col, l2(F.col(vec_col), F.col("q_vec"), dim).alias("dist"))
    top = topk(scored, ["q_id"], [F.col("dist"), F.col(id_col)], k)
    return top.select("q_id", id_col, F.round("dist", DIGITS).alias("dist"), "rank")


# -- random projections ----------------------------------------------------

def _md5_uniform(text: str, part: int) -> float:
    h = hashlib.md5(text.encode()).hexdigest()
    return int(h[8 * part:8 * part + 8], 16) / 4294967296.0


def projections(dim: int, n_tables: int, seed: int = 42) -> list[list[float]]:
    """Unit random directions, one per hash table.

    Coordinates are approximately normal (sum of four md5 uniforms, centred),
    then scaled to unit length as the ML random-projection LSH does. The
    first t directions do not depend on n_tables, so grids over the table
    count are nested.
    """
    out = []
    for t in range(n_tables):
        raw = [sum(_md5_uniform(f"{seed}/{t}/{d}", j) for j in range(4)) - 2.0 for d in range(dim)]
        norm = math.sqrt(sum(x * x for x in raw))
        out.append([x / norm for x in raw])
    return out


def _lit_vec(v: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def lsh_hash_array(vec: Column, projs: list[list[float]], bucket_length: float) -> Column:
    """array<bigint> of bucket ids, one per table."""
    return F.array(*[F.floor(dot(vec, _lit_vec(r)) / F.lit(float(bucket_length))).cast("bigint")
                     for r in projs])


def bucket_join(data_h: DataFrame, queries_h: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Candidate pairs from precomputed hash arrays.

    ``data_h`` has (id, vec, _h), ``queries_h`` has (q_id, q_vec, _qh); the
    arrays hold one bucket id per table. Returns (q_id, q_vec, id, vec,
    first_table), each pair once: only the join row of the first table in
    which the two hash arrays agree survives.
    """
    d = data_h.select(id_col, vec_col, "_h", F.posexplode("_h").alias("_t", "_b"))
    q = queries_h.select("q_id", "q_vec", "_qh", F.posexplode("_qh").alias("_t", "_b"))
    # beyond the limit both sides are shuffled on (table, bucket); hot buckets are AQE's to split
    j = d.join(F.broadcast(q) if is_bounded(queries_h) else q, ["_t", "_b"], "inner")
    agree = F.zip_with(F.col("_h"), F.col("_qh"), lambda a, b: a == b)
    first = F.array_position(agree, True) - 1
    return j.filter(F.col("_t") == first).select(
        "q_id", "q_vec", id_col, vec_col, F.col("_t").alias("first_table"))


def lsh_candidates(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str,
                   projs: list[list[float]], bucket_length: float) -> DataFrame:
    """(q_id, q_vec, id, vec, first_table) for pairs sharing >= 1 bucket."""
    d = data.select(id_col, vec_col, lsh_hash_array(F.col(vec_col), projs, bucket_length).alias("_h"))
    q = queries.select("q_id", "q_vec", lsh_hash_array(F.col("q_vec"), projs, bucket_length).alias("_qh"))
    return bucket_join(d, q, id_col, vec_col)


def rank_candidates(cands: DataFrame, id_col: str, vec_col: str, k: int,
                    exclude_self: bool = True, dim: int | None = None) -> DataFrame:
    """Exact distance ranking of candidate pairs: (q_id, id, dist, rank)."""
    if exclude_self:
        cands = cands.filter(F.col(id_col) != F.col("q_id"))
    scored = cands.select("q_id", id_col, l2(F.col(vec_col), F.col("q_vec"), dim).alias("dist"))
    top = topk(scored, ["q_id"], [F.col("dist"), F.col(id_col)], k)
    return top.select("q_id", id_col, F.round("dist", DIGITS).alias("dist"), "rank")


def recall_of(exact: DataFrame, approx: DataFrame, queries: DataFrame, id_col: str, k: int,
              n_rows: int) -> DataFrame:
    """One row: mean over queries of shared neighbours / min(k, rows - 1)."""
    hits = exact.select("q_id", id_col).join(approx.select("q_id", id_col), ["q_id", id_col]) \
                .groupBy("q_id").agg(F.count(F.lit(1)).alias("hits"))
    per_q = queries.select("q_id").join(hits, "q_id", "left")
    return per_q.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg(F.try_divide(F.coalesce(F.col("hits"), F.lit(0)), F.lit(min(k, n_rows - 1)))),
                DIGITS).alias("recall"))


def lsh_topk(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int,
             projs: list[list[float]], bucket_length: float, exclude_self: bool = True) -> DataFrame:
    """Approximate k nearest: exact distance ranking among LSH candidates."""
    c = lsh_candidates(data, queries, id_col, vec_col, projs, bucket_length)
    return rank_candidates(c, id_col, vec_col, k, exclude_self)


def _dots(x: np.ndarray, direction: list[float]) -> np.ndarray:
    """Products of rows with a direction, summed from the first component to the last."""
    total = np.zeros(len(x))
    for i, r in enumerate(direction):
        total += x[:, i] * r
    return total


def _grid_pass(asked: list[tuple], id_type: T.DataType, projs: list[list[float]], lengths, grid: list[tuple], k: int) -> Callable:
    """A task's nearest ``k`` rows of every (grid point, query), and how many candidates it has (rows without an id).

    What is held is ``k`` rows of each, and one batch.
    """
    q_ids, dim = [r[0] for r in asked], len(projs[0])
    q = np.array([r[1] for r in asked], float).reshape(len(asked), dim)
    buckets = lambda x: [np.floor(np.column_stack([_dots(x, r) for r in projs]) / float(b)) for b in lengths]
    q_buckets = buckets(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(id_type)
        best: dict[tuple[int, int], tuple[np.ndarray, pa.Array]] = {}
        counts = np.zeros((len(grid), len(asked)), np.int64)
        for batch in batches:
            ids = batch.column(0).cast(kind)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), dim)
            x_buckets = buckets(x)
            for j, q_id in enumerate(q_ids):
                total = np.zeros(len(x))
                for i in range(dim):
                    d = x[:, i] - q[j, i]
                    total += d * d
                dist = np.sqrt(total)
                other = ~np.array(pa.compute.equal(ids, pa.scalar(q_id, kind)).to_numpy(zero_copy_only=False), bool)
                # first agreeing table per length
                same = [h == g[j] for h, g in zip(x_buckets, q_buckets, strict=True)]
                first = [np.where(s.any(axis=1), s.argmax(axis=1), len(projs)) for s in same]
                for gid, bi, t in [(-1, 0, 0), *grid]:
                    member = other if gid < 0 else other & (first[bi] < t)
                    if gid >= 0:
                        counts[gid, j] += int(member.sum())
                    had_d, had_ids = best.get((gid, j), (np.zeros(0), pa.array([], kind)))
                    if len(had_d) == k:
                        member = member & ~(dist > had_d[-1])
                    places = np.flatnonzero(member)
                    if len(places) > k:                  # no farther than the k-th; ties stay
                        places = places[~(dist[places] > np.partition(dist[places], k - 1)[k - 1])]
                    if not len(places):
                        continue
                    all_d = np.concatenate([had_d, dist[places]])
                    all_ids = pa.concat_arrays([had_ids, ids.take(pa.array(places))])
                    rank = np.empty(len(all_d), int)
                    rank[pa.compute.sort_indices(all_ids).to_numpy()] = np.arange(len(all_d))
                    order = np.lexsort((rank, all_d))[:k]
                    best[gid, j] = all_d[order], all_ids.take(pa.array(order))
        names = ["gid", "q", "id", "dist", "c"]
        for (gid, j), (dist, ids) in best.items():
            n = len(dist)
            yield pa.RecordBatch.from_arrays([pa.array([gid] * n, pa.int32()), pa.array([j] * n, pa.int32()), ids, pa.array(dist),
                                              pa.array([None] * n, pa.int64())], names)
        seen = [(gid, j, int(c)) for (gid, j), c in np.ndenumerate(counts) if c]
        if seen:
            gids, js, cs = zip(*seen, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(gids, pa.int32()), pa.array(js, pa.int32()), pa.nulls(len(cs), kind),
                                              pa.nulls(len(cs), pa.float64()), pa.array(cs, pa.int64())], names)
    return run


def lsh_grid(data: DataFrame, id_col: str, vec_col: str, k: int,
             tables=(1, 3, 5), lengths=(0.5, 1.0, 2.0), percent: int = 10,
             max_queries: int = 50, seed: int = 42, dim: int | None = None) -> DataFrame:
    """Recall@k and candidate fraction for every (tables, bucket length).

    Evaluation needs the exact neighbours, i.e. every (query, row) distance,
    so the whole grid rides on that one pass over the bounded query table,
    which every task has (at most ``max_queries`` rows): each pair gets its
    distance once and, per bucket length, the first table whose buckets
    agree, and counts for the exact list and for every grid point it is a
    candidate of (more tables than its first agreeing one; the directions
    are nested). A task keeps the k nearest of each (grid point, query) and
    the numbers of candidates as it reads, so no pair is sorted or shuffled
    but these; one top-k over the tasks follows. Rows without an id or a
    whole vector take no part in the search. Recall divides by
    min(k, rows - 1); a query without candidates scores 0.
    """
    q = query_set(data, id_col, vec_col, percent, max_queries)
    if dim is None:
        dim = len(data.select(vec_col).first()[0])
    projs = projections(dim, max(tables), seed)
    grid = [(gid, bi, int(t)) for gid, (bi, t) in
            enumerate((bi, t) for bi in range(len(lengths)) for t in tables)]
    whole = lambda c: (F.size(c) == dim) & ~F.exists(c, lambda x: x.isNull())
    asked = q.where(F.col("q_id").isNotNull()).collect()                   # at most ``max_queries`` rows
    usable = [r for r in asked if r["q_vec"] is not None and len(r["q_vec"]) == dim and None not in r["q_vec"]]
    rows = data.where(F.col(id_col).isNotNull() & whole(vec_col)).select(id_col, vec_col)
    id_type = data.schema[id_col].dataType
    schema = T.StructType([T.StructField("gid", T.IntegerType()), T.StructField("q", T.IntegerType()), T.StructField("id", id_type),
                           T.StructField("dist", T.DoubleType()), T.StructField("c", T.LongType())])
    # bounded: (grid points + 1) x queries x k rows of each task
    met = materialize(rows.mapInArrow(_grid_pass([tuple(r) for r in usable], id_type, projs, lengths, grid, k), schema), "lsh_met")
    top = materialize(topk(met.where("c is null").select("gid", "q", "id", "dist"), ["gid", "q"], [F.col("dist"), F.col("id")], k),
                      "lsh_top").select("gid", "q", "id")
    exact = top.filter(F.col("gid") == -1).select("q", "id")
    hits = (top.filter(F.col("gid") >= 0).join(exact, ["q", "id"]).groupBy("gid", "q").agg(F.count(F.lit(1)).alias("hits")))
    counts = met.where("c is not null").groupBy("gid", "q").agg(F.sum("c").alias("c"))
    n = data.count()                                   # one scalar
    # every query once per grid point: the bounded query sample times a
    # literal list of grid points
    points = data.sparkSession.createDataFrame(
        [(j if j < len(usable) else -1 - j, gid, float(lengths[bi]), t) for j in range(len(asked)) for gid, bi, t in grid],
        "q int, gid int, bucket_length double, num_hash_tables int")
    per_q = points.join(hits, ["gid", "q"], "left").join(counts, ["gid", "q"], "left")
    return per_q.groupBy("num_hash_tables", "bucket_length").agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg(F.try_divide(F.coalesce(F.col("hits"), F.lit(0)), F.lit(min(k, n - 1)))),
                DIGITS).alias("recall"),
        F.round(F.avg(F.try_divide(F.coalesce(F.col("c"), F.lit(0)), F.lit(n - 1))),
                DIGITS).alias("candidate_fraction"),
    )


def recall_at_k(data: DataFrame, id_col: str, vec_col: str, k: int, n_tables: int,
                bucket_length: float, **kw) -> DataFrame:
    """One row: mean recall@k of bucket LSH against exact kNN, and the mean
    share of data rows that were candidates (selectivity)."""
    return lsh_grid(data, id_col, vec_col, k, tables=(n_tables,), lengths=(bucket_length,), **kw)


def best_grid_point(grid: DataFrame) -> DataFrame:
    """The grid point with the highest recall; ties keep the first in grid
    order (fewest tables, then shortest bucket length)."""
    return grid.orderBy(F.col("recall").desc(), "num_hash_tables", "bucket_length").limit(1)
