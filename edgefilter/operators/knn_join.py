"""Exact k nearest neighbours for any number of queries: pivots, cells, pairs of blocks.

Nothing is broadcast but the pivots and their cells' sizes, bounded lists. Equal
vectors are compared once: queries with one vector share its search, and of the
rows with one vector only the smallest ids, as many as a search can need, are kept.

Every row belongs to the cell of its nearest pivot. Cells are packed into blocks
of a bounded number of rows, for data and for queries; a large cell (a dense spot)
is cut into several by a hash. A query's k-th distance is first bounded by what its
own cell holds; then it meets only the cells that the triangle inequality does not
rule out. A cell j is left out if the query is farther than the bound from the plane
between its own pivot i and j:
(|q p_j|^2 - |q p_i|^2) / (2 |p_i p_j|) > bound,
or farther from p_j than the cell's radius and the bound together.

The rows of a block of queries and of a block of data meet in one group (numpy): a
matrix product gives squared distances with a known error, what may be among the
nearest within that error is worked out exactly, in double precision, component
after component. Where no cell can be ruled out (noise in many dimensions) all pairs
are compared, as they must be; blocks grow with the rows, up to a bound, so that
rows are copied to few groups. The best k of a query are kept by :func:`knn.topk`.

Rows without an id or vector, or whose vector is not as long as the pivots' or holds
a null or non-finite component, take no part. Ties go to the smaller id. Rows that
repeat an id are all left out of the answer to that id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.functions.hashing import md5_u32
from edgefilter.operators import knn
from edgefilter.session import materialize

#: Most pivots, a bound that the data don't change, and rows of a block: from ``BLOCK`` to ``GROWN`` times as many.
PIVOTS, BLOCK, GROWN = 256, 4096, 8
#: Blocks that the rows are cut into before blocks grow.
_BLOCKS = 16
#: Queries of a cell compared together, and numbers of a matrix at once.
_TOGETHER, _CELLS = 16, 1 << 21


def choose_pivots(data: DataFrame, id_col: str, vec_col: str, most: int = PIVOTS) -> list[list[float]]:
    """The vectors of smallest id hash, at most ``most``; about the square root of the rows."""
    n = data.count()
    many = max(1, min(most, math.isqrt(n)))
    rows = data.orderBy(md5_u32(F.col(id_col)), F.col(id_col)).select(vec_col).limit(many).collect()
    return [list(map(float, p)) for p in dict.fromkeys(tuple(r[0]) for r in rows)]


# -- vectors in tasks -----------------------------------------------------
def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dim)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of equal place, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        d = a[:, i] - b[:, i]
        total += d * d
    return np.sqrt(total)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = _exact(x, np.broadcast_to(p, x.shape))
    return out


def _with_cells(df: DataFrame, vec: str, pivots: np.ndarray) -> DataFrame:
    """``df`` with ``cell`` and ``far``, the distance to its pivot."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fars = _to_pivots(_vectors(batch.column(vec), pivots.shape[1]), pivots)
            cell = fars.argmin(axis=1) if len(fars) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()),
                                              pa.array(fars[np.arange(len(cell)), cell])], schema.names)

    return df.mapInArrow(run, schema)


def _may_meet(asked: DataFrame, pivots: np.ndarray, reach: dict[int, float], sizes: dict[int, int], need: int) -> DataFrame:
    """``asked`` (with bound) and ``cells``, those that the triangle inequality does not rule out.

    Without a bound that of the cells' farthest possible rows holds, nearest cells
    first, until ``need`` rows are certain.
    """
    schema = T.StructType([*asked.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    known = np.array(sorted(reach))
    radius = np.array([reach[c] for c in known.tolist()])
    many = np.array([sizes[c] for c in known.tolist()])
    gaps = _to_pivots(pivots, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fars = _to_pivots(_vectors(batch.column("q_vec"), pivots.shape[1]), pivots)
            mine = batch.column("cell").to_numpy(zero_copy_only=False)
            there = fars[:, known]
            far = np.argsort(there + radius, axis=1)
            enough = np.cumsum(many[far], axis=1) >= need
            certain = np.where(enough.any(axis=1), np.take_along_axis(there + radius, far, axis=1)[
                np.arange(len(mine)), enough.argmax(axis=1)], 1e300)
            bound = np.minimum(batch.column("bound").to_numpy(zero_copy_only=False), certain)[:, None]
            bound = bound * (1 + 1e-9) + 1e-9                                                           # rounding
            own = fars[np.arange(len(mine)), mine][:, None]
            with np.errstate(over="ignore", invalid="ignore"):
                meets = ~(there - radius > bound) & ~(there * there - own * own > 2 * gaps[mine][:, known] * bound + 1e-9)
            ends = np.concatenate([[0], np.cumsum(meets.sum(axis=1))])
            cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(known[np.nonzero(meets)[1]], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], schema.names)

    return asked.mapInArrow(run, schema)


def _smallest(q: np.ndarray, rows: np.ndarray, norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, row) of all pairs that may be among a query's k nearest rows."""
    own = (q * q).sum(axis=1)[:, None]
    with np.errstate(over="ignore", invalid="ignore"):
        d = own + norms - 2 * (q @ rows.T)
        error = 4 * (q.shape[1] + 8) * np.finfo(float).eps * (own[:, 0] + norms.max())
        n, size = len(rows), 16
        if n <= k:
            return np.nonzero(np.ones_like(d, bool))
        # k groups of columns whose least entry is below a limit hold k rows below it
        limit = d if n < size * k * 2 else np.minimum.reduceat(d, np.arange(0, n, size), axis=1)
        limit = np.partition(limit, k - 1, axis=1)[:, k - 1] + 2 * error
        return np.nonzero(~(d > limit[:, None]))


def _compare(k: int, pivots: np.ndarray, count: bool) -> Callable:
    """The ``k`` nearest of a block's rows to each query of another block, as (q_id, id, dist); or the number of pairs."""
    dim = pivots.shape[1]

    def run(asked: pa.Table, data: pa.Table) -> pa.Table:
        order = np.lexsort((data.column("far").to_numpy(), data.column("cell").to_numpy()))
        cell, ids = data.column("cell").to_numpy()[order], data.column("id").combine_chunks().take(pa.array(order))
        s_far = data.column("far").to_numpy()[order]
        rows = _vectors(data.column("vec"), dim)[order]
        rank = np.empty(len(ids), int)                      # order of ids, of whatever type they are
        rank[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        norms = (rows * rows).sum(axis=1)
        known, starts = np.unique(cell, return_index=True)
        stops = np.append(starts[1:], len(cell))
        place = {c: i for i, c in enumerate(known.tolist())}
        mine = asked.column("cell").to_numpy()
        queries, wanted = _vectors(asked.column("q_vec"), dim), asked.column("cells").combine_chunks()
        bound = asked.column("bound").to_numpy()
        flat, ends = wanted.flatten().to_numpy(), np.concatenate([[0], np.cumsum(wanted.value_lengths().to_numpy())])
        out_q, out_row, out_d, pairs = [], [], [], 0
        by_cell = np.argsort(mine, kind="stable")
        for group in np.split(by_cell, np.flatnonzero(np.diff(mine[by_cell])) + 1) if len(by_cell) else []:
            group = group[np.argsort(bound[group], kind="stable")]
            for start in range(0, len(group), _TOGETHER):
                part = group[start:start + _TOGETHER]
                cells = np.unique(np.concatenate([flat[ends[i]:ends[i + 1]] for i in part.tolist()]))
                spans = [place[c] for c in cells.tolist() if c in place]
                # rows of a cell as far from its pivot as a query, give or take its bound
                q_far, slack = _to_pivots(queries[part], pivots[known[spans]]), (bound[part] * (1 + 1e-9) + 1e-9)[:, None]
                least, most = (q_far - slack).min(axis=0), (q_far + slack).max(axis=0)
                pick = np.concatenate([np.arange(starts[s] + np.searchsorted(s_far[starts[s]:stops[s]], a, "left"),
                                                 starts[s] + np.searchsorted(s_far[starts[s]:stops[s]], b, "right"))
                                       for s, a, b in zip(spans, least, most, strict=True)]) if spans else np.zeros(0, int)
                pairs += len(part) * len(pick)
                if count or not len(pick):
                    continue
                whole = len(pick) == len(rows)
                a, b = _smallest(queries[part], rows if whole else rows[pick], norms if whole else norms[pick], k)
                a, b = part[a], pick[b]
                d = np.concatenate([_exact(queries[a[i:i + _CELLS // dim]], rows[b[i:i + _CELLS // dim]])
                                    for i in range(0, len(a), max(1, _CELLS // dim))])
                near = ~(d > bound[a])
                a, b, d = a[near], b[near], d[near]
                best = np.lexsort((rank[b], d, a))
                a, b, d = a[best], b[best], d[best]
                first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, int)
                nth = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
                out_q.append(a[nth < k]), out_row.append(b[nth < k]), out_d.append(d[nth < k])
        if count:
            return pa.table({"n": pa.array([pairs], pa.int64())})
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"q_id": asked.column("q_id").combine_chunks().take(pa.array(join(out_q, int))),
                         "id": ids.take(pa.array(join(out_row, int))), "dist": pa.array(join(out_d, float))})
    return run


# -- blocks ---------------------------------------------------------------
class _Blocks:
    """Which block a row of a cell lies in: small cells share one, a large cell has several."""

    def __init__(self, sizes: dict[int, int], order: list[int], block: int):
        size = max(block, min(GROWN * block, math.ceil(sum(sizes.values()) / _BLOCKS)))
        self.first, self.many, at, held = {}, {}, 0, 0
        for c in order:
            n = sizes.get(c, 0)
            if n and held and held + n > size:
                at, held = at + 1, 0
            self.first[c], self.many[c] = at, max(1, math.ceil(n / size))
            held += n
            if self.many[c] > 1:
                at, held = at + self.many[c], 0

    def of(self, cell: Column, key: Column) -> Column:
        first, many = (F.array(*[F.lit(d[c]) for c in sorted(d)]) for d in (self.first, self.many))
        return F.element_at(first, cell + 1) + F.pmod(F.xxhash64(key), F.element_at(many, cell + 1)).cast("int")

    def all_of(self, cells: Column) -> Column:
        """Every block that holds rows of ``cells``."""
        held = F.array(*[F.array(*[F.lit(self.first[c] + i) for i in range(self.many[c])]) for c in sorted(self.first)])
        return F.array_distinct(F.flatten(F.transform(cells, lambda c: F.element_at(held, c + 1))))


def _finite(vec: str) -> Column:
    v = F.col(vec)
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


class _Join:
    """The steps of a join; :meth:`nearest` for the result, :meth:`pairs` for the distances worked out."""

    def __init__(self, data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, exclude_self: bool, pivots: int,
                 block: int):
        data = data.where(F.col(id_col).isNotNull() & _finite(vec_col)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
        queries = queries.where(F.col("q_id").isNotNull() & _finite("q_vec")).select("q_id", "q_vec")
        points = choose_pivots(data, "id", "vec", pivots)
        self.dim = len(points[0]) if points else 0
        self.pivots = np.array([p for p in points if len(p) == self.dim]).reshape(-1 if self.dim else 0, self.dim)
        data, queries = data.where(F.size("vec") == self.dim), queries.where(F.size("q_vec") == self.dim)
        # a search by vector must also hold the rows that an id leaves out
        spare = (data.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) if exclude_self else 0
        self.k, self.need = k, k + spare
        self.empty = not self.dim
        if self.empty:
            self.members = queries
            return
        data = knn.topk(data, ["vec"], [F.col("id")], self.need).select("id", "vec")
        self.rows = materialize(_with_cells(data, "vec", self.pivots), "cells")
        # lists of at most ``pivots`` rows
        stats = {r["cell"]: r for r in self.rows.groupBy("cell").agg(F.max("far").alias("reach"), F.count("*").alias("n")).collect()}
        self.reach, sizes = {c: r["reach"] for c, r in stats.items()}, {c: r["n"] for c, r in stats.items()}
        self.members = materialize(queries, "queries")
        one = self.members.groupBy("q_vec").agg(F.min("q_id").alias("q_id")).select("q_id", "q_vec")
        self.asked = materialize(_with_cells(one, "q_vec", self.pivots), "asked")
        asked_of = {r["cell"]: r["n"] for r in self.asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        order = np.argsort(_to_pivots(self.pivots, self.pivots)[0], kind="stable").tolist()
        self.blocks, self.ask_blocks = _Blocks(sizes, order, block), _Blocks(asked_of, order, block)
        self.sizes = sizes

    def _met(self, asked: DataFrame, count: bool) -> DataFrame:
        """(q_id, id, dist) of what is near in every block that holds cells of ``cells``."""
        asked = asked.withColumn("q_block", self.ask_blocks.of(F.col("cell"), F.col("q_id"))).withColumn(
            "block", F.explode(self.blocks.all_of(F.col("cells"))))
        asked = materialize(asked.select("q_id", "q_vec", "cell", "cells", "bound", "q_block", "block"), "meets")
        pairs = materialize(asked.select("q_block", "block").distinct(), "block_pairs")
        many = max(1, min(pairs.count(), 4096))
        rows = self.rows.withColumn("block", self.blocks.of(F.col("cell"), F.col("id"))).join(F.broadcast(pairs), "block")
        schema = "n long" if count else T.StructType([self.asked.schema["q_id"], self.rows.schema["id"],
                                                      T.StructField("dist", T.DoubleType())])
        group = ["q_block", "block"]
        return asked.repartition(many, *group).groupBy(*group).cogroup(
            rows.select("id", "vec", "cell", "far", *group).repartition(many, *group).groupBy(*group)).applyInArrow(
                _compare(self.need, self.pivots, count), schema)

    def first(self, count: bool = False) -> DataFrame:
        """What every query meets in its own cell."""
        own = self.asked.withColumn("cells", F.array("cell")).withColumn("bound", F.lit(float("inf")))
        return self._met(own, count)

    def second(self, count: bool = False) -> DataFrame:
        """What every query meets in the cells that its bound leaves."""
        near = knn.topk(self.first(), ["q_id"], [F.col("dist"), F.col("id")], self.need)
        bounds = near.groupBy("q_id").agg(F.max("dist").alias("bound"), F.count("*").alias("found"))
        # a cell that holds too few says nothing: the query meets all cells
        found = F.when(F.col("found") >= self.need, F.col("bound")).otherwise(float("inf"))
        bounded = materialize(self.asked.join(bounds, "q_id", "left").withColumn("bound", F.coalesce(found, F.lit(float("inf"))))
                              .select("q_id", "q_vec", "cell", "far", "bound"), "bounds")
        return self._met(_may_meet(bounded, self.pivots, self.reach, self.sizes, self.need), count)

    def nearest(self) -> DataFrame:
        near = knn.topk(self.second(), ["q_id"], [F.col("dist"), F.col("id")], self.need)
        return near.select(F.col("q_id").alias("asked"), "id", "dist")


def knn_join(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, exclude_self: bool = True,
             pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(q_id, id, dist, rank) of the k nearest rows of ``data`` to each row (q_id, q_vec) of ``queries``."""
    join = _Join(data, queries, id_col, vec_col, k, exclude_self, pivots, block)
    if join.empty:
        none = data.select(F.col(id_col).alias("id")).where("false")
        return join.members.select("q_id").where("false").join(none).select(
            "q_id", F.col("id").alias(id_col), F.lit(0.0).alias("dist"), F.lit(0).alias("rank"))
    same = join.asked.select(F.col("q_id").alias("asked"), "q_vec")
    found = join.members.join(same, "q_vec").select("q_id", "asked").join(materialize(join.nearest(), "nearest"), "asked")
    if exclude_self:
        found = found.where(F.col("id") != F.col("q_id"))
    top = knn.topk(found, ["q_id"], [F.col("dist"), F.col("id")], k)
    return top.select("q_id", F.col("id").alias(id_col), F.round("dist", knn.DIGITS).alias("dist"), "rank")


def compared_pairs(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, exclude_self: bool = True,
                   pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """One row: distances worked out between queries and rows, those of the first bound included."""
    join = _Join(data, queries, id_col, vec_col, k, exclude_self, pivots, block)
    if join.empty:
        return join.members.agg(F.lit(0).cast("bigint").alias("n_pairs"))
    return join.first(True).union(join.second(True)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
