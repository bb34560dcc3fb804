"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

An entry c becomes the integer x = floor(64 c) + 1000000. Mean and covariance are
those of the fit list, each distinct x vector once.

1. Sums and number of the fit list, exact, in one aggregate.
2. Each task reduces its centred rows to a triangle R by QR, block after block;
   triangles are stacked and reduced again in groups of ``FAN_IN`` tasks until
   one is left: R'R = n V, without ever forming the covariance V. A task holds
   one block of rows and some dim x dim triangles.
3. On that one triangle: Householder reflections make it bidiagonal; dqds (qd
   steps with shifts that are known to be too small, or are taken back) finds
   the squares of its singular values to high relative accuracy; a twisted
   factorisation of T - s^2 at the place of its least pivot gives each vector,
   one solve. Values that lie close together get theirs by inverse iteration
   with the same factorisation, each held orthogonal to those before it. The
   reflections take the vectors back to directions.
4. Every row is projected: (x - mean) . direction / sqrt(e); the covariance of
   the projected fit list is measured against the identity.

Defined cases: rows whose vector is null, empty, or holds null, non-finite or
too large entries (64 |c| of 2^52 and more) are dropped, as are those not of the
most frequent length (ties: the longer); repeated rows are reported each, null
ids stay; a component without variance (all rows equal, fewer rows than
dimensions) has a null ``whitened`` and counts not for the identity; a deviation
that is no long is null; other columns are ignored, so their names can't clash;
empty tables give no rows. Vectors of very many dimensions d cost d^2 numbers of
memory in each task and on the driver, and d^3 steps there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import register, table
from edgefilter.session import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
FAN_IN = 16
_EPS = np.finfo(float).eps
#: Relative distance of two values under which their vectors are held orthogonal explicitly.
_CLOSE = 1e-3
_SEED = 12


# -- 3. the triangle ------------------------------------------------------
def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, upper diagonal b and right factor v with r = u B v' (Householder; u isn't formed)."""
    a = np.array(r, float)
    d = a.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray:
        w = x.copy()
        size = math.sqrt(float(w @ w))
        if size == 0:
            return w
        w[0] += math.copysign(size, w[0])
        return w / math.sqrt(float(w @ w))

    for k in range(d):
        w = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k + 2 < d:
            w = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One step: (q, e) of the shifted matrix and the ds of the step; None if the shift was too large."""
    d, qs, es, ds = q[0] - shift, [], [], []
    for i in range(len(e)):
        if d < 0:
            return None
        ds.append(d)
        top = d + e[i]
        qs.append(top)
        if top == 0:
            es.append(0.0)
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / top
            es.append(e[i] * t)
            d = d * t - shift
    if d < 0:
        return None
    return [*qs, d], es, [*ds, d]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix (a, b), falling."""
    found: list[float] = []
    work = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while work:
        q, e, shifted = work.pop()
        while q:
            if len(q) == 1:
                found.append(q.pop() + shifted)
                break
            if e[-1] <= _EPS ** 2 * (shifted + q[-1]):
                found.append(q.pop() + shifted)
                e.pop()
                continue
            cut = next((i for i, x in enumerate(e) if x <= _EPS ** 2 * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], shifted))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            q, e, ds = _dqds(q, e, 0.0)
            least = min(ds)
            if least == 0:
                continue
            # 1 / sum(1 / d) is a lower bound of the least value, min(d) an upper one
            safe = (1 - 8 * len(q) * _EPS) / sum(1 / x for x in ds)
            for shift in (0.98 * least, safe):
                step = _dqds(q, e, shift)
                if step is not None:
                    q, e, _ = step
                    shifted += shift
                    break
    return np.sort(np.maximum(found, 0.0))[::-1]


class Twisted:
    """T - value = N D N' of the tridiagonal T = B'B, twisted where the pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        q, e, off = a * a, b * b, a[:-1] * b
        tiny = max(_EPS * _EPS * max(float(q.max(initial=0)), float(e.max(initial=0))), np.finfo(float).tiny)
        solid = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
        down, s = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            down[i] = solid(s[i] + q[i])
            s[i + 1] = s[i] * (e[i] / down[i]) - value
        up, p = np.empty(n), np.empty(n)
        p[-1] = q[-1] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = solid(e[i] + p[i + 1])
            p[i] = p[i + 1] * (q[i] / up[i + 1]) - value
        gamma = s + p + value
        self.at = r = int(np.argmin(np.abs(gamma)))
        self.low = off[:r] / down[:r]
        self.high = off[r:] / up[r + 1:]
        self.pivot = np.concatenate([down[:r], [solid(float(gamma[r]))], up[r + 1:]])

    def solve(self, x: np.ndarray) -> np.ndarray:
        """A vector along (T - value)^-1 x, of length one."""
        r, n = self.at, len(self.pivot)
        w = x.copy()
        for i in range(1, r + 1):
            w[i] -= self.low[i - 1] * w[i - 1]
        for i in range(n - 2, r - 1, -1):
            w[i] -= self.high[i - r] * w[i + 1]
        w /= self.pivot
        for i in range(r - 1, -1, -1):
            w[i] -= self.low[i] * w[i + 1]
        for i in range(r, n - 1):
            w[i + 1] -= self.high[i - r] * w[i]
        w /= np.abs(w).max()
        return w / math.sqrt(float(w @ w))

    def vector(self) -> np.ndarray:
        x = np.zeros(len(self.pivot))
        x[self.at] = 1.0
        return self.solve(x)


def _block_vectors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (falling) and vectors (columns) of T = B'B of an unreduced block."""
    values = squares(a, b)
    rng = np.random.default_rng(_SEED)
    out = np.zeros((len(a), len(a)))
    near: list[int] = []            # the vectors of the values close to this one
    for k, value in enumerate(values):
        if near and values[near[-1]] - value > max(_CLOSE * values[near[-1]], 64 * _EPS * values[0]):
            near = []
        part = Twisted(a, b, float(value))
        x = part.vector()
        if near:
            basis = out[:, near]
            x = x - basis @ (basis.T @ x)
            for _ in range(4):
                size = math.sqrt(float(x @ x))
                x = x / size if size > 1e-6 else rng.standard_normal(len(a))
                x = part.solve(x - basis @ (basis.T @ x))
                x = x - basis @ (basis.T @ x)
            x = x - basis @ (basis.T @ x)
            x /= math.sqrt(float(x @ x))
        out[:, k] = x
        near.append(k)
    return values, out


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values (falling) and right singular vectors (columns) of a square matrix."""
    a, b, v = bidiagonal(r)
    size = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    b[np.abs(b) <= _EPS * size * 1e-3] = 0.0
    values, vectors, start = [], [], 0
    for stop in [*(np.flatnonzero(b == 0) + 1).tolist(), len(a)]:
        value, own = _block_vectors(a[start:stop], b[start:stop - 1])
        values.append(value)
        vectors.append(v[:, start:stop] @ own)
        start = stop
    value = np.concatenate(values)
    order = np.argsort(-value, kind="stable")
    return value[order], np.concatenate(vectors, axis=1)[:, order]


# -- 1., 2. sums and triangles --------------------------------------------
def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _whole_sum(x: np.ndarray) -> list[int]:
    if np.abs(x).max(initial=0) * float(len(x)) < 2**62:
        return x.sum(axis=0).tolist()
    return [int(s) for s in x.astype(object).sum(axis=0)]


def _sums(dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _rows(batch, dim)
            n += len(x)
            total = [a + b for a, b in zip(total, _whole_sum(x), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array(total, pa.decimal128(38, 0))], ["k", "n", "total"])
    return run


@dataclass
class Mean:
    """The mean as whole part and remainder over n, so that differences from it are exact before they are rounded."""
    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2; None where that is no long."""
        far = self.n * (x - self.whole).astype(float) - self.rest
        if (far * far).sum(axis=1).max(initial=0) < 2**62:
            y = self.n * (x - self.whole) - self.rest
            return (y * y).sum(axis=1).tolist()
        y = self.n * (x - self.whole).astype(object) - self.rest.astype(object)
        return [s if s < 2**63 else None for s in map(int, (y * y).sum(axis=1))]


def _triangle(rows: np.ndarray, dim: int) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == dim else np.vstack([r, np.zeros((dim - len(r), dim))])


def _triangles(mean: Mean, dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, part = None, 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                rows = mean.centred(_rows(batch, dim))
                r = _triangle(rows if r is None else np.vstack([r, rows]), dim)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel().tolist()])], ["part", "r"])
    return run


def _stacked(dim: int) -> Callable:
    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.sort_by("part").column("r").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([_triangle(rows, dim).ravel().tolist()])})
    return run


# -- the operator ---------------------------------------------------------
@dataclass
class Whitening:
    """What is fitted: mean, variances (falling) and directions (columns) of the first components, their sum of all."""
    dim: int
    mean: Mean
    variances: np.ndarray
    directions: np.ndarray
    total: float

    @property
    def alive(self) -> np.ndarray:
        return self.variances > self.dim * _EPS * self.variances.max(initial=0) * 8

    def project(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.alive, np.sqrt(np.where(self.alive, self.variances, 1.0)), np.nan)
        return (self.mean.centred(x) @ self.directions) / scale


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows that take part, in integers."""
    c = F.col(vec_col)
    fits = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) * SCALE < float(2**52)))
    x = F.transform(c, lambda e: F.floor(SCALE * e.cast("double")) + F.lit(SHIFT))
    return vectors.where(c.isNotNull() & (F.size(c) > 0) & fits).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of :func:`usable` rows and the fit list; None if there is no row."""
    size = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if size is None:
        return None
    dim = size["dim"]
    fit_list = materialize(rows.where(F.size("x") == dim).select("x").distinct(), "fit_list")
    sums = fit_list.mapInArrow(_sums(dim), "k int, n long, total decimal(38,0)").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("k").collect()       # one row a dimension
    n = sums[0]["n"]
    whole, rest = zip(*(divmod(int(s["total"]), n) for s in sums), strict=True)
    mean = Mean(n, np.array(whole, np.int64), np.array(rest, np.int64))

    held = materialize(fit_list.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
        _triangles(mean, dim), "part long, r array<double>"), "triangles")
    parts = held.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        held = materialize(held.groupBy(F.floor(F.col("part") / FAN_IN).alias("grp")).applyInArrow(
            _stacked(dim), "part long, r array<double>"), "triangles")
    r = np.array(held.first()["r"]).reshape(dim, dim)                                        # one triangle
    values, vectors = right_vectors(r)
    first = min(components, dim)
    return Whitening(dim, mean, values[:first] / n, vectors[:, :first], float(values.sum()) / n), fit_list


def identity_error(w: Whitening, fit_list: DataFrame) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on its rows."""
    keep, dim = np.flatnonzero(w.alive), w.dim
    m = len(keep)
    if not m:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, m))
        for batch in batches:
            y = w.project(_rows(batch, dim))[:, keep]
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(m * m), pa.int32()), pa.array(total.ravel())], ["k", "s"])

    cells = fit_list.mapInArrow(products, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()
    covariance = np.array([c["s"] for c in cells]).reshape(m, m) / w.mean.n
    return float(np.abs(covariance - np.eye(m)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = usable(vectors, id_col, vec_col)
    schema = T.StructType([rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in (
                               "whitened", "explained", "identity_error"))])
    fitted = fit(rows, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    w, fit_list = fitted
    error = identity_error(w, fit_list)
    m, share = len(w.variances), w.variances / w.total if w.total > 0 else np.zeros(len(w.variances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, w.dim)
            k = len(x)
            y = w.project(x).ravel()
            each = pa.array(np.repeat(np.arange(k), m))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)),
                 pa.array(np.full(k * m, w.mean.n)), pa.array(w.mean.deviations(x), pa.int64()).take(each),
                 pa.array(y, mask=np.isnan(y)), pa.array(np.tile(share, k)),
                 pa.array([error] * (k * m), pa.float64())], schema.names)

    return rows.where(F.size("x") == w.dim).mapInArrow(run, schema)


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
