"""Vector arithmetic as JVM higher-order expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays, in double."""
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def sq_l2_unrolled(a: Column, b: Column, dim: int) -> Column:
    """Squared distance for a known dimension as plain element arithmetic.

    Higher-order functions are evaluated outside whole-stage code generation;
    the unrolled sum compiles. Measured on one million pairs of 64-d vectors
    over a plain scan it is ~4x faster per pair, but inside the kNN plans at
    the test scales it costs 1.5-2 s more per query, so it is opt-in (pass
    ``dim`` to :func:`l2`) for inputs of many millions of pairs. Summation
    order is the same left-to-right order as :func:`sq_l2`, so values are
    identical. A shorter vector yields NULL, as with ``zip_with``.
    """
    acc = F.lit(0.0).cast("double")
    for i in range(1, dim + 1):
        d = F.try_element_at(a, F.lit(i)).cast("double") - F.try_element_at(b, F.lit(i)).cast("double")
        acc = acc + d * d
    return F.when(F.size(a) == F.size(b), acc)


def l2(a: Column, b: Column, dim: int | None = None) -> Column:
    """Euclidean distance; unrolled into compiled arithmetic when ``dim`` is known."""
    return F.sqrt(sq_l2(a, b) if dim is None else sq_l2_unrolled(a, b, dim))


def dot(a: Column, b: Column) -> Column:
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"),
                              lambda acc, v: acc + v.cast("double") * v.cast("double")))


def normalize(a: Column) -> Column:
    """Unit-length copy; the zero vector stays zero (as ML's Normalizer does)."""
    n = l2_norm(a)
    return F.when(n > 0, F.transform(a, lambda v: v.cast("double") / n)) \
            .otherwise(F.transform(a, lambda v: v.cast("double") * 0.0))
