"""Query-directed multi-probe search: one hash table, many buckets of it a query.

A row's bucket is the vector of its cells on ``PROJECTIONS`` random directions.
Near rows that miss the query's bucket mostly lie just across a border, so a query
also looks into the buckets that differ by one cell in some directions, those
first whose borders it is closest to: the sum of squared distances to the borders
crossed orders them. One table does the work of many, and a row is in one bucket
only, so no pair is met twice.

The probes of a query are a table (q_id, bucket, probe); the search is an
equi-join on the bucket and a top-k. Up to ``knn.QUERY_LIMIT`` rows of queries the
probes are broadcast (checked), beyond it both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgefilter.functions.vectors import dot, l2
from edgefilter.operators import knn

PROJECTIONS, WIDTH = 6, 0.15
#: Neighbouring buckets: one cell down, none, or one up in each direction.
BUCKETS = 3 ** PROJECTIONS


def _places(vec: Column, projs: list[list[float]], width: float) -> list[Column]:
    return [dot(vec, F.array(*[F.lit(float(x)) for x in r])) / F.lit(width) for r in projs]


def buckets(data: DataFrame, vec_col: str, projs: list[list[float]], width: float = WIDTH) -> DataFrame:
    """``data`` with ``bucket``, its cell in every direction."""
    return data.withColumn("bucket", F.array(*[F.floor(x) for x in _places(F.col(vec_col), projs, width)]))


def probes(queries: DataFrame, projs: list[list[float]], n_probes: int, width: float = WIDTH) -> DataFrame:
    """(q_id, q_vec, bucket, probe): the ``n_probes`` buckets closest to each query, from 1 on; ties by their number."""
    placed = queries.select("q_id", "q_vec", *[x.alias(f"x{i}") for i, x in enumerate(_places(F.col("q_vec"), projs, width))])
    each = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(3 ** len(projs) - 1))).alias("combo"))
    step = [F.pmod(F.floor(F.col("combo") / 3 ** i), F.lit(3)) - 1 for i in range(len(projs))]
    rest = [F.col(f"x{i}") - F.floor(F.col(f"x{i}")) for i in range(len(projs))]
    cost = [F.when(s == 0, 0.0).when(s < 0, f * f).otherwise((1 - f) * (1 - f)) for s, f in zip(step, rest, strict=True)]
    total = cost[0]
    for c in cost[1:]:
        total = total + c
    scored = each.select("q_id", "q_vec", "combo", total.alias("cost"),
                         F.array(*[F.floor(F.col(f"x{i}")) + s for i, s in enumerate(step)]).alias("bucket"))
    best = Window.partitionBy("q_id").orderBy("cost", "combo")           # a query has 3^directions rows here
    return scored.withColumn("probe", F.row_number().over(best)).where(F.col("probe") <= n_probes).select(
        "q_id", "q_vec", "bucket", "probe")


def candidates(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, projs: list[list[float]], n_probes: int,
               width: float = WIDTH) -> DataFrame:
    """(q_id, q_vec, id, vec, probe): each row that some probe meets, once, without the query itself."""
    asked = probes(queries, projs, n_probes, width)
    held = buckets(data.select(id_col, vec_col), vec_col, projs, width)
    side = F.broadcast(asked) if knn.is_bounded(queries, knn.QUERY_LIMIT // n_probes) else asked
    return held.join(side, "bucket").where(F.col(id_col) != F.col("q_id")).select("q_id", "q_vec", id_col, vec_col, "probe")


def search(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, projs: list[list[float]], n_probes: int,
           width: float = WIDTH) -> DataFrame:
    """(q_id, id, dist, rank) of the k nearest rows among the probed buckets."""
    return knn.rank_candidates(candidates(data, queries, id_col, vec_col, projs, n_probes, width), id_col, vec_col, k)


def recall_by_probes(data: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, projs: list[list[float]],
                     numbers: list[int], width: float = WIDTH) -> DataFrame:
    """(n_probes, recall, candidate_fraction) for each number of probes.

    One pass over rows and (bounded) queries: a pair's distance and the probe
    that meets it. What is met by the first n probes follows from that.
    """
    met = candidates(data, queries, id_col, vec_col, projs, max(numbers), width).select(
        "q_id", id_col, "probe", l2(F.col(vec_col), F.col("q_vec")).alias("dist"))
    exact = knn.exact_knn(data, queries, id_col, vec_col, k).select("q_id", id_col, F.lit(1).alias("near"))
    n, m = data.count(), queries.count()
    found = met.join(exact, ["q_id", id_col], "left")
    cells = [x for p in numbers for x in (F.count_if((F.col("probe") <= p) & F.col("near").isNotNull()).alias(f"h{p}"),
                                          F.count_if(F.col("probe") <= p).alias(f"c{p}"))]
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("n_probes"), F.col(f"h{p}").alias("h"), F.col(f"c{p}").alias("c"))
                               for p in numbers]))
    return found.agg(*cells).select(rows.alias("r")).select(
        "r.n_probes", F.round(F.col("r.h") / (m * min(k, n - 1)), 6).alias("recall"),
        F.round(F.col("r.c") / (m * (n - 1)), 6).alias("candidate_fraction"))
