"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgefilter.llm.common import by_rows
from edgefilter.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's (larger | smaller) neighbours are hung on its smallest one.

    The minima are written before they are joined back, so the join sees two
    plain shuffles and a node with very many links is split by AQE.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star")
    joined = by_rows(both).join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return materialize(out.where("a <> b").distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the smallest node of its component.

    ``edges`` has longs ``a`` and ``b`` in any order. Links and labels stay in
    written tables of the shared folder; the driver sees two sums a round. The
    rounds end when a round changes nothing: links only ever move to smaller
    nodes, so that comes, after about the logarithm of the longest chain.
    """
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    seen = None
    while True:
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        cur = _star(_star(cur, large=True), large=False)
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
