"""The pivot join against exact distances of all pairs."""

import math
import random

from conftest import SF01
from pyspark.sql import functions as F

from edgefilter.operators import knn
from edgefilter.operators.knn_join import compared_pairs, knn_join


def asked(df):
    return df.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_vec"))


def plain(rows, queries, k):
    out = set()
    for q, x in queries:
        near = sorted((math.dist(x, y), i) for i, y in rows if i != q)[:k]
        out |= {(q, i, r + 1) for r, (_, i) in enumerate(near)}
    return out


def triples(df):
    return {(r.q_id, r.vec_id, r["rank"]) for r in df.collect()}


def test_equals_exact_search(spark):
    v = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    want = {tuple(r) for r in knn.exact_knn(v, asked(v), "vec_id", "embedding", 10).collect()}
    assert {tuple(r) for r in knn_join(v, asked(v), "vec_id", "embedding", 10).collect()} == want


def test_looks_at_few_pairs_where_there_are_clusters(spark):
    """The given embeddings are noise on a sphere, where no bound rules out a pair; with clusters few are left."""
    rng = random.Random(1)
    centres = [[rng.gauss(0, 4) for _ in range(8)] for _ in range(20)]
    rows = [(i, [c + rng.gauss(0, 1) for c in centres[i % 20]]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert triples(knn_join(df, asked(df), "vec_id", "embedding", 5)) == plain(rows, rows, 5)
    assert compared_pairs(df, asked(df), "vec_id", "embedding", 5).first().n_pairs < 0.25 * 600 * 599


def test_copies_small_cells_and_blocks(spark):
    rng = random.Random(2)
    rows = [(i, [0.5, 0.5]) for i in range(60)] + [(100 + i, [rng.gauss(0, 1), rng.gauss(9 * (i % 2), 1)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = triples(knn_join(df, asked(df), "vec_id", "embedding", 4, pivots=7, block=16))
    assert got == plain(rows, rows, 4)


def test_more_neighbours_than_a_cell_holds(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random(), rng.random(), rng.random()]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (15, 39, 100):
        assert triples(knn_join(df, asked(df), "vec_id", "embedding", k, pivots=6)) == plain(rows, rows, k)


def test_edge_rows(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (None, [5.0, 5.0]), (4, None), (5, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = triples(knn_join(df, asked(df), "vec_id", "embedding", 3, pivots=1))
    assert got == {(1, 2, 1), (2, 1, 1)}
    assert knn_join(df.where("false"), asked(df), "vec_id", "embedding", 3).collect() == []


def test_exact_search_beyond_the_limit_is_the_join(spark, monkeypatch):
    v = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    want = triples(knn.exact_knn(v, asked(v), "vec_id", "embedding", 3))
    monkeypatch.setattr(knn, "QUERY_LIMIT", 10)
    monkeypatch.setattr(knn, "is_bounded", lambda q, limit=10: False)
    assert triples(knn.exact_knn(v, asked(v), "vec_id", "embedding", 3)) == want


def test_copies_are_compared_once(spark):
    rng = random.Random(4)
    rows = [(i, [0.25, 0.5]) for i in range(400)] + [(400 + i, [rng.random(), rng.random()]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert triples(knn_join(df, asked(df), "vec_id", "embedding", 3)) == plain(rows, rows, 3)
    assert compared_pairs(df, asked(df), "vec_id", "embedding", 3).first().n_pairs < 0.1 * 500 * 499


def test_repeated_ids_and_rows_that_are_no_vectors(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [0.0, 4.0]), (4, [0.0, 9.0])]
    odd = [(5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]), (7, [None, 0.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    ask = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 2.0])], "q_id long, q_vec array<double>")
    assert triples(knn_join(df, ask, "vec_id", "embedding", 2)) == {(1, 2, 1), (1, 3, 2), (2, 1, 1), (2, 1, 2)}
