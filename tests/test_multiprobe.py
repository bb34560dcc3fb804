"""Multi-probe search: probe order against a plain enumeration, recall where rows lie in clusters."""

import itertools
import math
import random

from edgefilter.operators import knn
from edgefilter.operators import multiprobe as MP


def test_probe_order_equals_plain_enumeration(spark):
    rng = random.Random(6)
    projs = knn.projections(5, 3, 1)
    queries = [(f"q{i}", [rng.gauss(0, 1) for _ in range(5)]) for i in range(4)]
    got = {}
    for r in MP.probes(spark.createDataFrame(queries, "q_id string, q_vec array<double>"), projs, 12, 0.5).collect():
        got[r.q_id, r.probe] = tuple(r.bucket)
    for q, v in queries:
        x = [sum(a * b for a, b in zip(v, p)) / 0.5 for p in projs]
        order = []
        for combo, steps in enumerate(itertools.product((-1, 0, 1), repeat=3)):
            steps = steps[::-1]                                          # the first direction changes fastest
            cost = sum(0 if s == 0 else (a - math.floor(a)) ** 2 if s < 0 else (1 - a + math.floor(a)) ** 2
                       for s, a in zip(steps, x))
            order.append((cost, combo, tuple(math.floor(a) + s for s, a in zip(steps, x))))
        assert [got[q, n] for n in range(1, 13)] == [b for _, _, b in sorted(order)[:12]]


def test_one_table_finds_near_rows_in_clusters(spark):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(25)]
    rows = [(f"r{i}", [c + rng.gauss(0, 0.15) for c in centres[i % 25]]) for i in range(500)]
    df = spark.createDataFrame(rows, "name string, vec array<double>")
    queries = knn.query_set(df, "name", "vec", 20, 30)
    projs = knn.projections(16, MP.PROJECTIONS, 42)
    out = {r.n_probes: r for r in MP.recall_by_probes(df, queries, "name", "vec", 10, projs, [1, 64, 256], width=0.8).collect()}
    assert out[256].recall >= 0.9 and out[256].candidate_fraction < 0.5
    assert out[1].recall <= out[64].recall <= out[256].recall
    top = MP.search(df, queries, "name", "vec", 5, projs, 64, width=0.8).collect()
    assert all(r["rank"] <= 5 and r.name != r.q_id for r in top)
    met = MP.candidates(df, queries, "name", "vec", projs, 64, width=0.8)
    assert met.count() == met.select("q_id", "name").distinct().count()
