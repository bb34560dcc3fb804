import numpy as np

from edgefilter.llm import neighbours as N
from edgefilter.llm.common import table


def brute(ids, x, k=10, every=100):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(ids[j], d[j]) for j in order]
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "SEGMENT_BYTES", 700 * (8 * 64 + 12 * N.PROJECTIONS))
    monkeypatch.setattr(N, "BLOCK", 8)
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want, got = brute(ids, x), {}
    for r in N.search(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    for q, near in got.items():
        for i, s in near:
            assert abs(s - np.sqrt(((x[ids == i][0] - x[ids == q][0]) ** 2).sum())) < 1e-12


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 0.1]), (8, [1.0, 0.1]), (7, [9.0, 9.0]), (None, [1.0, 1.0]), (200, [1.0, 2.0, 3.0]),
            (300, None), (9, [1e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as query_id", "2 as v")
    got = {}
    for r in N.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [7, 8, 100, 9], 100: [7, 8, 0, 9]} and N.search(df.where("false")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in N.search(same).orderBy("rank").collect()] == [(i, 0.0) for i in range(1, 11)]


def test_collisions_are_counted_alike_from_both_sides():
    rng = np.random.default_rng(1)
    s = N.Segment(np.arange(300), rng.standard_normal((300, 16)))
    q = rng.standard_normal(16) @ s.directions
    p = s.vectors @ s.directions
    for half in (0.1, 1.0, 3.0, 9.0):
        assert (s.collisions(q, half) == (np.abs(p - q) <= half).sum(1)).all()


def test_very_large_components_end():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 4)) * 1e200
    x[:20] = rng.standard_normal((20, 4))
    x[5] = 5e307
    s = N.Segment(np.arange(40), x)
    for q in (0, 5, 30):
        ids, far = s.nearest(q, x[q], 39)
        assert len(ids) == 39 and np.all(np.diff(far) >= 0)
    ids, far = s.nearest(30, x[30], 3)
    want = sorted((float(np.sqrt((((x[i] - x[30]) / 1e200) ** 2).sum())), i) for i in range(40) if i not in (5, 30))[:3]
    assert ids.tolist() == [i for _, i in want] and np.allclose(far / 1e200, [d for d, _ in want])


def test_recall_on_clusters_noise_and_copies():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((30, 32)) * 3
    sets = {"noise": rng.standard_normal((3000, 32)), "clusters": centres[rng.integers(0, 30, 3000)] + rng.standard_normal((3000, 32)),
            "copies": np.concatenate([np.tile(rng.standard_normal((1, 32)), (800, 1)), rng.standard_normal((2200, 32))])}
    for kind, x in sets.items():
        s, hits = N.Segment(np.arange(3000), x), 0
        for q in range(0, 3000, 100):
            ids, _ = s.nearest(q, x[q])
            d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            d[q] = np.inf
            kth = np.sort(d)[9]
            hits += (d[ids] <= kth).sum()
        assert hits / 300 >= 0.95, kind
