import math

import numpy as np
import pytest

from edgefilter.llm import whitening as W
from edgefilter.llm.common import table


def check(r):
    values, vectors = W.right_vectors(r)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-12 * top
    d = len(r)
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-9
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() <= 1e-9 * top


def test_solver_equals_svd():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 16, 40, 64):
        for kind in range(9):
            a = rng.standard_normal((d, d))
            q, _ = np.linalg.qr(a)
            p, _ = np.linalg.qr(rng.standard_normal((d, d)))
            check({0: a, 1: np.eye(d), 2: q, 3: q * 10.0 ** -np.arange(0, d) @ p if d < 12 else a * 1e-8,
                   4: np.triu(a), 5: np.outer(a[0], a[-1]), 6: np.zeros((d, d)),
                   7: q @ np.diag(np.repeat([3.0, 3.0 + 1e-9, 1.0], d)[:d]) @ p,
                   8: np.diag(np.abs(np.arange(d) - d // 2) + 1.0) + np.diag(np.ones(d - 1), 1)}[kind])


def test_values_keep_relative_accuracy():
    a, b = 10.0 ** -np.arange(0, 30, 3.0), 10.0 ** -np.arange(1, 28, 3.0)
    got = W.squares(a, b)
    product = math.prod(a.tolist()) ** 2          # the determinant is exact for a bidiagonal matrix
    assert abs(math.prod(got.tolist()) / product - 1) < 1e-12


def plain(vectors, components=16):
    """Per row deviation and whitening from numpy's eigenvectors of the covariance."""
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(axis=1), ((x - s / n) @ v) / np.sqrt(e), e / (c * c).sum() * n


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").orderBy("vec_id").collect()]
    got = {(r.vec_id, r.component): r for r in W.op12_whitening(spark, sf).collect()}
    n, deviation, white, share = plain(np.array([v for _, v in rows], np.float32))
    assert len(got) == 16 * len(rows)
    mine = np.array([[got[i, k].whitened for k in range(1, 17)] for i, _ in rows])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-8
    for k, (i, _) in enumerate(rows):
        r = got[i, 3]
        assert (r.n, r.deviation) == (n, deviation[k]) and r.identity_error < 1e-9
        assert abs(r.explained / share[2] - 1) < 1e-9


def test_edge_rows(spark):
    schema = "vec_id long, embedding array<double>, x string"
    rows = [(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "b"), (None, [3.0, -1.0], "c"), (4, None, "d"), (5, [1.0, None], "e"),
            (6, [math.inf, 0.0], "f"), (7, [math.nan, 0.0], "g"), (8, [], "h"), (9, [1.0, 2.0, 3.0], "i"), (10, [1e300, 0.0], "j")]
    got = W.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert {r.n for r in got} == {2} and {r.component: r.whitened is None for r in got} == {1: False, 2: True}
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in got if r.component == 1) and got[0].identity_error < 1e-12
    same = W.whiten(spark.createDataFrame(rows[:2], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in same] == [(1, 0, None, None)] * 4
    assert W.whiten(spark.createDataFrame([], schema)).collect() == []
    assert W.whiten(spark.createDataFrame(rows[3:8], schema)).collect() == []


def test_large_entries_stay_exact(spark):
    big = float(2**45)
    got = W.whiten(spark.createDataFrame([(1, [big]), (2, [-big]), (3, [0.0])], "vec_id long, embedding array<double>"))
    assert {r.vec_id: r.deviation for r in got.collect()} == {1: None, 2: None, 3: 0}
    small = W.whiten(spark.createDataFrame([(1, [2.0**20]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in small} == {2**52}


@pytest.mark.parametrize("fan_in", [2, 16])
def test_triangles_in_rounds(spark, monkeypatch, fan_in):
    monkeypatch.setattr(W, "FAN_IN", fan_in)
    rng = np.random.default_rng(4)
    data = rng.standard_normal((400, 5)) * [5, 4, 3, 2, 1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    rows = W.usable(df).repartition(7)
    w, _ = W.fit(rows)
    n, _, _, share = plain(data)
    assert w.mean.n == n and np.abs(w.variances / w.total - share).max() < 1e-12
