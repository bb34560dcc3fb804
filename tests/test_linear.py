"""The logistic regression by fixed steps against plain numpy, its selection and its edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgefilter.operators import evaluate as EV
from edgefilter.operators import linear as LIN
from edgefilter.operators import model as M
from edgefilter.plans.q_model import split_clean

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labelled(spark):
    return split_clean(spark, SF).filter("labelled").cache()


def dense(rows, setting):
    """(features, labels) of the rows a setting learns from, with the idf of the learning folds."""
    learn = [r for r in rows if r.fold != setting.fold]
    k = setting.num_features
    df = np.zeros(k)
    for r in learn:
        for b in {h % k for h in r.h}:
            df[b] += 1
    idf = np.array([round(math.log((len(learn) + 1) / (d + 1)), 6) for d in df])
    out = []
    for r in learn:
        x = np.zeros(k)
        for h in r.h:
            x[h % k] += idf[h % k]
        size = math.sqrt((x * x).sum())
        out.append([*(x / size if size else x), r.minor_feature, r.length_feature, 1.0])
    return np.array(out), np.array([r.label for r in learn])


def plain(rows, s, steps):
    x, y = dense(rows, s)
    free = np.append(np.ones(x.shape[1] - 1), 0.0)
    d = 0.25 * x.T @ x.sum(axis=1) / len(x) + s.reg_param * (1 - s.elastic_net) * free
    eta = np.where(d > 0, 1 / np.where(d > 0, d, 1), 0)
    w = before = np.zeros(x.shape[1])
    for t in range(steps):
        p = w + t / (t + 3) * (w - before)
        g = x.T @ (1 / (1 + np.exp(-x @ p)) - y) / len(x) + s.reg_param * (1 - s.elastic_net) * p * free
        z = p - eta * g
        before, w = w, np.sign(z) * np.maximum(np.abs(z) - eta * s.reg_param * s.elastic_net * free, 0)
    return w


def test_models_fitted_together_equal_plain_ones(labelled):
    rows = LIN.hashed_rows(labelled, ["label"])
    settings = [LIN.Setting(40), LIN.Setting(40, 0.01, 0.5, 1), LIN.Setting(40, 0.1, 1.0, 1), LIN.Setting(64, 0.1, 0.0, 0)]
    got = LIN.fit_all(rows, settings, steps=6)
    told = rows.collect()
    for model in got:
        assert np.abs(model.weights - plain(told, model.setting, 6)).max() < 1e-10
    assert (got[2].weights == 0).sum() > (got[1].weights == 0).sum()


def test_steps_lower_the_loss(labelled):
    told = LIN.hashed_rows(labelled, ["label"]).collect()
    x, y = dense(told, LIN.Setting())
    loss = lambda w: np.log1p(np.exp(np.where(y > 0, -1, 1) * (x @ w))).mean()
    losses = [loss(LIN.fit(labelled).weights) if n == LIN.STEPS else loss(plain(told, LIN.Setting(), n)) for n in (0, 5, LIN.STEPS)]
    assert losses[0] > losses[1] > losses[2]


def test_scores_of_a_reloaded_model_and_selection(spark, labelled, tmp_path):
    model = LIN.fit(labelled)
    LIN.save(spark, model, str(tmp_path / "m"))
    again = LIN.load(spark, str(tmp_path / "m"))
    assert again.setting == model.setting and np.array_equal(again.weights, model.weights)
    first = {(r.id, r.p_bot, r.prediction) for r in LIN.score(model, labelled, ["id"]).collect()}
    assert {(r.id, r.p_bot, r.prediction) for r in LIN.score(again, labelled, ["id"]).collect()} == first
    settings = [LIN.Setting(40, r, 0.5, f) for r in (0.01, 1.0) for f in range(M.FOLDS)]
    grid = LIN.select_model(labelled, settings).collect()
    assert len(grid) == 2 and sum(r.best for r in grid) == 1
    assert max(grid, key=lambda r: (r.f1, -r.reg_param)).best


def test_f1_equals_the_evaluator(spark):
    rows = [(1, 0.0, 0.0)] * 7 + [(1, 0.0, 1.0)] * 2 + [(1, 1.0, 1.0)] * 3 + [(1, 1.0, 0.0)] + [(2, 0.0, 0.0)] * 4
    df = spark.createDataFrame(rows, "g int, label double, prediction double")
    cells = df.groupBy("g", "label", "prediction").agg(F.count("*").alias("n"))
    for g, f1 in ((r.g, r.f1) for r in LIN.weighted_f1(cells, ["g"]).collect()):
        assert round(f1, 6) == EV.multiclass_metrics(df.where(F.col("g") == g)).first().f1


def test_rows_without_text(spark, labelled):
    empty = labelled.limit(3).withColumn("comment", F.lit(""))
    model = LIN.fit(labelled)
    assert all(0 < r.p_bot < 1 for r in LIN.score(model, empty, ["id"]).collect())
    assert LIN.score(model, empty.where("false"), ["id"]).collect() == []


def test_folds_of_a_size_share_one_matrix(monkeypatch):
    """Gradient sums of three folds equal the plain ones, and the counts are worked out once."""
    import numpy as np
    import pyarrow as pa

    from edgefilter.operators import linear as LIN
    rng = np.random.default_rng(5)
    n, k = 40, 30
    h = [rng.integers(0, 1 << 32, rng.integers(0, 9)).tolist() for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(rng.integers(0, 2, n).astype(float)), pa.array(rng.integers(0, 3, n), pa.int32()), pa.array(h, pa.list_(pa.int64())),
         pa.array(rng.integers(0, 2, n).astype(float)), pa.array(rng.random(n))], ["label", "fold", "h", "minor_feature", "length_feature"])
    settings = [LIN.Setting(k, 0.1, e, f) for e in (0.0, 1.0) for f in range(3)]
    idfs = {(k, f): rng.random(k) for f in range(3)}
    points = {key: rng.normal(size=(k + LIN.MORE, 2)) for key in idfs}
    label, fold = np.array(batch.column("label")), np.array(batch.column("fold"))
    calls, counts = [], LIN._counts
    want = {}
    for key in idfs:
        x = LIN._matrix(batch, idfs[key])[fold != key[1]]
        want[key] = x.T @ (1 / (1 + np.exp(-x @ points[key])) - label[fold != key[1], None])
    monkeypatch.setattr(LIN, "_counts", lambda *a: (calls.append(1), counts(*a))[1])
    got = {key: np.zeros((k + LIN.MORE, 2)) for key in idfs}
    for out in LIN._sums(points, idfs, settings)(iter([batch])):
        for r in out.to_pylist():
            got[r["size"], r["left"]][r["k"]] = r["g"]
    assert len(calls) == 1
    assert all(np.allclose(got[key], want[key], rtol=1e-12, atol=1e-12) for key in idfs)
