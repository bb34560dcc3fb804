"""Co-occurrence vectors against numpy's singular value decomposition."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgefilter.functions.text import raw_words
from edgefilter.operators import word_vectors as WV

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def matrix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return WV.shifted_ppmi(WV.pair_counts(docs, "text", min_count=40)).cache()


def dense(rows):
    words = sorted({r.w for r in rows})
    at = {w: i for i, w in enumerate(words)}
    m = np.zeros((len(words), len(words)))
    for r in rows:
        m[at[r.w], at[r.c]] = r.ppmi
    return words, m


def test_singular_values_and_vectors_equal_numpy(matrix):
    words, m = dense(matrix.collect())
    assert np.allclose(m, m.T)
    sigma, vectors = WV.factorise(matrix, 6, steps=25)
    want = np.linalg.svd(m, compute_uv=False)[:6]
    assert np.abs(sigma / want - 1).max() < 1e-3
    got = {r.w: np.array(r.vec) for r in vectors.collect()}
    u = np.array([got[w] for w in words])
    assert np.allclose(u.T @ u, np.diag(sigma), atol=1e-3 * sigma[0])            # U sqrt(S): orthogonal columns
    top, s, _ = np.linalg.svd(m)
    close = abs(top[:, 0] @ (u[:, 0] / np.sqrt(sigma[0])))
    assert close > 1 - 1e-4


def test_pair_counts_by_hand(spark):
    docs = spark.createDataFrame([("a b a",), ("b",), (None,), ("",)], "text string")
    got = {(r.w, r.c): r.n for r in WV.pair_counts(docs, "text", window=2, min_count=1).collect()}
    assert got == {("a", "b"): 2, ("b", "a"): 2, ("a", "a"): 2}
    assert WV.pair_counts(docs.where("false"), "text").collect() == []


def test_a_matrix_of_lower_rank(spark):
    rows = [(w, c, 1.0) for w in "abc" for c in "abc"]
    sigma, vectors = WV.factorise(spark.createDataFrame(rows, "w string, c string, ppmi double"), 2, steps=3)
    assert np.allclose(sigma, [3, 0], atol=1e-6) and vectors.count() == 3


def _near(texts, window):
    """Pairs at most ``window`` places apart, each kind under its words in order."""
    out = Counter()
    for t in texts:
        for i, w in enumerate(t):
            for c in t[i + 1:i + 1 + window]:
                out[min(w, c), max(w, c)] += 1
    return out


def test_words_of_plain_texts_are_those_of_raw_words(spark):
    every = [f"a{chr(i)}B x{chr(i)} {chr(i)}" for i in range(256)]
    texts = every + ["", " ", None, "ÀÉ×÷ ß_9", "İstanbul ſ ΣΑΣ œuvre É", "日本 3½ x́y", "a" * 70, "e’t «É»", "ÿ", "퟿ Z"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = docs.select(WV._plain(F.col("text")).alias("x"), raw_words(F.col("text")).alias("t")).where("x is not null").collect()
    words, n = WV._tokens(pa.array(["cut off"] + [r.x for r in rows]).slice(1))
    got = np.split(np.array(words.to_pylist(), object), np.cumsum(n)[:-1])
    assert [g.tolist() for g in got] == [r.t for r in rows]


@pytest.mark.parametrize("chunk", [1, 40, 1 << 20])
def test_lists_of_chunks_add_up_to_the_pairs(monkeypatch, chunk):
    monkeypatch.setattr(WV, "CHUNK", chunk)
    rng = random.Random(3)
    texts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(9))] for _ in range(1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([" ".join(t) for t in texts[i:i + 300]])], ["x"]) for i in range(0, 1000, 300)]
    id_of = dict(zip("abcdefgh", WV._ids(pa.array(list("abcdefgh")), 7).tolist(), strict=True))
    lists = [r for b in WV._near_counts(3, 7)(iter(batches)) for r in b.to_pylist()]
    assert all(r["a"] <= b for r in lists for b in r["b"])
    known = [{"a": id_of[w], "b": [], "n": [], "w": w} for w in "abcdefg"]          # h is no known word
    rows = sorted([r | {"w": None} for r in lists] + known, key=lambda r: r["a"])
    kinds = pa.schema([("a", pa.int64()), ("b", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("w", pa.string())])
    parts = [pa.RecordBatch.from_pylist(rows[i:i + 5], kinds) for i in range(0, len(rows), 5)]
    word = {i: w for w, i in id_of.items()}
    got = {(r["w"], word[r["b"]]): r["n"] for b in WV._added(iter(parts)) for r in b.to_pylist()}
    want = _near(texts, 3)
    assert got == {p: want[tuple(sorted(p))] for p in got}
    assert {tuple(sorted(p)) for p in got} == {p for p in want if min(p, key=id_of.get) != "h"}


def test_half_pairs_give_the_same_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = WV.shifted_ppmi(WV.pair_counts(docs, "text", min_count=40)).withColumn("ppmi", F.round("ppmi", 9))
    half = WV.shifted_ppmi(WV.pair_counts(docs, "text", min_count=40, half=True), half=True).withColumn("ppmi", F.round("ppmi", 9))
    assert sorted(whole.collect()) == sorted(half.collect()) and whole.count() > 100


def test_texts_are_read_once_for_pairs(spark):
    """Before, both directions were counted from the texts anew."""
    pairs = WV.pair_counts(spark.read.parquet(f"{SF}/documents.parquet"), "text")
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_words_that_share_an_id_get_another_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("a b a",), ("b",)], "text string")
    ids = WV._ids

    def counts(seed):
        def run(batches):
            for b in plain(seed)(batches):
                yield b.set_column(0, "id", pa.array([5] * len(b), pa.int64())) if seed == 0 else b
        return run

    plain = WV._word_counts
    monkeypatch.setattr(WV, "_word_counts", counts)
    known, seed = WV._vocabulary(docs.select(F.col("text").alias("x")), 1)
    assert seed == 1
    assert {r.w: r.id for r in known.collect()} == dict(zip("ab", ids(pa.array(["a", "b"]), 1).tolist(), strict=True))
