import random

import duckdb
import pytest

from edgefilter.llm import common, rolling
from edgefilter.llm import decontaminate as D
from edgefilter.llm.common import table
from edgefilter.session import materialize


def _words(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def _grams(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(docs, items):
    best = {}
    for d, t in docs:
        for i, x in items:
            k = min(5, len(_words(x)))
            want = _grams(_words(x), k)
            n = len(want & _grams(_words(t), k))
            if want and n >= 0.8 * len(want) - 1e-9:
                best[d, i] = max(best.get((d, i), (0,)), (n / len(want), n, len(want)))
    return sorted(((d, i, n, s, c) for (d, i), (c, n, s) in best.items()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as from '{path}/{t}.parquet'")
    got = sorted(map(tuple, D.op1_decontamination(spark, path).collect()))
    assert got == sorted(con.sql(D.SQL).fetchall()) and got


def test_edge_rows_equal_brute_force(spark):
    rng = random.Random(8)
    w = [f"{c}{rng.randrange(400)}" for c in "ABcdé" * 60]
    j = " ".join
    items = [(1, j(w[:40])), (2, j(w[50:59])), (3, j(w[:3])), (4, None), (5, " "), (6, j(w[100:105])), (6, j(w[120:160])),
             (7, "the " * 50), (None, j(w[200:230])), (2, j(w[50:59])), (8, j(w[20:60]))]
    docs = [(1, j(w)), (2, j(w[:36])), (3, j(w[:35]).upper()), (4, j(w[:20] + ["x"] + w[20:40])), (5, j(w[:3])),
            (6, None), (7, ""), (8, "\n".join(w[118:300])), (8, j(w[100:104])), (None, j(w[195:233])),
            (9, "the " * 30000), (10, j(w[50:58])), (1, j(w)), (11, j(w[100:105])), (12, j(w[103:120] + w[:40][::-1])),
            (13, j(w[22:60]) + " tail"), (14, j(w[:18]) + " gap " + j(w[15:40]))]
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rid", "'x' as item_id", "2 as bad")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, D.contaminated(a, b).collect()), key=str) == brute(docs, items)
    kept = D.decontaminate(a, b)
    assert kept.columns == a.columns
    bad = [d for d in docs if brute([d], items)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        (d for d in docs if d not in bad), key=str)
    assert D.contaminated(a.where("false"), b).collect() == [] == D.contaminated(a, b.where("false")).collect()


def test_short_items_are_found_inside_long_documents(spark):
    rng = random.Random(3)
    filler = " ".join(f"w{rng.randrange(900)}" for _ in range(3000))
    items = [(1, "hello World foo"), (2, "solo"), (3, "two words"), (4, "one of four words"), (5, "two words"), (6, "w1 w2 w3 w4 w5 w6")]
    docs = [(1, f"{filler} HELLO world\nfoo {filler}"), (2, f"solo {filler}"), (3, f"{filler} two words"), (4, "two"),
            (5, f"{filler} one of four {filler}"), (6, "x one of four words"), (7, "Two Words"), (8, filler), (9, "hello world foobar")]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, D.contaminated(a, b).collect()), key=str)
    assert got == brute(docs, items) and len(got) == 7
    assert {r.doc_id for r in D.decontaminate(a, b).collect()} == {4, 5, 8, 9}
    assert {r.doc_id for r in D.decontaminate(a, b, least_words=3).collect()} == {2, 3, 4, 5, 7, 8, 9}


def test_templates_that_many_items_share_lose_no_pair(spark):
    head = "which of the following statements about the subject named below is true please answer with one letter "
    items = [(i, head + " ".join(f"i{i}x{j}" for j in range(i % 30))) for i in range(60)]
    docs = [(i, f"start {t} end") for i, t in items] + [(100, head), (101, "other " * 30)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, D.contaminated(a, b).collect()), key=str) == brute(docs, items)


def test_long_texts_go_in_pieces(spark):
    rng = random.Random(5)
    w = [f"w{rng.randrange(5000)}" for _ in range(6000)] + ["y" * 3000] + [f"w{rng.randrange(5000)}" for _ in range(50)]
    items = [(i, " ".join(w[i * 47:i * 47 + 2 + i % 60])) for i in range(128)]
    docs = [(1, " ".join(w)), (2, "  " + "\n ".join(w) + "  ")]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    text = docs[1][1].encode()
    for size in (40, 500, 4000):
        parts = list(rolling.pieces(text, 4, size))
        assert set().union(*(_grams(p.split(), 5) for p in parts)) == _grams(text.split(), 5)
        assert max(len(p) for p in parts) < size + 3100
    assert list(rolling.pieces(b"", 4, 10)) == [b""] and list(rolling.pieces(b" " * 50, 4, 10)) == [b" " * 50]
    gram = " ".join(w[9:14]).encode()
    assert D.n_held(text, {5: {gram}, 2: {b"no such"}}) == {gram}
    assert sorted(map(tuple, D.contaminated(a, b).collect()), key=str) == want
    long = spark.createDataFrame([(3, " ".join(w * 40)), (4, "z" * 1_500_000 + " " + " ".join(w[:20]))], "doc_id long, text string")
    assert {r.doc_id for r in D.contaminated(long, b.where("item_id = 1")).collect()} == {3}


def test_tables_that_grow_with_the_documents_are_not_broadcast(spark, monkeypatch):
    words = [f"w{k}" for k in range(12)]
    docs = materialize(spark.createDataFrame(
        [(i, " ".join(words) if i % 2 else f"other text number {i} is here") for i in range(200)],
        "doc_id long, text string"), "docs")
    items = materialize(spark.createDataFrame([(1, " ".join(words[2:10]))], "item_id long, text string"), "bench")
    seen = []
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(D, "materialize", lambda df, name: seen.append((name, plan(df))) or materialize(df, name))
    monkeypatch.setattr(common, "SENT_BYTES", 0, raising=False)
    out = D.decontaminate(docs, items)
    seen.append(("kept", plan(out)))
    assert sorted(r.doc_id for r in out.collect()) == list(range(0, 200, 2))
    assert {name for name, text in seen if "BroadcastHashJoin" in text} & {"candidates", "kept"} == set()
