import hashlib
import random

import pytest

from edgefilter.llm import phrases
from edgefilter.llm.common import table


def brute(rows, k=50):
    """[(id, words, removed, sha)] from a plain table of first documents."""
    first = {}
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        if i is not None:
            for p in range(len(w) - k + 1):
                key = tuple(w[p:p + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            f = first.get(tuple(w[p:p + k]))
            if f is not None and (i is None or f < i):
                gone[p:p + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "text").collect()
    got = sorted(map(tuple, phrases.op3_passages(spark, f"/root/testdata/{sf}").collect()), key=str)
    assert got == brute([tuple(r) for r in docs])
    assert sum(r[2] for r in got) > 0


def test_edge_rows(spark):
    rng = random.Random(2)
    w = [f"w{rng.randrange(300)}é" for _ in range(900)]
    j = " ".join
    rows = [(1, None), (2, ""), (3, j(w[:49])), (4, j(w[:49])), (5, "\n".join(w[100:170])), (6, "\t ".join(w[90:180])),
            (None, j(w[100:150])), (None, j(w[300:400])), (None, j(w[300:400])), (7, j(w[300:349])), (9, j(w[400:520])),
            (9, j(w[410:500])), (10, j(w[405:455] + ["x"] + w[460:509] + ["y"] + w[455:505])), (8, j(w[700:790])),
            (11, "a " * 300), (12, "a " * 20000), (13, "a " * 49), (14, j(w * 20)), (15, j(w[500:] + w[:500])),
            (-5, j(w[705:760]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rid", "2 as id", "3 as pieces")
    got = phrases.remove_repeats(df, digests=True)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    texts = {r.doc_id: r.kept for r in phrases.remove_repeats(df).where("doc_id in (5, 10, 12)").collect()}
    assert texts == {5: j(w[100:170]).encode(), 10: j(["x", *w[460:509], "y"]).encode(), 12: b""}
    assert phrases.remove_repeats(df.where("false"), digests=True).collect() == []
