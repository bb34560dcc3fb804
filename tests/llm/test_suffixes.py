import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from edgefilter.llm import suffixes
from edgefilter.llm.common import table

N = suffixes.LENGTH


def brute(rows):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(b[p:p + N]) for _, b in docs for p in range(len(b) - N + 1))
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - N + 1):
            if seen[hash(b[p:p + N])] > 1:
                gone[p:p + N] = b"\1" * N
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_difference_cover_and_ranks():
    cover = set(suffixes.COVER.tolist())
    assert {(a - b) % 32 for a in cover for b in cover} == set(range(32))
    rng = random.Random(1)
    text = b"".join(rng.choice([b"ab" * 40, b"the cat ", b"x" * 70, bytes([rng.randrange(97, 100)])]) for _ in range(200))
    starts = np.arange(len(text) - N)
    seen = Counter(text[p:p + N] for p in starts)
    got = suffixes.repeated_starts(np.frombuffer(text, np.uint8), starts, np.zeros(len(starts), np.int64))
    assert got.tolist() == [seen[text[p:p + N]] > 1 for p in starts]


@pytest.mark.parametrize("crowd", [256, 2])
def test_query_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    sf = "/root/testdata/sf0.001" if crowd == 2 else "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    got = sorted(map(tuple, suffixes.op8_suffixes(spark, sf).collect()), key=str)
    assert got == brute([tuple(r) for r in docs])
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("crowd", [256, 3])
def test_edge_rows(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(4)
    t = "".join(rng.choice("abcdé ") for _ in range(3000))
    rows = [(1, None), (2, ""), (3, t[:450]), (3, t[:450]), (None, t[30:480]), (4, "a" * 401), (5, "b" * 400),
            (6, "xy" * 3000), (7, t[1000:1399]), (8, t[1000:1402] + t[1001:1500]), (9, t[2000:2390] + "!" + t[2391:2900]),
            (10, t[1990:2950]), (None, "q" * 399)]
    passage = t[500:960]
    rows += [(100 + i, "".join(rng.choice("klmn") for _ in range(rng.randrange(300))) + passage
              + "".join(rng.choice("klmn") for _ in range(rng.randrange(300)))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rid", "2 as starts")
    got = suffixes.remove_repeated_bytes(df, digests=True)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert suffixes.remove_repeated_bytes(df.where("false"), digests=True).collect() == []
