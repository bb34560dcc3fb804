import random

import pytest
import xxhash

from edgefilter.llm import common, components, simhash
from edgefilter.llm.common import table
from edgefilter.session import materialize


def brute(rows):
    """{row number: (hex, component id)} by plain loops."""
    fps = []
    for _, text in rows:
        words = [w for w in (text or "").encode().lower().split()]
        grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(rows[i][0], f"{fps[i]:016x}", least[find(i)]) for i in range(len(rows))]


def key(r):
    return tuple((x is None, x) for x in r)


def test_components_equal_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.simhash_components(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b"), (None, "a b"), (7, "x y z w"),
            (7, "x y z w"), (8, "x y z"), (None, "lonely words here stand"), (9, "w " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as fp", "2 as row_number", "'q' as component_id")
    got = [tuple(r) for r in simhash.simhash_components(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(key((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        key(x) for x in [(1, None), (4, "one"), (6, "a b"), (7, "x y z w"), (8, "x y z"),
                         (None, "lonely words here stand"), (9, "w " * 5000)])
    assert simhash.simhash_components(docs.where("false")).collect() == []
    assert simhash.simhash_dedup(docs.where("false")).collect() == []


@pytest.mark.parametrize("crowded", [1, 4, 1000])
def test_links_find_every_pair_within_three_bits(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(fps)[:3]:      # dense groups: many share a half
        for _ in range(60):
            fps.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 3))}))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = {(min(r), max(r)) for r in map(tuple, simhash.links(
        spark.createDataFrame([(f,) for f in fps], "fp long")).collect())}
    assert got == want


def plan(df):
    """What Spark plans before it has run anything, by the sizes it assumes."""
    return df._jdf.queryExecution().sparkPlan().toString()


def test_exploded_index_is_not_broadcast(spark):
    rng = random.Random(8)
    fps = materialize(spark.createDataFrame([(rng.getrandbits(63),) for _ in range(1000)], "fp long"), "fps")
    assert "BroadcastHashJoin" not in plan(simhash.links(fps))


def test_tables_of_many_rows_are_not_broadcast(spark, monkeypatch):
    """Also where buckets are crowded; no table of more than SENT_BYTES is sent to all tasks, and the rows stay right."""
    rng = random.Random(6)
    centre = rng.getrandbits(63)
    rows = [(i, f"{i % 40} b c d e f") for i in range(60)]
    fps = sorted({centre ^ sum({1 << rng.randrange(32) for _ in range(2)}) for _ in range(60)})
    seen = []
    for module in (simhash, components):
        monkeypatch.setattr(module, "materialize",
                            lambda df, name: seen.append((name, plan(df))) or materialize(df, name))
    monkeypatch.setattr(common, "SENT_BYTES", 0, raising=False)
    monkeypatch.setattr(simhash, "CROWDED", 4)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin(a ^ b).count("1") <= 3}
    got = {(min(r), max(r)) for r in map(tuple, simhash.links(
        materialize(spark.createDataFrame([(f,) for f in fps], "fp long"), "fps")).collect())}
    assert got == want
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen.append(("components", plan(simhash.simhash_components(docs))))
    kept = simhash.simhash_dedup(docs)
    seen.append(("kept", plan(kept)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})
    assert {"big_neighbours", "crowded_members", "links", "groups", "dropped", "kept"} <= {name for name, _ in seen}
    # the two joins with what a shuffle just gave are decided by its real size
    assert {name for name, text in seen if "BroadcastHashJoin" in text} <= {"big_wiped", "groups"}
