import random
import zlib

import numpy as np
import pytest

from edgefilter.llm import packing
from edgefilter.llm.common import table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(packing.default_path())


def check(rows, capacity=packing.CAPACITY):
    """Pieces tile their documents, offsets their sequences; every sequence needs no padding."""
    seqs = {}
    for r in rows:
        assert r["length"] > 0
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    short = 0
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
        short += at < capacity
    return short


def test_closest_equals_all_subsets():
    rng = random.Random(5)
    for _ in range(200):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        room = rng.randint(1, 60)
        best = max(s for m in range(1 << len(items)) if (s := sum(x for k, x in enumerate(items) if m >> k & 1)) <= room)
        counts = [(x, items.count(x)) for x in sorted(set(items), reverse=True)]
        total, chosen = packing.closest(counts, room)
        assert total == best == sum(x * n for x, n in chosen.items())
        assert all(n <= dict(counts)[x] for x, n in chosen.items())


def test_query_holds_every_id_once(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in packing.op11_packing(spark, sf).collect()]
    assert check(rows) <= 11
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(got[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)


def test_few_documents_are_cut(spark):
    rows = packing.op11_packing(spark, "/root/testdata/sf0.01").collect()
    assert check([r.asDict() for r in rows]) <= 11
    cut = {r.doc_id for r in rows if r.start % packing.CAPACITY}
    assert len(cut) < 0.02 * len({r.doc_id for r in rows})


def test_small_pools_and_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    texts = [(i, " ".join(["word"] * (i * 37 % 23))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    rows = [r.asDict() for r in packing.pack(docs, capacity=16).collect()]
    assert check(rows, 16) <= 4
    assert sum(r["length"] for r in rows) == sum(i * 37 % 23 + 1 for i in range(300))
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)


def test_merged_words_equal_the_codec():
    rng = random.Random(8)
    c = packing.PackedCodec(packing.default_path())
    words = {"".join(rng.choice("etaoinshrdlué'!ß") for _ in range(rng.randint(1, 20))) for _ in range(3000)}
    raw = [w.encode() for w in words if len(w.encode()) <= 24]
    for w, ids in zip(raw, c.merged(raw), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == c._plain_ids(w.decode())


def test_table_may_overflow(library, monkeypatch):
    monkeypatch.setattr(packing, "TABLE_ENTRIES", 4)
    c = packing.PackedCodec(packing.default_path())
    for text in ["one two three four five six", "one seven two", "eight", "one two"]:
        assert np.frombuffer(c.packed([text.encode()])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_pool_never_holds_more_than_its_bound(library):
    pool = packing.Pool(16)
    for k in range(40):          # pieces of eleven: no subset fills sixteen, so one is cut each time
        pool.add(packing.Piece(k, 0, bytes(44), 11))
    windows = []
    while pool.tokens >= 16:
        windows.append(pool.window(16))
    assert all(sum(len(p.ids) for p in w) == 64 for w in windows) and len(windows) == 27 and pool.tokens == 8


def test_edge_rows(spark, library, monkeypatch):
    odd = spark.createDataFrame([(1, None, 0), (None, "", 1), (2, "the the", 2), (2, "the the", 3)],
                                "doc_id long, text string, start long")
    rows = [r.asDict() for r in packing.pack(odd).collect()]
    assert sum(r["length"] for r in rows) == 1 + 1 + 3 + 3 and check(rows) <= 11
    assert packing.pack(odd.where("false")).collect() == []
    monkeypatch.setattr(packing, "_RUN_BYTES", 100)
    c = packing.PackedCodec(packing.default_path())
    for text in ["Hello World's café <|endoftext|> x " * 40, "plain words again " * 50, "a" * 500, " \n " * 90, "한 é " * 70]:
        got = np.frombuffer(b"".join(c.runs(text.encode())), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_very_long_text(spark, library):
    text = "one two three, " * 200_000
    rows = [r.asDict() for r in packing.pack(spark.createDataFrame([(7, text)], "doc_id long, text string")).collect()]
    assert check(rows) <= 11 and sum(r["length"] for r in rows) == 800_001
