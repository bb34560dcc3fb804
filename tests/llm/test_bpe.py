import hashlib
import random

import pytest

from edgefilter.llm import bpe
from edgefilter.llm.common import table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def check(library, c, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = c.encode(text.encode())
    assert got == " ".join(map(str, ids)), text[:200]
    assert c.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_equals_the_library_on_odd_texts(library):
    c = bpe.codec(bpe.default_path())
    for text in ["", " ", "Hello World's café <|endoftext|>x<|startoftext|><|endoftext|", "İstanbul ǅ ß ẞ ΣΑΣ Σας",
                 "é a ́b 각", "a\x0bb\x0cc\x1cd\x85e\xa0f g　h ​\x00",
                 "a</w> </w> don't we'll 12a3 !!!\"#$", "a" * 3000, "ab" * 800 + "!" * 900, "日本語 テスト 🍓🍓x", "'S 'LL"]:
        check(library, c, text)


def test_equals_the_library_on_random_texts(library):
    rng = random.Random(3)
    c = bpe.codec(bpe.default_path())
    pool = "aàbcdeést'’ß ΣİK.,!?0٣Ⅷ½ \t\n\x0b\x1f\xa0̧́‍🍓한글ﬁ<|endoftext|>"
    for _ in range(1500):
        check(library, c, "".join(rng.choice(pool) for _ in range(rng.randint(1, 40))))


def test_merge_table_may_overflow(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 3)
    c = bpe.Codec(bpe.default_path())
    for text in ["the quick brown fox jumps over the lazy dog again and again", "x y z the the quick"]:
        check(library, c, text)


def test_query_and_edge_rows(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in bpe.op4_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
    odd = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "the the", None), (2, "the the", None)],
                                "doc_id long, text string, n_tokens string")
    out = bpe.encode(odd)
    assert out.columns == ["doc_id", "text", "n_tokens", "n_tokens_", "ids", "decoded"]
    the = library.encode("the", add_special_tokens=False).ids[0]
    rows = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert rows == [(1, None, "a", 0, "", ""), (2, "the the", None, 2, f"{the} {the}", "the</w> the</w>"),
                    (2, "the the", None, 2, f"{the} {the}", "the</w> the</w>"), (None, "", "b", 0, "", "")]
    assert bpe.encode(odd.where("false")).collect() == []
