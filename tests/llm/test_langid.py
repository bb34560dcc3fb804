import math
from collections import Counter

from edgefilter.llm import langid
from edgefilter.llm.common import id_hash_mod, table


def brute_cost(text: bytes, corpus: list[bytes], order: int) -> float:
    """Code length of PPM method C with frozen counts, byte by byte."""
    grams = [Counter() for _ in range(order + 1)]
    for t in corpus:
        for i in range(len(t)):
            for o in range(min(order, i) + 1):
                grams[o][t[i - o:i + 1]] += 1
    total = 0.0
    for i in range(len(text)):
        for o in range(min(order, i), -1, -1):
            ctx = text[i - o:i]
            seen = {g[-1]: n for g, n in grams[o].items() if g[:-1] == ctx}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if text[i] in seen:
                total -= math.log(seen[text[i]] / whole)
                break
            total -= math.log(len(seen) / whole)
        else:
            total += math.log(256)
    return total


def test_code_lengths_equal_brute_force(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "a cat and a hat that sat", "en"),
            (3, "der hund und die katze", "de"), (4, "und das ist der mann", "de")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    import numpy as np
    for text in (b"the hat", b"und der", b"zzz\xff the", b"x", "für die katze".encode()):
        got = model.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        for j, lang in enumerate(model.languages):
            want = brute_cost(text, [t.lower().encode() for _, t, x in rows if x == lang], langid.ORDER)
            assert abs(got[j] - want) < 1e-3 * max(1, want), (text, lang)


def test_parts_of_long_texts_add_up(spark, monkeypatch):
    import numpy as np
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["the cat sat on the mat " * 9, "der hund und die katze " * 7] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = [b"the hat of the man " * 5, b"", b"und", "für die katze".encode() * 9, b""]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = langid.fit(docs)
    want = whole.score(data, ends)
    monkeypatch.setattr(langid, "COUNT_BYTES", 11)
    parts = langid.fit(docs)
    assert all(np.array_equal(a.keys, b.keys) and np.array_equal(a.values, b.values) for a, b in zip(whole.grams, parts.grams))
    for size in (1, 3, 7, 50):
        monkeypatch.setattr(langid, "SCORE_BYTES", size)
        assert np.allclose(parts.score(data, ends), want, rtol=1e-6)


def test_clashing_columns_stay(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    odd = spark.createDataFrame([(1, "the and of", "x", 2.0)], "doc_id long, text string, lang_pred string, SCORE double")
    got = langid.predict(odd, langid.fit_on_known(docs))
    assert got.columns == ["doc_id", "text", "lang_pred", "SCORE", "lang_pred_", "score_"]
    assert tuple(got.first())[:5] == (1, "the and of", "x", 2.0, "en")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    got = langid.op6_language(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) == docs.where(id_hash_mod("doc_id", 4) == 2).count()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.fit_on_known(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "12 34 !!"), (3, "the and of"), (3, "the and of"),
                                 (4, "the of " * 60000)], "doc_id long, text string").selectExpr(
        "*", "1 as lowered", "2 as lang")
    got = langid.predict(odd, model)
    assert got.columns == ["doc_id", "text", "lowered", "lang", "lang_pred", "score"]
    assert sorted((r.doc_id or 0, r.lang_pred, r.score > 0) for r in got.collect()) == [
        (0, "und", False), (1, "und", False), (2, "und", False), (3, "en", True), (3, "en", True), (4, "en", True)]
    empty = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}
    assert langid.predict(odd.where("false"), model).collect() == []
