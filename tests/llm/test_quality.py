import math
from collections import Counter

import numpy as np
import pytest

from edgefilter.llm import quality as Q
from edgefilter.llm.common import id_hash_mod, table

SF = "/root/testdata/sf0.01"


def ends_of(texts):
    return np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def test_statistics_equal_plain_loops():
    texts = [b"", b"The cat | the cat.\nA dog!\n\nA dog!", b" \n", b"x x x Y\t12", "é è".encode(), b"A dog!"]
    got = Q.statistics(np.frombuffer(b"".join(texts), np.uint8), ends_of(texts))
    for row, t in zip(got, texts, strict=True):
        s = dict(zip(Q.STATISTICS, row, strict=True))
        w, lines = t.split(), [x for x in t.split(b"\n") if x]
        assert s["log_words"] == pytest.approx(math.log1p(len(w)))
        assert s["word_bytes"] == pytest.approx(sum(map(len, w)) / max(1, len(w)))
        assert s["distinct_words"] == pytest.approx(len(set(w)) / max(1, len(w)))
        assert s["repeated_words"] == pytest.approx(sum(a == b for a, b in zip(w, w[1:])) / max(1, len(w)))
        assert s["distinct_lines"] == pytest.approx(len(Counter(lines)) / max(1, len(lines)))
        assert s["pipes"] == pytest.approx(t.count(b"|") / max(1, len(w)))
        assert s["uppercase"] == pytest.approx(sum(65 <= c <= 90 for c in t) / max(
            1, sum(chr(c).isalpha() for c in t if c < 128)))
        assert s["capital_words"] == pytest.approx(sum(65 <= x[0] <= 90 for x in w) / max(1, len(w)))


def test_held_out_accuracy_and_columns(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = Q.op2_quality(spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) == labels.where(id_hash_mod("doc_id", 5) == 0).count()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert out.count() == docs.count()
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_rules_compile_to_columns(spark):
    model = Q.RuleEnsemble(-1.0, [(((0, 1.0, True), (1, 2.0, False)), 3.0)], [(1, 0.0, 4.0, 0.5)])
    got = spark.createDataFrame([(2.0, 1.0), (0.5, 9.0)], "a double, b double").select(
        model.column(["a", "b"]).alias("p")).collect()
    assert [r.p for r in got] == pytest.approx([1 / (1 + math.exp(-2.5)), 1 / (1 + math.exp(-1.0))])


def test_edge_rows(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (None, " "), (3, "w " * 90000), (3, "w " * 90000)],
                                "doc_id long, text string").selectExpr("*", "1 as pipes", "2 as label")
    model = Q.RuleEnsemble(0.5, [(((0, 1.0, True),), 1.0)], [])
    got = Q.score(odd, model)
    assert got.columns == ["doc_id", "text", "pipes", "label", "score", "predicted"]
    assert sorted(round(r.score, 4) for r in got.collect()) == [0.6225] * 3 + [0.8176] * 2
    assert Q.score(odd.where("false"), model).collect() == []
    one = Q.fit(odd)                # a single class: a constant score
    assert one.rules == [] and all(r.score < 1 for r in Q.score(odd, one).collect())
    assert Q.fit(odd.where("false")).intercept == 0.0


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "the house of the man", "s", 7)], "doc_id long, text string, score string, Predicted int")
    got = Q.score(docs, Q.RuleEnsemble(0.5, [], []))
    assert got.columns == ["doc_id", "text", "score", "Predicted", "score_", "predicted_"]
    assert got.first().predicted_ == 1 and got.first().score == "s"
