"""Property-based checks (hypothesis) and remaining edge cases."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from edgefilter.operators import evaluate as EV
from edgefilter.operators.bloom import BloomFilter, BloomSpec


@given(n=st.integers(min_value=0, max_value=10**9),
       p=st.floats(min_value=1e-6, max_value=0.5, allow_nan=False))
def test_spec_is_at_least_the_optimum(n, p):
    s = BloomSpec(n, p)
    assert s.size >= -(max(n, 1) * math.log(p)) / (math.log(2) ** 2)
    assert s.hash_count >= 1
    assert s.grown(2 * s.n + 1).n >= 2 * s.n


keys_strategy = st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=keys_strategy, p=st.sampled_from([0.3, 0.1, 0.01]))
def test_no_false_negatives_for_any_key_set(spark, keys, p):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    bf = BloomFilter.build(df, "k", false_positive_rate=p)
    assert {r.k for r in bf.members(df, "k").collect()} == set(keys)


def test_empty_key_set(spark):
    empty = spark.createDataFrame([], "k string")
    bf = BloomFilter.build(empty, "k", false_positive_rate=0.1)
    assert bf.n_keys == 0 and bf.spec.n == 1
    probe = spark.createDataFrame([("a",), (None,)], "k string")
    assert bf.semi_join(probe, "k").count() == 0
    assert bf.anti_join(probe, "k").count() == 2


def test_single_class_metrics(spark):
    pred = spark.createDataFrame([(0.0, 0.0)] * 5 + [(0.0, 1.0)], "label double, prediction double")
    mine = EV.multiclass_metrics(pred).first()
    for metric, field in [("f1", "f1"), ("weightedPrecision", "weighted_precision"),
                          ("weightedRecall", "weighted_recall")]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(pred)
        assert abs(ev - mine[field]) < 1e-6, metric


def test_clean_empty_and_null_comment_agree(spark):
    from edgefilter.operators.clean import clean_edits
    from edgefilter.schemas import EDIT_SCHEMA
    rows = [(1, "t", "u", True, 1, "w", "2024-01-01 00:00:00", True, ""),
            (2, "t", "u", True, 1, "w", "2024-01-01 00:00:00", True, None)]
    c = clean_edits(spark.createDataFrame(rows, EDIT_SCHEMA)).select("comment", "comment_length").collect()
    assert c[0] == c[1]
    from edgefilter.functions.text import words
    df = spark.createDataFrame([("",), (None,)], "c string")
    got = [r.w for r in df.select(words(F.coalesce("c", F.lit(""))).alias("w")).collect()]
    assert got == [[], []]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=20),
       stamps=st.lists(st.one_of(st.none(), st.text(max_size=25),
                                 st.from_regex(r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\Z")),
                       min_size=1, max_size=20))
def test_arbitrary_text_never_fails_parse_or_clean(spark, lines, stamps):
    from edgefilter.operators.clean import clean_edits
    from edgefilter.schemas import EDIT_SCHEMA
    from edgefilter.streaming.parse import parse_edit_json
    parse_edit_json(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    rows = [(i, "t", "u", None, None, "w", s, None, None) for i, s in enumerate(stamps)]
    out = clean_edits(spark.createDataFrame(rows, EDIT_SCHEMA)).collect()
    assert len(out) == len(stamps)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.tuples(st.integers(0, 4), st.integers(-50, 50)), min_size=1, max_size=60),
       k=st.integers(1, 6))
def test_topk_matches_pandas(spark, vals, k):
    from edgefilter.operators.knn import topk
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(vals)], "g int, id int, v int").repartition(3)
    got = sorted((r.g, r.id) for r in topk(df, ["g"], [F.col("v"), F.col("id")], k, fan_in=2).collect())
    pdf = df.toPandas().sort_values(["g", "v", "id"]).groupby("g").head(k)
    assert got == sorted(zip(pdf.g, pdf.id))
