"""Physical-plan properties the design relies on."""

import pytest

from edgefilter.plans.registry import queries
from tests.conftest import SF01


def plan(spark, name):
    df = queries()[name](spark, SF01)
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_profiles_read_only_needed_columns(spark):
    p = plan(spark, "avg_user_edits_weighted")
    assert "ReadSchema: struct<doc_id:bigint>" in p          # no document text
    assert "text" not in p.split("ReadSchema: struct<doc_id:bigint>")[0].split("Scan parquet")[-1]


def test_exact_knn_limits_before_each_shuffle_and_broadcasts_only_queries(spark):
    p = plan(spark, "exact_knn")
    tree = p.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 4                # partial + final, two rounds
    assert "TakeOrderedAndProject" in tree                    # bounded query sample
    assert tree.count("BroadcastExchange") == 1


def test_lsh_join_is_broadcast_on_query_side(spark):
    tree = plan(spark, "lsh_bucket_topk").split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree


@pytest.mark.parametrize("name", ["word_counts_human", "bloom_semi_join", "hashed_tf", "exact_knn",
                                  "feature_correlation", "lsh_grid", "classification_metrics"])
def test_no_python_evaluation(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p


def test_stop_words_are_a_hash_set_lookup(spark):
    assert "INSET" in plan(spark, "word_counts_bot").upper()


def test_bucketed_inputs_join_without_shuffle(spark):
    from edgefilter.sources.tables import bucket_edit_inputs, edits, edits_bucketed
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucket_edit_inputs(spark, SF01, database="ef_test", buckets=8)
        b = edits_bucketed(spark, "ef_test")
        p = b._sc._jvm.PythonSQLUtils.explainString(b._jdf.queryExecution(), "formatted").split("\n\n")[0]
        assert "SortMergeJoin" in p and "Exchange" not in p
        key = ["id", "user", "timestamp"]
        assert b.select(*key).exceptAll(edits(spark, SF01).select(*key)).count() == 0
        assert b.count() == edits(spark, SF01).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
