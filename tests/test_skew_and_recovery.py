"""A hot key holding a third of all rows, and a stream epoch that fails midway."""

import pytest
from pyspark.sql import functions as F

from edgefilter.operators import knn
from edgefilter.operators import profile as P
from edgefilter.operators.bloom import BloomFilter
from edgefilter.operators.clean import clean_edits
from edgefilter.operators.scoring import rule_prediction
from edgefilter.sources import files as FS
from edgefilter.sources.tables import edits
from edgefilter.streaming import jobs as J
from tests.conftest import SF001

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_rows(spark, n=30000):
    """Edit-like rows; user0 owns a third of them, on one date, the others' dates vary."""
    ids = spark.range(0, n)
    user = F.when(F.col("id") % 3 == 0, F.lit("user0")).otherwise(
        F.concat(F.lit("user"), (F.col("id") % 997 + 1).cast("string")))
    return ids.select("id", user.alias("user"), F.date_add(F.lit("2024-01-01").cast("date"), F.when(
        F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 28).cast("int")).alias("date"),
                      (F.col("id") % 5 == 0).alias("bot"), (F.col("id") % 100).cast("int").alias("length"))


def _final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_back_splits_hot_user(spark, skew_conf):
    rows = _hot_rows(spark)
    out = P.user_day_edits_join(rows)
    got = out.filter("user = 'user0'").select("user_edits").distinct().collect()
    assert [r.user_edits for r in got] == [10000]
    assert out.count() == 30000
    out.collect()
    assert "skew=true" in _final_plan(out)


def test_bloom_semi_join_with_hot_user(spark, skew_conf):
    rows = _hot_rows(spark)
    keys = spark.createDataFrame([("user0",), ("user5",)], "user string")
    bf = BloomFilter.build(keys, "user", false_positive_rate=0.0001)
    semi = bf.semi_join(rows, "user")
    exact = rows.filter(F.col("user").isin("user0", "user5")).count()
    assert semi.count() == exact
    semi.collect()
    assert "skew=true" in _final_plan(semi)


def test_topk_hot_group(spark):
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("g"),
        "id", ((F.col("id") * 7919) % 100003).alias("v")).repartition(12)
    got = knn.topk(df, ["g"], [F.col("v"), F.col("id")], 7).filter("g = 0").orderBy("rank").collect()
    ref = df.filter("g = 0").orderBy("v", "id").limit(7).collect()
    assert [r.id for r in got] == [r.id for r in ref]


def test_stream_epoch_failure_then_restart(spark, tmp_path):
    e = edits(spark, SF001)
    src = str(tmp_path / "in")
    FS.edit_json_lines(e).repartition(3).write.mode("overwrite").text(src)
    state = J.BlacklistState(spark, str(tmp_path / "state"))
    ck = str(tmp_path / "ck")
    calls = {"n": 0}

    def flaky(clean):
        calls["n"] += 1
        if calls["n"] == 2:                      # dies in the second epoch, after epoch 1 began
            raise RuntimeError("executor lost")
        return clean.withColumn("prediction", rule_prediction(1000))

    with pytest.raises(Exception):
        J.run_filter_score_job(spark, J.file_source(spark, src), state, flaky, ck)
    J.run_filter_score_job(spark, J.file_source(spark, src), state,
                           lambda c: c.withColumn("prediction", rule_prediction(1000)), ck)
    batch = clean_edits(e).withColumn("prediction", rule_prediction(1000)) \
        .filter("prediction >= 0.5 and user is not null").select("user").distinct()
    got = state.keys().select("user").distinct()
    assert sorted(r.user for r in got.collect()) == sorted(r.user for r in batch.collect())
    assert state.reports().count() == 3
