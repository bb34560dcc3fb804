from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from edgefilter.operators import evaluate as EV
from edgefilter.operators import profile as P
from edgefilter.operators.clean import clean_edits
from edgefilter.sources.tables import edits
from tests.conftest import SF01


def test_weighted_user_edits_equals_join_back(spark):
    c = clean_edits(edits(spark, SF01))
    ud = c.groupBy("user", "date").agg(F.count(F.lit(1)).alias("user_edits"))
    ref = {r.bot: r.v for r in c.join(ud, ["user", "date"]).groupBy("bot")
           .agg(F.round(F.avg("user_edits"), 6).alias("v")).collect()}
    mine = {r.bot: r.avg_user_edits for r in P.avg_user_edits_weighted(c).collect()}
    assert mine == ref


def test_duplicate_count_equals_window_form(spark):
    names = spark.read.parquet(f"{SF01}/part.parquet").select(F.col("p_name").alias("name"), "p_partkey")
    r = P.duplicate_names(names).first()
    w = Window.partitionBy("name").orderBy("name")
    ref = names.withColumn("rn", F.row_number().over(w)).filter("rn > 1").count()
    assert r.duplicate_rows == ref


def test_words_unicode_and_stop_words(spark):
    from edgefilter.functions.text import words
    df = spark.createDataFrame([("Über the Fluß, don't stop: über!",)], "c string")
    assert df.select(words(F.col("c")).alias("w")).first().w == ["über", "fluß", "stop", "über"]


def test_multiclass_metrics_match_evaluator(spark):
    rows = [(float(i % 2), float((i * 7) % 3 == 0)) for i in range(200)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    mine = EV.multiclass_metrics(pred).first()
    for metric, field in [("f1", "f1"), ("weightedPrecision", "weighted_precision"),
                          ("weightedRecall", "weighted_recall"), ("accuracy", "accuracy")]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(pred)
        assert abs(ev - mine[field]) < 1e-6, metric


def test_blacklist_evaluation_zero_denominators(spark):
    df = spark.createDataFrame([("a", False, False)], "user string, bot boolean, predicted boolean")
    r = EV.blacklist_evaluation(df).first()
    assert (r.tp, r.tn, r.precision, r.recall, r.accuracy) == (0, 1, 0.0, 0.0, 1.0)


def test_native_tokens_equal_ml_transformers(spark):
    from edgefilter.operators import model as M
    c = clean_edits(edits(spark, SF01))
    native = M.remove_stop_words(M.tokens(c)).select("id", "tokens")
    ml = M.ml_tokens(c).select("id", "tokens")
    assert native.exceptAll(ml).count() == 0 and ml.exceptAll(native).count() == 0
