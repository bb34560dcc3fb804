import numpy as np
from pyspark.ml import Pipeline, Transformer
from pyspark.sql import functions as F

from edgefilter.operators import model as M
from edgefilter.plans.q_model import train_test, split_clean
from tests.conftest import SF001, SF01


def test_saved_model_predicts_the_same(spark, tmp_path):
    train, test = train_test(spark, SF01)
    model = M.fit(train)
    M.save_model(model, str(tmp_path / "m"))
    back = M.load_model(str(tmp_path / "m"))
    a = model.transform(test).select("id", "prediction")
    b = back.transform(test).select("id", "prediction")
    assert a.exceptAll(b).count() == 0 and a.count() == test.count()
    assert M.best_params(back) == {"num_features": 600, "reg_param": 0.0, "elastic_net": 0.0}


def test_small_cv_grid_reports_one_best(spark):
    train, _ = train_test(spark, SF01)
    pipe = M.bot_pipeline()
    grid = M.param_grid(pipe, num_features=(300, 600), reg_param=(0.1,), elastic_net=(0.0,))
    cv = M.cross_validate(train, pipe, grid, folds=2, parallelism=2)
    report = M.grid_report(spark, cv).collect()
    assert len(report) == 2 and sum(r.best for r in report) == 1
    assert M.best_params(cv.bestModel)["num_features"] in (300, 600)


def test_scores_and_predicted_users(spark):
    train, _ = train_test(spark, SF01)
    scored = M.score(M.fit(train), split_clean(spark, SF01))
    assert scored.filter((F.col("p_bot") < 0) | (F.col("p_bot") > 1)).count() == 0
    users = M.predicted_bot_users(scored)
    assert users.filter(F.col("user").isNull()).count() == 0
    assert users.count() == users.distinct().count()


def test_hashed_tf_holds_no_table_of_cells_and_adds_up_shared_ids(spark):
    from edgefilter.operators import model as M
    rows = [(1, ["a", "b", "a"]), (2, ["b"]), (2, ["b", "c"]), (None, ["a"]), (None, ["a"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    one = M.hashed_tf(df.where("id = 1"), "id", "tokens", 1 << 20)
    assert sorted(r.tf for r in one.collect()) == [1, 2]
    assert "Aggregate" not in one._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.id is None, r.id, r.tf) for r in M.hashed_tf(df, "id", "tokens", 1 << 20).collect()), key=str)
    assert got == sorted([(False, 1, 2), (False, 1, 1), (False, 2, 2), (False, 2, 1), (True, None, 2)], key=str)


class _Counting(Transformer):
    """Passes the words on and counts the rows."""

    def __init__(self, rows):
        super().__init__()
        self.rows = rows

    def _transform(self, df):
        rows = self.rows

        def count(words):
            rows.add(1)
            return words

        return df.withColumn("counted", F.udf(count, "array<string>")("filtered_words"))


def test_texts_are_split_once_for_a_fit(spark):
    """Before, every pass of an estimator split them again."""
    train, _ = train_test(spark, SF001)
    n = train.count()
    rows = spark.sparkContext.accumulator(0)
    plain = M.bot_pipeline().getStages()
    pipe = M.bot_pipeline()
    tok, rem, tf, *rest = pipe.getStages()
    model = M.fit(train, Pipeline(stages=[tok, rem, _Counting(rows), tf.setInputCol("counted"), *rest]))
    assert rows.value == n > 0
    want = Pipeline(stages=plain).fit(train.persist())
    assert np.allclose(model.stages[-1].coefficients.toArray(), want.stages[-1].coefficients.toArray(), atol=1e-4)
    train.unpersist()
