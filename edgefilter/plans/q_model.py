"""Text features, classifier and metrics (SURVEY 2.2 P14, 2.4 A10, 2.9 L1, L11-L18,
2.10 E1, 2.1 S11)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from edgefilter.functions.hashing import md5_u32_sql
from edgefilter.functions.text import stop_words_sql
from edgefilter.operators import evaluate as EV
from edgefilter.operators import linear as LIN
from edgefilter.operators import model as M
from edgefilter.operators.clean import clean_edits
from edgefilter.operators.scoring import rule_prediction, rule_prediction_sql, split_column, split_sql
from edgefilter.plans.registry import register
from edgefilter.session import materialize, scratch_path
from edgefilter.sources.tables import edits, with_ctes


def split_clean(spark, sf_dir):
    return clean_edits(edits(spark, sf_dir)).withColumn("split", split_column(F.col("id")))


def train_test(spark, sf_dir, materialized: bool = False):
    """Labelled rows only, split 70/30 by a hash of the id.

    ``materialized`` writes the labelled rows once, so a fit and its
    evaluation read them instead of deriving them from the edits join twice;
    the files are read in partitions of ``maxPartitionBytes``.
    """
    s = split_clean(spark, sf_dir).filter(F.col("labelled"))
    if materialized:
        s = materialize(s, "labelled")
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


# -- relational text features -------------------------------------------------------

_TOKENS_SQL = r"list_filter(string_split_regex(lower(comment), '\s'), lambda t: t <> '')"
_FILTERED_SQL = f"list_filter({_TOKENS_SQL}, lambda t: not list_contains({stop_words_sql()}, t))"
_TF_SQL = f"""
select id, {md5_u32_sql('term')} % {M.NUM_FEATURES} as bucket, count(*) as tf
from (select id, unnest({_FILTERED_SQL}) as term from clean) group by all"""


@register("tokenize", with_ctes(f"select id, {_TOKENS_SQL} as tokens from clean"))
def q_tokenize(spark, sf_dir):
    return M.tokens(clean_edits(edits(spark, sf_dir))).select("id", "tokens")


@register("remove_stop_words", with_ctes(f"select id, {_FILTERED_SQL} as tokens from clean"))
def q_remove_stop_words(spark, sf_dir):
    return M.remove_stop_words(M.tokens(clean_edits(edits(spark, sf_dir)))).select("id", "tokens")


def _docs(spark, sf_dir):
    return M.remove_stop_words(M.tokens(clean_edits(edits(spark, sf_dir))))


def _tf(spark, sf_dir):
    return M.hashed_tf(_docs(spark, sf_dir), "id", "tokens", M.NUM_FEATURES)


@register("hashed_tf", with_ctes(_TF_SQL))
def q_hashed_tf(spark, sf_dir):
    return _tf(spark, sf_dir)


@register("idf_weights", with_ctes(f"""
select bucket, count(*) as doc_freq,
       round(ln(((select count(*) from clean) + 1) / (count(*) + 1)), 6) as idf
from ({_TF_SQL}) group by bucket"""))
def q_idf_weights(spark, sf_dir):
    return M.idf_weights(_docs(spark, sf_dir), "tokens", M.NUM_FEATURES)


# -- rule-scored metrics (checkable) ---------------------------------------------------

_RULE_TEST = ("t", f"select label, {rule_prediction_sql()} as prediction from clean "
                   f"where labelled and {split_sql('id')} = 'test'")


def _rule_test(spark, sf_dir):
    _, test = train_test(spark, sf_dir)
    return test.withColumn("prediction", rule_prediction())


@register("confusion_matrix", with_ctes("select label, prediction, count(*) as count from t group by all",
                                        extra=[_RULE_TEST]))
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_rule_test(spark, sf_dir))


@register("classification_metrics", with_ctes("""
select round(sum(n_label * p) / sum(n_label), 6) as weighted_precision,
       round(sum(n_label * r) / sum(n_label), 6) as weighted_recall,
       round(sum(n_label * f1) / sum(n_label), 6) as f1,
       round(sum(tp) / sum(n_label), 6) as accuracy,
       cast(sum(n_label) as bigint) as n
from (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f1
      from (select bl.c, n_label, tp,
                   case when coalesce(n_pred, 0) > 0 then tp / n_pred else 0.0 end as p,
                   tp / n_label as r
            from (select label as c, sum(cnt) as n_label,
                         sum(case when label = prediction then cnt else 0 end) as tp
                  from cm group by 1) bl
            left join (select prediction as c, sum(cnt) as n_pred from cm group by 1) bp on bl.c = bp.c))""",
    extra=[_RULE_TEST, ("cm", "select label, prediction, count(*) as cnt from t group by all")]))
def q_classification_metrics(spark, sf_dir):
    return EV.multiclass_metrics(_rule_test(spark, sf_dir))


# -- Spark ML model ----------------------------------------------------------------------
# The optimiser of Spark ML has no SQL equivalent: these two queries return what must hold
# for any fit. The queries after them fit `operators/linear.py`, which SQL repeats.

_LABELLED = "labelled and split = 'test'"
_SPLIT = [("s", f"select *, {split_sql('id')} as split from clean")]


def _fit_default(spark, sf_dir):
    """Fit on persisted training rows: IDF and every optimiser pass re-read them."""
    train, test = train_test(spark, sf_dir, materialized=True)
    return M.fit(train), test


@register("feature_vectors", with_ctes(f"""
select id, {M.NUM_FEATURES + 2} as n_features, minor::DOUBLE as minor_feature,
       comment_length::DOUBLE as length_feature from clean"""))
def q_feature_vectors(spark, sf_dir):
    """Size of each assembled vector and its two plain features, the last two places."""
    train, _ = train_test(spark, sf_dir)
    from pyspark.ml import Pipeline
    fm = Pipeline(stages=M.feature_stages()).fit(train)
    v = fm.transform(split_clean(spark, sf_dir)).select("id", vector_to_array("features").alias("f"))
    return v.select("id", F.size("f").alias("n_features"), F.element_at("f", -2).alias("minor_feature"),
                    F.element_at("f", -1).alias("length_feature"))


# -- the model that SQL repeats ------------------------------------------------------------
_TOKENS = (f"select *, {split_sql('id')} as split, {md5_u32_sql('id', 1)} % {M.FOLDS} as fold, {_FILTERED_SQL} as tokens "
           "from clean")
_ROWS = [("rows", _TOKENS), ("train", "select * from rows where labelled and split = 'train'")]


def model_sql(body: str, source: str | None = None, extra: list | None = None, settings=None) -> str:
    fitted = _ROWS + LIN.fit_sql(settings or [LIN.Setting()])
    return with_ctes(body, extra=fitted + (LIN.score_sql(source) if source else []) + (extra or []), materialized=True)


def _metrics_sql(where: str) -> str:
    """Metrics of the scored rows of ``where``, from their confusion counts."""
    f1 = "coalesce(2 * hit / nullif(of_c + said, 0), 0)"
    return model_sql(f"""
select round(sum(of_c * coalesce(hit / nullif(said, 0), 0)) / sum(of_c), 6) as weighted_precision,
       round(sum(hit) / sum(of_c), 6) as weighted_recall, round(sum(of_c * {f1}) / sum(of_c), 6) as f1,
       round(sum(hit) / sum(of_c), 6) as accuracy, sum(of_c)::BIGINT as n
from (select c, count(*) filter (label = c) as of_c, count(*) filter (said = c) as said,
             count(*) filter (label = c and said = c) as hit
      from told cross join (values (0.0), (1.0)) v(c) group by c) where of_c > 0""", "rows", [
        ("told", f"select r.label, (p > {M.THRESHOLD})::INT::DOUBLE as said from rows r join scored using (id) where {where}")])


def _fit_linear(spark, sf_dir):
    """The model of the labelled training rows, and all cleaned rows with their split."""
    rows = split_clean(spark, sf_dir)
    return LIN.fit(rows.filter(F.col("labelled") & (F.col("split") == "train"))), rows


@register("bot_model_weights", model_sql(f"select b::INT as feature, round(w, 6) as weight from w{LIN.STEPS}"))
def q_bot_model_weights(spark, sf_dir):
    """Weights of the buckets, of minor, length and the constant."""
    model, _ = _fit_linear(spark, sf_dir)
    return LIN.weights_table(spark, model).select("feature", F.round("weight", 6).alias("weight"))


@register("train_bot_model", _metrics_sql("labelled and split = 'test'"))
def q_train_bot_model(spark, sf_dir):
    """Metrics of the fitted model on the held-out rows."""
    model, rows = _fit_linear(spark, sf_dir)
    return EV.multiclass_metrics(LIN.score(model, rows.filter(F.col("labelled") & (F.col("split") == "test")), ["label"]))


@register("score_edits", model_sql(f"""
select r.id, r."user", r.label, round(p, 6) as p_bot, (p > {M.THRESHOLD})::INT::DOUBLE as prediction
from rows r join scored using (id)""", "rows"))
def q_score_edits(spark, sf_dir):
    model, rows = _fit_linear(spark, sf_dir)
    return LIN.score(model, rows, ["id", "user", "label"]).withColumn("p_bot", F.round("p_bot", 6))


@register("predicted_bots", model_sql(f"""
select distinct r."user" from rows r join scored using (id) where p > {M.THRESHOLD} and r."user" is not null""", "rows"))
def q_predicted_bots(spark, sf_dir):
    """Users with an edit predicted bot."""
    model, rows = _fit_linear(spark, sf_dir)
    return M.predicted_bot_users(LIN.score(model, rows, ["user"]))


@register("model_roundtrip", with_ctes(f"""
select count(*) as n, count(*) as n_agree from s where {_LABELLED}""", extra=_SPLIT))
def q_model_roundtrip(spark, sf_dir):
    """Rows on which the saved and loaded model decides as the fitted one."""
    model, test = _fit_default(spark, sf_dir)
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    first = model.transform(test).select("id", "label", "comment", "minor", "comment_length",
                                         F.col("prediction").alias("fitted"))
    return M.load_model(path).transform(first).agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("fitted")).alias("n_agree"))


@register("cv_grid", model_sql(f"""
select num_features, reg_param, elastic_net, f1, row_number() over (order by f1 desc, num_features, reg_param, elastic_net) = 1 as best
from (select size as num_features, reg as reg_param, en as elastic_net, round(avg(f1), 6) as f1 from (
  select size, lft, m, sum(of_c * coalesce(2 * hit / nullif(of_c + said, 0), 0)) / sum(of_c) as f1 from (
    select size, lft, m, c, count(*) filter (label = c) as of_c, count(*) filter (said = c) as said,
           count(*) filter (label = c and said = c) as hit
    from told cross join (values (0.0), (1.0)) v(c) group by all) group by all) join hyper using (size, lft, m) group by all)""",
    settings=LIN.grid_settings(), extra=[("told", f"""
select z.size, z.lft, z.m, t.label, (z.p > {M.THRESHOLD})::INT::DOUBLE as said from (
  select f.size, f.lft, w.m, f.id, 1 / (1 + exp(-sum(f.x * w.w))) as p
  from feat f join w{LIN.STEPS} w on w.size = f.size and w.lft = f.lft and w.b = f.b group by all) z
join train t on t.id = z.id where t.fold = z.lft""")]))
def q_cv_grid(spark, sf_dir):
    """The original 36-point, 3-fold model selection, all 108 models trained together; one row per grid point."""
    train, _ = train_test(spark, sf_dir)
    return LIN.select_model(train)


@register("model_metrics_extended", _metrics_sql("labelled"))
def q_model_metrics_extended(spark, sf_dir):
    """The saved model, reloaded, scored on every labelled edit (a second,
    larger sample than the hold-out) with the same metrics."""
    model, rows = _fit_linear(spark, sf_dir)
    path = scratch_path(spark, "model_ext")
    LIN.save(spark, model, path)
    return EV.multiclass_metrics(LIN.score(LIN.load(spark, path), rows.filter("labelled"), ["label"]))
