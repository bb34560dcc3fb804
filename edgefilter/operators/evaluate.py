"""Classification and blacklist metrics as single aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def multiclass_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Weighted precision, weighted recall, weighted F1 and accuracy.

    The class-weighted definitions of ``MulticlassClassificationEvaluator``
    (a class never predicted has precision 0), evaluated from the confusion
    counts: the only pass over the data is one grouped count; each confusion
    cell then counts once in its label role and once in its prediction role,
    summed per class without a join.
    """
    cm = confusion_matrix(pred, label, prediction)
    zero = F.lit(0).cast("bigint")
    roles = cm.select(F.inline(F.array(
        F.struct(F.col(label).alias("c"), F.col("count").alias("n_label"), zero.alias("n_pred"),
                 F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(zero).alias("tp")),
        F.struct(F.col(prediction).alias("c"), zero.alias("n_label"), F.col("count").alias("n_pred"),
                 zero.alias("tp")))))
    per = roles.groupBy("c").agg(F.sum("n_label").alias("n_label"), F.sum("n_pred").alias("n_pred"),
                                 F.sum("tp").alias("tp")).filter(F.col("n_label") > 0)
    per = per.select(
        "n_label", "tp",
        F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0).alias("p"),
        (F.col("tp") / F.col("n_label")).alias("r"))
    per = per.withColumn("f1", F.when(F.col("p") + F.col("r") > 0,
                                      2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    tot = F.sum("n_label")
    return per.agg(
        F.round(F.sum(F.col("n_label") * F.col("p")) / tot, DIGITS).alias("weighted_precision"),
        F.round(F.sum(F.col("n_label") * F.col("r")) / tot, DIGITS).alias("weighted_recall"),
        F.round(F.sum(F.col("n_label") * F.col("f1")) / tot, DIGITS).alias("f1"),
        F.round(F.sum("tp") / tot, DIGITS).alias("accuracy"),
        tot.cast("bigint").alias("n"))


def blacklist_evaluation(marked: DataFrame, truth: str = "bot", predicted: str = "predicted") -> DataFrame:
    """Accuracy, TP/FP/TN/FN, precision, recall in one aggregate; 0 for 0/0."""
    t, p = F.col(truth), F.col(predicted)
    tp, fp = F.count_if(p & t), F.count_if(p & ~t)
    tn, fn = F.count_if(~p & ~t), F.count_if(~p & t)
    agg = marked.agg(tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"),
                     F.count(F.lit(1)).alias("total"))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, DIGITS)).otherwise(F.lit(0.0))
    return agg.select(
        "tp", "fp", "tn", "fn", "total",
        ratio(F.col("tp") + F.col("tn"), F.col("total")).alias("accuracy"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
