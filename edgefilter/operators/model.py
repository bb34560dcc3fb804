"""Bot classifier: text features, logistic regression, model selection, scoring.

The model path is Spark ML end to end (Tokenizer, StopWordsRemover,
HashingTF, IDF, VectorAssembler, LogisticRegression). For checkable
feature values there is also a relational term hashing with md5 buckets
(``hashed_tf`` / ``idf_weights``) that any SQL engine can repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.functions.hashing import md5_u32
from edgefilter.functions.text import stop_words
from edgefilter.session import materialize

# The original model-selection grid and feature size.
NUM_FEATURES = 600
GRID_NUM_FEATURES = (300, 500, 600, 1000)
GRID_REG_PARAM = (0.01, 0.1, 1.0)
GRID_ELASTIC_NET = (0.0, 0.5, 1.0)
FOLDS = 3
THRESHOLD = 0.5


def feature_stages(num_features: int = NUM_FEATURES, language: str = "english"):
    tok = Tokenizer(inputCol="comment", outputCol="tokenized_words")
    rem = StopWordsRemover(inputCol="tokenized_words", outputCol="filtered_words",
                           stopWords=stop_words(language), locale="en_US")
    tf = HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features)
    idf = IDF(inputCol="raw_features", outputCol="text_features")
    asm = VectorAssembler(inputCols=["text_features", "minor", "comment_length"], outputCol="features")
    return [tok, rem, tf, idf, asm]


def bot_pipeline(num_features: int = NUM_FEATURES, reg_param: float = 0.0,
                 elastic_net: float = 0.0) -> Pipeline:
    """Six stages; the input must be ``clean_edits`` output (no NULL comment/minor)."""
    lr = LogisticRegression(featuresCol="features", labelCol="label",
                            regParam=reg_param, elasticNetParam=elastic_net)
    return Pipeline(stages=feature_stages(num_features) + [lr])


def param_grid(pipeline: Pipeline, num_features=GRID_NUM_FEATURES, reg_param=GRID_REG_PARAM,
               elastic_net=GRID_ELASTIC_NET):
    tf, lr = pipeline.getStages()[2], pipeline.getStages()[5]
    return (ParamGridBuilder().addGrid(tf.numFeatures, list(num_features))
            .addGrid(lr.regParam, list(reg_param)).addGrid(lr.elasticNetParam, list(elastic_net)).build())


def f1_evaluator(metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)


def _columns_used(stages: list) -> set[str]:
    """The columns that the stages' parameters name."""
    used: set[str] = set()
    for stage in stages:
        for p in stage.params:
            if p.name.endswith(("Col", "Cols")) and stage.isDefined(p):
                value = stage.getOrDefault(p)
                used |= {value} if isinstance(value, str) else set(value)
    return used


def fit(train: DataFrame, pipeline: Pipeline | None = None) -> PipelineModel:
    """Fit the bot pipeline (write the training rows first if deriving them is dear: they are read in partitions by bytes).

    The transformers before the first estimator learn nothing. What they make of
    the rows is written once, so that the passes of the estimators read features
    and don't split the texts into words again and again; no text is cached.
    """
    stages = (pipeline or bot_pipeline()).getStages()
    lead = list(takewhile(lambda s: isinstance(s, Transformer), stages))
    rest = stages[len(lead):]
    made = PipelineModel(lead).transform(train)
    used = _columns_used(rest)
    features = materialize(made.select(*[c for c in made.columns if c in used]), "features")
    return PipelineModel(lead + Pipeline(stages=rest).fit(features).stages)


def cross_validate(train: DataFrame, pipeline: Pipeline | None = None, grid=None,
                   folds: int = FOLDS, parallelism: int = 2, seed: int = 42):
    """k-fold CV maximising weighted F1; returns the fitted CrossValidatorModel."""
    pipeline = pipeline or bot_pipeline()
    grid = grid if grid is not None else param_grid(pipeline)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f1_evaluator(),
                        numFolds=folds, parallelism=parallelism, seed=seed)
    rows = train.persist()
    try:
        return cv.fit(rows)
    finally:
        rows.unpersist()


def best_params(model: PipelineModel) -> dict:
    """Chosen hyper-parameters through the public getters."""
    tf, lr = model.stages[2], model.stages[5]
    return {"num_features": tf.getNumFeatures(), "reg_param": lr.getRegParam(),
            "elastic_net": lr.getElasticNetParam()}


def grid_report(spark, cv_model) -> DataFrame:
    """One row per grid point: parameters, mean F1 over folds, best flag.

    The grid is a fixed, small parameter list, so building its report on
    the driver is bounded.
    """
    metrics = list(cv_model.avgMetrics)
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, (pm, m) in enumerate(zip(cv_model.getEstimatorParamMaps(), metrics)):
        vals = {p.name: v for p, v in pm.items()}
        rows.append((int(vals["numFeatures"]), float(vals["regParam"]), float(vals["elasticNetParam"]),
                     float(round(m, 6)), i == best))
    return spark.createDataFrame(
        rows, "num_features int, reg_param double, elastic_net double, f1 double, best boolean")


def score(model: PipelineModel, clean: DataFrame) -> DataFrame:
    """Predictions with the bot probability as a plain double."""
    out = model.transform(clean)
    return out.withColumn("p_bot", vector_to_array("probability")[1])


def predicted_bot_users(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct non-null users with at least one edit predicted bot."""
    return scored.filter(F.col("prediction") >= threshold).select("user") \
                 .filter(F.col("user").isNotNull()).distinct()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- relational term hashing (checkable) ------------------------------------------

def tokens(df: DataFrame, text: str = "comment") -> DataFrame:
    """Whitespace tokens as the ML Tokenizer makes them (lower-case, split on
    single whitespace), without the empty ones; native expressions, so they
    stay inside whole-stage code generation."""
    toks = F.split(F.lower(F.col(text)), r"\s")
    return df.withColumn("tokens", F.filter(toks, lambda t: t != ""))


def remove_stop_words(df: DataFrame, col: str = "tokens", language: str = "english") -> DataFrame:
    """The StopWordsRemover filter on lower-case tokens, as a hash-set IN."""
    sw = stop_words(language)
    return df.withColumn(col, F.filter(F.col(col), lambda t: ~t.isin(sw)))


def ml_tokens(df: DataFrame, text: str = "comment") -> DataFrame:
    """Same tokens through the ML transformers (the model pipeline's stages)."""
    toks = Tokenizer(inputCol=text, outputCol="_tok").transform(df)
    rem = StopWordsRemover(inputCol="_tok", outputCol="_f", stopWords=stop_words(), locale="en_US")
    return rem.transform(toks).withColumn("tokens", F.filter("_f", lambda t: t != "")).drop("_tok", "_f")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, bucket, tf) of rows (doc, buckets of its terms), a few thousand rows at a time."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2048):
            batch = whole.slice(start, 2048)
            lists = batch.column(1)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            pairs = np.column_stack([row, lists.flatten().to_numpy(zero_copy_only=False)])
            cells, tf = np.unique(pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))], axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cells[:, 0], pa.int64())),
                                              pa.array(cells[:, 1], pa.int64()), pa.array(tf, pa.int64())], ["doc", "bucket", "tf"])


def hashed_tf(docs: DataFrame, doc_id: str, terms: str, num_features: int = NUM_FEATURES) -> DataFrame:
    """(doc, bucket, tf): term counts folded into md5 buckets.

    A row's terms are counted where the row is: no table of (doc, bucket) is held
    or shuffled. Only rows that share an id are added up afterwards, by id and bucket.
    """
    doc = docs.schema[doc_id]
    buckets = F.transform(terms, lambda t: F.pmod(md5_u32(t), F.lit(num_features)))
    kinds = T.StructType([T.StructField("doc", doc.dataType), T.StructField("bucket", T.LongType()), T.StructField("tf", T.LongType())])
    counted = docs.select(F.col(doc_id).alias("doc"), buckets.alias("b")).mapInArrow(_counted, kinds)
    shared = materialize(docs.groupBy(F.col(doc_id).alias("same")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("same"),
                         "shared_ids")
    if not shared.isEmpty():
        is_shared = F.col("doc").eqNullSafe(F.col("same"))
        added = counted.join(shared, is_shared, "left_semi").groupBy("doc", "bucket").agg(F.sum("tf").alias("tf"))
        counted = counted.join(shared, is_shared, "left_anti").unionByName(added)
    return counted.select(F.col("doc").alias(doc_id), "bucket", "tf")


def idf_weights(docs: DataFrame, terms: str, num_features: int = NUM_FEATURES) -> DataFrame:
    """(bucket, doc_freq, idf) with idf = ln((N + 1) / (df + 1)), as ML's IDF.

    Document frequency needs only the distinct buckets of each document
    (``array_distinct`` inside the row), so the shuffle carries at most
    ``num_features`` partial counts per task, not the (doc, bucket) table.
    Every document also emits the marker bucket -1, whose frequency is N,
    so the document count comes from the same pass; it is attached to the
    other buckets over the aggregated table, at most num_features + 1 rows.
    """
    buckets = F.array_union(
        F.array_distinct(F.transform(F.array_distinct(terms), lambda t: F.pmod(md5_u32(t), F.lit(num_features)))),
        F.array(F.lit(-1).cast("bigint")))
    dfreq = docs.select(F.explode(buckets).alias("bucket")).groupBy("bucket") \
                .agg(F.count(F.lit(1)).alias("doc_freq"))
    n_docs = F.max(F.when(F.col("bucket") == -1, F.col("doc_freq"))).over(Window.partitionBy())
    return (dfreq.withColumn("_n", n_docs).filter(F.col("bucket") >= 0)
                 .select("bucket", "doc_freq",
                         F.round(F.log((F.col("_n") + 1) / (F.col("doc_freq") + 1)), 6).alias("idf")))
