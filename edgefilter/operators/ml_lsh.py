"""Spark ML path of the similar-name search: Word2Vec name vectors and the
ML bucketed random-projection LSH, evaluated against exact kNN.

The ML model supplies the hash values (``model.transform``); candidate
pairs then go through the same broadcast bucket join as the relational LSH
(one row per pair, no de-duplication shuffle), and recall is one batch job
instead of a driver loop of per-query jobs.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer, Tokenizer, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgefilter.operators import knn
from edgefilter.session import cut_lineage

VEC = "NormalizedWord2Vec"
VECTOR_SIZE = 100


def name_pipeline(seed: int = 42, vector_size: int = VECTOR_SIZE, num_partitions: int = 1) -> Pipeline:
    """Tokenizer -> Word2Vec (minCount 0) -> L2 Normalizer.

    ``num_partitions`` > 1 trains Word2Vec in parallel (per-partition
    updates merged, as Spark documents); with 1 the whole corpus is trained
    in a single task.
    """
    tok = Tokenizer(inputCol="name", outputCol="words")
    w2v = Word2Vec(inputCol="words", outputCol="word2vec", minCount=0, seed=seed,
                   vectorSize=vector_size, numPartitions=num_partitions)
    norm = Normalizer(inputCol="word2vec", outputCol=VEC, p=2.0)
    return Pipeline(stages=[tok, w2v, norm])


def name_vectors(names: DataFrame, seed: int = 42, num_partitions: int | None = None) -> DataFrame:
    """(name, NormalizedWord2Vec) for a DataFrame with a ``name`` column.

    Training runs on ``num_partitions`` tasks, by default the cluster's
    default parallelism, so no single task holds the whole corpus. (Spark's
    Word2Vec keeps its vocabulary on the driver; with minCount 0 that is
    every distinct token.)
    """
    if num_partitions is None:
        num_partitions = max(1, names.sparkSession.sparkContext.defaultParallelism)
    model: PipelineModel = name_pipeline(seed, num_partitions=num_partitions).fit(names)
    return model.transform(names).select("name", VEC)


def fit_lsh(df: DataFrame, num_hash_tables: int, bucket_length: float, seed: int = 42):
    brp = BucketedRandomProjectionLSH(inputCol=VEC, outputCol="hashes", seed=seed,
                                      numHashTables=num_hash_tables, bucketLength=bucket_length)
    return brp.fit(df)


def hash_arrays(model, df: DataFrame) -> DataFrame:
    """df with ``hash_values``: array<bigint>, one bucket id per table."""
    hashed = model.transform(df)
    return hashed.withColumn("hash_values",
                             F.transform("hashes", lambda h: vector_to_array(h)[0].cast("bigint")))


def with_arrays(df: DataFrame) -> DataFrame:
    return df.withColumn("vec", vector_to_array(VEC))


def ann_topk(model, data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(q_id, name, dist, rank): k nearest among rows sharing an ML bucket."""
    dh = hash_arrays(model, data).select("name", vector_to_array(VEC).alias("vec"),
                                         F.col("hash_values").alias("_h"))
    qh = hash_arrays(model, queries).select(F.col("name").alias("q_id"),
                                            vector_to_array(VEC).alias("q_vec"),
                                            F.col("hash_values").alias("_qh"))
    cands = knn.bucket_join(dh, qh, "name", "vec")
    return knn.rank_candidates(cands, "name", "vec", k)


def query_rows(data: DataFrame, percent: int = 10, max_queries: int = 50) -> DataFrame:
    """Bounded query sample keeping the ML vector column (for model.transform)."""
    q = knn.query_set(data.withColumn("_v", F.col(VEC)), "name", "_v", percent, max_queries)
    return q.select(F.col("q_id").alias("name"), F.col("q_vec").alias(VEC))


def _exact_for(data: DataFrame, queries: DataFrame, k: int):
    arr = data.select("name", vector_to_array(VEC).alias("vec"))
    q_arr = queries.select(F.col("name").alias("q_id"), vector_to_array(VEC).alias("q_vec"))
    return knn.exact_knn(arr, q_arr, "name", "vec", k), q_arr


def recall_ml(model, data: DataFrame, k: int, percent: int = 10, max_queries: int = 50,
              exact: DataFrame | None = None, queries: DataFrame | None = None,
              n_rows: int | None = None) -> DataFrame:
    """Mean recall@k of the ML LSH model against exact kNN on the same vectors."""
    if queries is None:
        queries = query_rows(data, percent, max_queries)
    ex, q_arr = _exact_for(data, queries, k)
    exact = ex if exact is None else exact
    approx = ann_topk(model, data, queries, k)
    return knn.recall_of(exact, approx, q_arr, "name", k, data.count() if n_rows is None else n_rows)


def tune(data: DataFrame, tables=(1, 3, 5), lengths=(0.5, 1.0, 2.0), k: int = 250,
         seed: int = 42, percent: int = 10, max_queries: int = 50) -> DataFrame:
    """Recall for every grid point, as one DataFrame.

    The vectors, the query sample and the exact neighbours (bounded by
    queries x k rows) are materialised once and shared by all grid points;
    each fit only draws random directions, and every evaluation runs when
    the result is consumed.
    """
    data = cut_lineage(data)
    queries = cut_lineage(query_rows(data, percent, max_queries))
    exact = cut_lineage(_exact_for(data, queries, k)[0])
    n_rows = data.count()
    parts = []
    for t in tables:
        for b in lengths:
            model = fit_lsh(data, t, b, seed)
            r = recall_ml(model, data, k, exact=exact, queries=queries, n_rows=n_rows)
            parts.append(r.select(F.lit(int(t)).alias("num_hash_tables"),
                                  F.lit(float(b)).alias("bucket_length"), "n_queries", "recall"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
