"""Deterministic splits and the rule scorer used where results must be checkable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket, hash_bucket_sql

RULE_MIN_COMMENT_LENGTH = 4000


def split_column(key: Column, train_percent: int = 70) -> Column:
    """'train' / 'test' by md5 bucket of the key: repeatable on any partitioning."""
    return F.when(hash_bucket(key, 100) < train_percent, F.lit("train")).otherwise(F.lit("test"))


def split_sql(expr: str, train_percent: int = 70) -> str:
    return f"case when {hash_bucket_sql(expr, 100)} < {train_percent} then 'train' else 'test' end"


def hash_split(df: DataFrame, key: str = "id", train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    s = split_column(F.col(key), train_percent)
    return df.filter(s == "train"), df.filter(s == "test")


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Seeded ``randomSplit``; unlike ``hash_split`` it depends on partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def rule_prediction(min_comment_length: int = RULE_MIN_COMMENT_LENGTH) -> Column:
    """0/1 double prediction from the cleaned row, no model involved."""
    return (F.col("comment_length") >= F.lit(min_comment_length)).cast("double")


def rule_prediction_sql(min_comment_length: int = RULE_MIN_COMMENT_LENGTH) -> str:
    return f"cast(comment_length >= {min_comment_length} as double)"


def rule_score(clean: DataFrame, min_comment_length: int = RULE_MIN_COMMENT_LENGTH) -> DataFrame:
    return clean.withColumn("prediction", rule_prediction(min_comment_length))
