"""From raw documents to token ids, in five stages.

Each stage gets what its predecessor kept, written as Parquet and read again:

1. language     documents without text (null, or no letter) go; a null lang is
                filled with the predicted one, a given lang stays
2. near_dedup   one document of each SimHash component stays, the smallest id
3. decontaminate documents that hold a benchmark item go
4. secrets      confirmed secrets are replaced by a mark in the text
5. encode       whole texts as BPE ids, and decoded back

All but the last return the columns of `documents`. The models of stages 1 and
4 are fitted on the stage's own input. Empty tables pass through; nulls, equal
rows and extra columns are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.llm import bpe, decontaminate, langid, secrets, simhash
from edgefilter.llm.common import fresh, table
from edgefilter.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    told = langid.predict(docs, langid.fit_on_known(docs), names=names)
    # a text with letters stays, also if there is no known language to learn from
    lang = F.coalesce(F.col("lang"), F.nullif(F.col(names[0]), F.lit(langid.UNKNOWN)))
    return told.where(F.col("text").rlike(r"\p{L}")).withColumn("lang", lang).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (decimal, joined by spaces), decoded."""
    return bpe.encode(docs, keep=["doc_id", "lang", "source"])


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", without_benchmark),
          ("secrets", without_secrets), ("encode", encode)]

# SQL can express neither the language model nor the forest nor the merges; tests/llm/test_pipeline.py has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage but the last is written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
