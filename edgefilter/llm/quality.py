"""Quality classifier: a sparse ensemble of rules (RuleFit).

Statistics of a text (word and line lengths, classes of characters, repetition)
are taken in one vectorised pass. A forest of small trees is grown on
a bounded sample of labelled documents; every path from a root to a node is a
conjunctive rule over the statistics. A logistic model with lasso penalty over
rules and clipped statistics keeps a few of them. What is left is written as
one Spark column: a sum of weights of ``when(all thresholds hold)``, through
the logistic function.

Defined cases: a null text counts as empty, with all statistics 0 (and gets the
score the rules give it); a null id is scored, not learned from and not held
out; rows without a label are scored only; a document labelled twice counts by
its first label in order; other columns are kept by ``score``, also those named as
its results; a very long text is measured whole, as a block of its own; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import blocks, fresh, hash_share, id_hash_mod, raw_bytes, register, table
from edgefilter.llm.rolling import NEWLINES, Sums, words
from edgefilter.session import materialize

#: Bound of the labelled sample: about so many rows, those of smallest id hash.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 24, 3
#: Lasso strength of the logistic fit.
PENALTY = 0.003
THRESHOLD = 0.3

STATISTICS = ["log_words", "word_bytes", "word_bytes_spread", "long_words", "symbols", "marks_per_word", "pipes",
              "uppercase", "digits", "capital_words", "distinct_words", "repeated_words", "log_line_words",
              "distinct_lines", "sentence_ends", "wide_bytes"]


def _classes() -> dict[str, np.ndarray]:
    b = np.arange(256)
    of = lambda test: np.array([test(chr(i)) for i in b])
    upper, lower = of(lambda c: "A" <= c <= "Z"), of(lambda c: "a" <= c <= "z")
    return {"upper": upper, "letter": upper | lower, "digit": of(str.isdigit) & (b < 128),
            "symbol": of(lambda c: c in "#$%&*+/<=>@\\^_`{|}~"), "mark": of(lambda c: c in "!\"'(),-.:;?[]"),
            "end": of(lambda c: c in ".!?"), "pipe": b == ord("|"), "wide": b >= 128}


_CLASS = _classes()


def statistics(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each of the texts that lie end to end in ``data``."""
    n = len(ends) - 1
    size = np.maximum(np.diff(ends), 1)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])[bounds])

    count = {k: per_text(c[data], ends) for k, c in _CLASS.items()}
    starts, stops, before = words(data, ends)
    n_words = np.diff(before)
    per = np.maximum(n_words, 1)
    length = (stops - starts).astype(float)
    mean = per_text(length, before) / per
    spread = np.sqrt(np.maximum(per_text(length * length, before) / per - mean * mean, 0))
    owner = np.repeat(np.arange(n), n_words)
    sums = Sums(data.astype(np.uint64))
    h = sums.spans(starts, stops)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(of[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
        return np.bincount(of[order][new], minlength=n).astype(float)

    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    line_starts, line_stops, lines_before = words(data, ends, NEWLINES)
    lines = np.diff(lines_before)
    line_hash, line_of = sums.spans(line_starts, line_stops), np.repeat(np.arange(n), lines)
    capital = per_text(_CLASS["upper"][data[starts]].astype(float), before) if len(starts) else np.zeros(n)
    full = np.diff(ends) > 0
    letters = np.maximum(count["letter"], 1)
    out = np.column_stack([
        np.log1p(n_words), mean, spread, per_text(length > 15, before) / per, count["symbol"] / size,
        count["mark"] / per, count["pipe"] / per, count["upper"] / letters, count["digit"] / size, capital / per,
        distinct(h, owner) / per, per_text(again, before) / per, np.log1p(n_words / np.maximum(lines, 1)),
        distinct(line_hash, line_of) / np.maximum(lines, 1), count["end"] / per,
        count["wide"] / size])
    return np.where(full[:, None], out, 0.0)


def with_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` and the statistics of its text; the statistics' names in order."""
    names = [fresh(docs, s) for s in STATISTICS]
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(s, T.DoubleType()) for s in names)])
    text = fresh(docs, "text_bytes")
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start, stop in blocks(batch, text):
                part = batch.slice(start, stop - start)
                got = statistics(*raw_bytes(part.column(at)))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *(pa.array(c) for c in got.T)],
                                                 [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema), names


Rule = tuple[tuple[int, float, bool], ...]      # (statistic, threshold, above)


def tree_rules(tree) -> list[Rule]:
    """Every path from the root of one fitted tree to another node, tightest threshold by statistic and side."""
    found: list[Rule] = []

    def walk(node, path: Rule) -> None:
        if path:
            tight: dict[tuple[int, bool], float] = {}
            for stat, cut, above in path:
                had = tight.get((stat, above))
                tight[stat, above] = cut if had is None else (max if above else min)(had, cut)
            found.append(tuple(sorted((s, c, a) for (s, a), c in tight.items())))
        if node.numDescendants() > 0:
            split = node.split()
            stat, cut = split.featureIndex(), split.threshold()
            walk(node.leftChild(), (*path, (stat, cut, False)))
            walk(node.rightChild(), (*path, (stat, cut, True)))

    walk(tree._call_java("rootNode"), ())
    return found


@dataclass
class RuleEnsemble:
    """Weighted rules and weighted clipped statistics under a logistic function."""

    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[int, float, float, float]]       # statistic, lower and upper clip, weight

    def column(self, names: list[str]) -> Column:
        """The score as one Spark expression over the statistics' columns."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, names), weight).otherwise(0.0)
        for stat, low, high, weight in self.linear:
            total = total + F.least(F.greatest(F.col(names[stat]), F.lit(low)), F.lit(high)) * weight
        return 1 / (1 + F.exp(-total))


def condition(rule: Rule, names: list[str]) -> Column:
    out = F.lit(True)
    for stat, cut, above in rule:
        out = out & (F.col(names[stat]) > cut if above else F.col(names[stat]) <= cut)
    return out


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id",
        sample: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleEnsemble:
    """Fit on about ``sample`` rows of ``labelled`` with the smallest id hash (0/1 labels; all rows, if fewer)."""
    ids, label, text = (F.col(c) for c in (id_col, label_col, text_col))
    rows = labelled.where(label.isNotNull()).select(ids.alias("id"), label.cast("double").alias("label"),
                                                    text.alias("text"))
    chosen = rows.where(hash_share(F.col("id"), sample / max(1, rows.count())))
    stats, names = with_statistics(chosen, ["label"])
    # a few megabytes at any input size, so few partitions and cheap iterations
    rows = materialize(stats, "quality_sample").coalesce(4)
    rows = VectorAssembler(inputCols=names, outputCol="stats").transform(rows).select("label", "stats", *names)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:                         # nothing to tell apart: a constant
        p = 0.999 if counts.get(1.0, 0) else 0.001 if counts else 0.5
        return RuleEnsemble(float(np.log(p / (1 - p))), [], [])
    grown = RandomForestClassifier(featuresCol="stats", labelCol="label", numTrees=trees, maxDepth=depth, seed=7,
                                   subsamplingRate=0.7, featureSubsetStrategy="onethird").fit(rows)
    rules = list(dict.fromkeys(r for t in grown.trees for r in tree_rules(t)))
    # linear terms: statistics clipped at their outer 2.5 per cent
    clips = rows.select(*(F.percentile_approx(c, [0.025, 0.975], 1000).alias(c) for c in names)).first()
    linear = [(j, *map(float, clips[c])) for j, c in enumerate(names) if clips[c][1] > clips[c][0]]
    terms = [*(condition(r, names).cast("double").alias(f"r{i}") for i, r in enumerate(rules)),
             *((F.least(F.greatest(F.col(names[j]), F.lit(low)), F.lit(high))).alias(f"l{j}")
               for j, low, high in linear)]
    cols = [f"r{i}" for i in range(len(rules))] + [f"l{j}" for j, _, _ in linear]
    design = VectorAssembler(inputCols=cols, outputCol="terms").transform(rows.select("label", *terms)).select(
        "label", "terms").persist()
    lasso = LogisticRegression(featuresCol="terms", labelCol="label", elasticNetParam=1.0, regParam=penalty,
                               maxIter=40).fit(design)
    design.unpersist()
    w = lasso.coefficients.toArray()
    return RuleEnsemble(
        float(lasso.intercept), [(r, float(v)) for r, v in zip(rules, w, strict=False) if v],
        [(j, low, high, float(v)) for (j, low, high), v in zip(linear, w[len(rules):], strict=True) if v])


def score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", names: tuple[str, str] = ("score", "predicted"),
          keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score and its 0/1 decision; their names give way to columns of that name."""
    keep = docs.columns if keep is None else keep
    stats, cols = with_statistics(docs, keep, text_col)
    kept = docs.select(*keep)
    first = fresh(kept, names[0])
    second = fresh(kept.withColumn(first, F.lit(0)), names[1])
    return stats.select(*keep, model.column(cols).alias(first)).withColumn(
        second, (F.col(first) >= threshold).cast("int"))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample`` labelled rows whose crc32(doc_id) modulo 5 is not 0.

    The labels are thinned first; what is left has the sample's bound, so it is
    broadcast and no text is shuffled.
    """
    first = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("label"))
    first = first.where(id_hash_mod("doc_id", 5) != 0)
    first = first.where(hash_share(F.col("doc_id"), sample / max(1, first.count())))
    return docs.select("doc_id", "text").join(F.broadcast(materialize(first, "chosen_labels")), "doc_id")


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs, table(spark, sf_dir, "labels")))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(id_hash_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
