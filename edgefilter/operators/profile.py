"""Edit-table profiles: averages, counts, user-day activity, correlation,
word frequencies and duplicate detection.

Every aggregate is a two-phase (partial + final) hash aggregate, so a hot
key (one user holding a third of the rows) is collapsed map-side before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgefilter.functions.text import is_stop_word, raw_words
from edgefilter.session import materialize

DIGITS = 6


def avg_length_by_bot(clean: DataFrame) -> DataFrame:
    return clean.groupBy("bot").agg(F.round(F.avg("length"), DIGITS).alias("avg_length"))


def minor_counts_by_bot(clean: DataFrame) -> DataFrame:
    return clean.groupBy("bot", "minor").agg(F.count(F.lit(1)).alias("count"))


def user_day_edits(clean: DataFrame) -> DataFrame:
    """Edits per (user, date); null user or date form their own group."""
    return clean.groupBy("user", "date").agg(F.count(F.lit(1)).alias("user_edits"))


def user_day_edits_join(clean: DataFrame) -> DataFrame:
    """Detail rows with their user-day count (inner join: null keys drop out).

    The counts are written and read again: the join then sees two plain
    shuffles (a final aggregate above one would keep AQE from its skew rule),
    so a hot user-day is split and its one count row goes to each split task;
    a small count table is broadcast instead.
    """
    agg = materialize(user_day_edits(clean.filter(F.col("user").isNotNull() & F.col("date").isNotNull())), "user_days")
    return clean.join(agg, on=["user", "date"], how="inner")


def _user_day_bot_counts(clean: DataFrame) -> DataFrame:
    """One row per non-null (user, date) with edit counts split by label."""
    keyed = clean.filter(F.col("user").isNotNull() & F.col("date").isNotNull())
    return keyed.groupBy("user", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("bot")).alias("n_bot"),
        F.count_if(~F.col("bot")).alias("n_human"),
    )


def avg_user_edits_weighted(clean: DataFrame) -> DataFrame:
    """Average of the user-day count over edit rows, by bot.

    Same value as joining the count back to every edit and averaging, but
    computed from pre-aggregated (user, date) rows: one shuffle of partial
    aggregates instead of a join of the detail rows.
    """
    ud = _user_day_bot_counts(clean)
    sums = ud.agg(
        F.sum(F.col("n_bot") * F.col("n")).alias("w_bot"), F.sum("n_bot").alias("c_bot"),
        F.sum(F.col("n_human") * F.col("n")).alias("w_human"), F.sum("n_human").alias("c_human"),
    )
    rows = sums.select(F.inline(F.array(
        F.struct(F.lit(True).alias("bot"), F.col("w_bot").alias("w"), F.col("c_bot").alias("c")),
        F.struct(F.lit(False).alias("bot"), F.col("w_human").alias("w"), F.col("c_human").alias("c")),
    )))
    return rows.filter(F.col("c") > 0).select(
        "bot", F.round(F.col("w") / F.col("c"), DIGITS).alias("avg_user_edits"))


def avg_user_edits_per_user_day(clean: DataFrame) -> DataFrame:
    """Unweighted: mean count per (user, date, bot) group, by bot."""
    keyed = clean.filter(F.col("user").isNotNull() & F.col("date").isNotNull())
    per = keyed.groupBy("user", "date", "bot").agg(F.count(F.lit(1)).alias("user_edits"))
    return per.groupBy("bot").agg(F.round(F.avg("user_edits"), DIGITS).alias("avg_user_edits"))


CORRELATION_FEATURES = ("length", "minor", "bot", "comment_length", "hour")


def feature_correlation(clean: DataFrame, features=CORRELATION_FEATURES) -> DataFrame:
    """Pearson matrix in long form (a, b, corr), all pairs, one scan.

    All coefficients come from a single global aggregate; nothing but the
    k x k result is materialised.
    """
    feats = list(features)
    num = clean.select(*[F.col(f).cast("double").alias(f) for f in feats])
    pairs = list(combinations_with_replacement(range(len(feats)), 2))
    aggs = [F.corr(feats[i], feats[j]).alias(f"c{i}_{j}") for i, j in pairs]
    one = num.agg(*aggs)
    cells = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            cells.append(F.struct(F.lit(feats[a]).alias("a"), F.lit(feats[b]).alias("b"),
                                  F.col(f"c{i}_{j}").alias("corr")))
    return one.select(F.inline(F.array(*cells))).select(
        "a", "b", F.round("corr", DIGITS).alias("corr"))


def word_counts(clean: DataFrame, language: str = "english") -> DataFrame:
    """(word, count) over the comments of the given rows."""
    w = clean.select(F.explode(raw_words(F.col("comment"))).alias("word"))
    w = w.filter(~is_stop_word(F.col("word"), language))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(clean: DataFrame, k: int = 20, language: str = "english") -> DataFrame:
    """Top-k words by count, ties by word (TakeOrderedAndProject, no full sort)."""
    return word_counts(clean, language).orderBy(F.col("count").desc(), F.col("word")).limit(k)


def duplicate_names(df: DataFrame, col: str = "name") -> DataFrame:
    """Rows beyond the first of each name, and names that repeat.

    ``sum(count - 1)`` over a grouped count equals the number of rows with
    ``row_number() > 1`` within equal names, without a window that would put
    every copy of a hot name into one task.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicated_names"),
    )
