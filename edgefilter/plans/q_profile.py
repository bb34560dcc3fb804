"""Profile queries over the cleaned edit view."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgefilter.functions.text import words_sql
from edgefilter.operators import clean as C
from edgefilter.operators import profile as P
from edgefilter.plans.registry import register
from edgefilter.sources.tables import edits, table, with_ctes


def cleaned(spark, sf_dir):
    return C.clean_edits(edits(spark, sf_dir))


def explored(spark, sf_dir):
    """Exploratory-stage view: minor not yet filled."""
    return C.clean_edits(edits(spark, sf_dir), fill_minor=False)


@register("edits_clean", with_ctes("""
select id, title, "user", bot, length, wiki, "timestamp", date, hour, minor,
       comment, comment_length, label, labelled from clean"""))
def q_edits_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("avg_user_edits_weighted", with_ctes("""
select e.bot, round(avg(u.user_edits), 6) as avg_user_edits
from clean e
join (select "user", date, count(*) as user_edits from clean
      where "user" is not null and date is not null group by 1, 2) u
  on e."user" = u."user" and e.date = u.date
group by e.bot"""))
def q_avg_user_edits_weighted(spark, sf_dir):
    return P.avg_user_edits_weighted(cleaned(spark, sf_dir))


@register("avg_user_edits_per_user_day", with_ctes("""
select bot, round(avg(n), 6) as avg_user_edits
from (select "user", date, bot, count(*) as n from clean
      where "user" is not null and date is not null group by 1, 2, 3)
group by bot"""))
def q_avg_user_edits_per_user_day(spark, sf_dir):
    return P.avg_user_edits_per_user_day(cleaned(spark, sf_dir))


@register("avg_length_by_bot", with_ctes("""
select bot, round(avg(length), 6) as avg_length from clean group by bot"""))
def q_avg_length_by_bot(spark, sf_dir):
    return P.avg_length_by_bot(cleaned(spark, sf_dir))


@register("minor_counts_by_bot", with_ctes("""
select bot, minor, count(*) as count from eda group by bot, minor"""))
def q_minor_counts_by_bot(spark, sf_dir):
    return P.minor_counts_by_bot(explored(spark, sf_dir))


@register("user_day_edits", with_ctes("""
select "user", date, count(*) as user_edits from clean group by 1, 2"""))
def q_user_day_edits(spark, sf_dir):
    return P.user_day_edits(cleaned(spark, sf_dir))


@register("user_day_edits_join", with_ctes("""
select e.id, e."user", e.date, e.bot, e.length, u.user_edits
from clean e
join (select "user", date, count(*) as user_edits from clean group by 1, 2) u
  on e."user" = u."user" and e.date = u.date"""))
def q_user_day_edits_join(spark, sf_dir):
    return P.user_day_edits_join(cleaned(spark, sf_dir)).select(
        "id", "user", "date", "bot", "length", "user_edits")


_FEATS = ("length", "minor", "bot", "comment_length", "hour")


def _corr_sql() -> str:
    parts = []
    for a in _FEATS:
        for b in _FEATS:
            parts.append(f"select '{a}' as a, '{b}' as b, "
                         f"round(corr(cast({a} as double), cast({b} as double)), 6) as corr from eda")
    return with_ctes("\nunion all\n".join(parts))


@register("feature_correlation", _corr_sql())
def q_feature_correlation(spark, sf_dir):
    return P.feature_correlation(explored(spark, sf_dir), _FEATS)


def _word_sql(bot: bool, k: int | None) -> str:
    body = f"""
select word, count(*) as count
from (select unnest({words_sql('comment')}) as word from clean where bot = {str(bot).lower()})
group by word"""
    if k is not None:
        body += f"\norder by count desc, word\nlimit {k}"
    return with_ctes(body)


@register("word_counts_bot", _word_sql(True, None))
def q_word_counts_bot(spark, sf_dir):
    return P.word_counts(C.bot_split(cleaned(spark, sf_dir))[0])


@register("word_counts_human", _word_sql(False, None))
def q_word_counts_human(spark, sf_dir):
    return P.word_counts(C.bot_split(cleaned(spark, sf_dir))[1])


@register("top_words_bot", _word_sql(True, 20))
def q_top_words_bot(spark, sf_dir):
    return P.top_words(C.bot_split(cleaned(spark, sf_dir))[0], 20)


@register("top_words_human", _word_sql(False, 20))
def q_top_words_human(spark, sf_dir):
    return P.top_words(C.bot_split(cleaned(spark, sf_dir))[1], 20)


@register("bot_human_split", with_ctes("""
select 'bot' as part, count(*) as n_rows, count(distinct "user") as n_users from clean where bot
union all
select 'human' as part, count(*) as n_rows, count(distinct "user") as n_users from clean where not bot"""))
def q_bot_human_split(spark, sf_dir):
    """Both parts summarised in one grouped aggregate (one scan, not two)."""
    part = F.when(F.col("bot"), F.lit("bot")).otherwise(F.lit("human"))
    return cleaned(spark, sf_dir).groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user").alias("n_users"))


@register("distinct_bot_users", with_ctes("""
select distinct "user" from clean where bot"""))
def q_distinct_bot_users(spark, sf_dir):
    return C.bot_split(cleaned(spark, sf_dir))[0].select("user").distinct()


@register("duplicate_names", """
select coalesce(sum(n - 1), 0)::BIGINT as duplicate_rows,
       count(*) filter (where n > 1) as duplicated_names
from (select p_name, count(*) as n from part group by p_name)""")
def q_duplicate_names(spark, sf_dir):
    return P.duplicate_names(table(spark, sf_dir, "part").select(F.col("p_name").alias("name")))
