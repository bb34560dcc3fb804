"""Scans, sinks, projections, sampling and set operations (SURVEY 2.1, 2.2 P1/P2,
2.6 K4-K6, 2.7 U1/U4, 2.8 F1/F2/F9/F10/F13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket, hash_bucket_sql
from edgefilter.operators.clean import change_event_skips, clean_edits, normalize_change_events
from edgefilter.operators.scoring import split_column, split_sql
from edgefilter.plans.registry import register
from edgefilter.schemas import EDIT_COLUMNS
from edgefilter.session import scratch_path
from edgefilter.sources import files as FS
from edgefilter.sources.tables import EDITS_SQL, edits, table, with_ctes
from edgefilter.streaming.parse import parse_edit_json

SAMPLE_PERCENT = 20
SINCE = "2024-01-03 00:00:00"
_COLS = ", ".join(f'"{c}"' for c in EDIT_COLUMNS)


def user_sample(df, percent: int = SAMPLE_PERCENT):
    """All edits of about ``percent`` % of users (md5 bucket of the name);
    NULL users are never sampled."""
    return df.filter(hash_bucket(F.col("user"), 100) < percent)


@register("listings_csv_scan", """
select p_partkey as id, p_name as name, p_brand as brand, p_retailprice as price from part""")
def q_listings_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "listings")
    FS.write_listings_csv(FS.listings_from_parts(table(spark, sf_dir, "part")), path)
    return FS.read_listings_csv(spark, path)


@register("edits_csv_scan", f"select {_COLS} from ({EDITS_SQL})")
def q_edits_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "edits_csv")
    FS.write_edits_csv(edits(spark, sf_dir), path)
    return FS.read_edits_csv(spark, path)


ARTICLE_SQL = (
    f"upper(substr(regexp_extract(url, '{FS.ARTICLE_HOST_RE}', 1), 1, 1)) || "
    f"substr(regexp_extract(url, '{FS.ARTICLE_HOST_RE}', 1), 2) || '_' || "
    f"regexp_extract(url, '{FS.ARTICLE_LANG_RE}', 1) || '_' || "
    f"regexp_extract(url, '{FS.ARTICLE_PAGE_RE}', 1)")


def _articles(spark, sf_dir):
    path = scratch_path(spark, "pageviews")
    FS.write_pageviews_json(table(spark, sf_dir, "pages"), path)
    return FS.read_pageviews(spark, path)


@register("articles_flatten", f"select {ARTICLE_SQL} as article from pages")
def q_articles_flatten(spark, sf_dir):
    return _articles(spark, sf_dir)


@register("articles_normalize", f"""
select distinct lower(replace({ARTICLE_SQL}, '_', ' ')) as name from pages
where lower(replace({ARTICLE_SQL}, '_', ' ')) <> ''""")
def q_articles_normalize(spark, sf_dir):
    return FS.normalize_article_names(_articles(spark, sf_dir))


@register("distinct_names", "select distinct p_name as name from part")
def q_distinct_names(spark, sf_dir):
    listings = FS.listings_from_parts(table(spark, sf_dir, "part"))
    return listings.dropDuplicates(["name"]).select("name")


@register("edits_to_json", f"""
select id, to_json(struct_pack(id := id, title := title, "user" := "user", bot := bot,
       length := length, wiki := wiki, "timestamp" := "timestamp", minor := minor,
       comment := comment)) as value
from ({EDITS_SQL})""")
def q_edits_to_json(spark, sf_dir):
    return FS.edits_to_json(edits(spark, sf_dir))


_RAW_SQL = """
select d.doc_id as id,
       case when e.event_type in ('click', 'view', 'purchase') then 'edit'
            when e.event_type = 'signup' then 'new' else 'log' end as type,
       d.lang || '.wikipedia.org' as server_name,
       'doc ' || cast(d.doc_id as varchar) || ', ' || d.source as title,
       case when d.doc_id % 7 = 0 then 'user,' else 'user' end || cast(e.user_id as varchar) as "user",
       e.event_type = 'error' as bot, d.lang || 'wiki' as wiki,
       e.event_type in ('click', 'view') as minor, d.text as comment,
       cast(floor(epoch(e.ts)) as bigint) as epoch_s,
       cast(floor(e.value) as int) - case when d.doc_id % 13 = 0 then null else 50 end as length
from documents d join events e on e.event_id = d.doc_id"""


_COMPLETE_SQL = " and ".join(f'{c} is not null' for c in (
    "id", "title", '"user"', "bot", "length", "wiki", "epoch_s", "minor", "comment"))


@register("normalize_change_events", f"""
select id, replace(title, ',', '') as title, replace("user", ',', '') as "user", bot, length,
       replace(wiki, ',', '') as wiki,
       strftime(make_timestamp(epoch_s * 1000000), '%Y-%m-%d %H:%M:%S') as "timestamp",
       minor, replace(comment, ',', '') as comment
from ({_RAW_SQL})
where server_name in ('en.wikipedia.org', 'de.wikipedia.org') and type = 'edit'
  and epoch_s >= epoch(timestamp '{SINCE}') and {_COMPLETE_SQL}""")
def q_normalize_change_events(spark, sf_dir):
    return normalize_change_events(_raw_changes(spark, sf_dir), since=SINCE)


@register("change_event_skips", f"""
select count(*) filter (where {_COMPLETE_SQL}) as n_kept, count(*) filter (where not ({_COMPLETE_SQL})) as n_skipped
from ({_RAW_SQL})
where server_name in ('en.wikipedia.org', 'de.wikipedia.org') and type = 'edit'
  and epoch_s >= epoch(timestamp '{SINCE}')""")
def q_change_event_skips(spark, sf_dir):
    return change_event_skips(_raw_changes(spark, sf_dir), since=SINCE)


def _raw_changes(spark, sf_dir):
    raw = FS.raw_changes_from_tables(table(spark, sf_dir, "documents"), table(spark, sf_dir, "events"))
    path = scratch_path(spark, "raw_changes")
    raw.write.mode("overwrite").json(path)
    return FS.read_raw_changes(spark, path)


@register("user_hash_sample", f"""
select id, "user" from ({EDITS_SQL}) where {hash_bucket_sql('"user"', 100)} < {SAMPLE_PERCENT}""")
def q_user_hash_sample(spark, sf_dir):
    return user_sample(edits(spark, sf_dir)).select("id", "user")


@register("sample_sink", f"""
select {_COLS} from ({EDITS_SQL}) where {hash_bucket_sql('"user"', 100)} < {SAMPLE_PERCENT}""")
def q_sample_sink(spark, sf_dir):
    """User-sampled edits appended as CSV (bounded files), read back."""
    path = scratch_path(spark, "sample_csv")
    FS.write_edits_csv(user_sample(edits(spark, sf_dir)), path)
    return FS.read_edits_csv(spark, path)


@register("train_test_split", with_ctes(f"select id, {split_sql('id')} as split from clean"))
def q_train_test_split(spark, sf_dir):
    return clean_edits(edits(spark, sf_dir)).select("id", split_column(F.col("id")).alias("split"))


@register("batch_union", f"""
select {_COLS} from ({EDITS_SQL})
union all
select {_COLS} from ({EDITS_SQL})""")
def q_batch_union(spark, sf_dir):
    """Bag union of two batches of the same edits delivered through two
    different sinks (CSV files and JSON lines)."""
    e = edits(spark, sf_dir)
    csv_path, json_path = scratch_path(spark, "batch_csv"), scratch_path(spark, "batch_json")
    FS.write_edits_csv(e, csv_path)
    FS.write_json_lines(FS.edits_to_json(e), json_path)
    a = FS.read_edits_csv(spark, csv_path)
    b = parse_edit_json(spark.read.text(json_path))
    return a.unionByName(b)


SAMPLE_ROWS = 20


def _sample_comments_sql(test: str) -> str:
    return with_ctes(f"""
select id, comment from clean where {test} and {hash_bucket_sql('id', 100)} < 10 order by md5(cast(id as varchar)), id
limit {SAMPLE_ROWS}""")


def _sample_comments(rows):
    """A 10 % sample by a hash of the id; of it the first 20 in hash order (the reference's sample to look at)."""
    return rows.filter(hash_bucket(F.col("id"), 100) < 10).select("id", "comment").orderBy(
        F.md5(F.col("id").cast("string")), "id").limit(SAMPLE_ROWS)


@register("sample_comments", _sample_comments_sql("bot"))
def q_sample_comments(spark, sf_dir):
    return _sample_comments(clean_edits(edits(spark, sf_dir)).filter(F.col("bot")))


@register("sample_comments_human", _sample_comments_sql("not bot"))
def q_sample_comments_human(spark, sf_dir):
    return _sample_comments(clean_edits(edits(spark, sf_dir)).filter(~F.col("bot")))
