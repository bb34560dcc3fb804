"""File sources and sinks: edit CSV, listings CSV, page-view JSON, change-event JSON.

Writers set ``maxRecordsPerFile`` instead of ``coalesce(1)`` so output stays
parallel and file sizes stay bounded; readers always pass an explicit schema
(no inference pass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.schemas import EDIT_COLUMNS, EDIT_SCHEMA, LISTING_SCHEMA, PAGEVIEW_SCHEMA, RAW_CHANGE_SCHEMA
from edgefilter.sources.quoted_csv import read_quoted_csv

# RFC 4180 quoting: a quote inside a field is doubled; records may span lines.
CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
DEFAULT_RECORDS_PER_FILE = 1_000_000


# -- edit records (CSV, no header) --------------------------------------------

def write_edits_csv(df: DataFrame, path: str, mode: str = "append",
                    records_per_file: int = DEFAULT_RECORDS_PER_FILE) -> None:
    """Append edit records as header-less CSV, exactly the nine schema columns."""
    (df.select(*EDIT_COLUMNS).write.mode(mode)
       .options(**CSV_OPTIONS).option("header", "false")
       .option("maxRecordsPerFile", records_per_file).csv(path))


def read_edits_csv(spark: SparkSession, path: str) -> DataFrame:
    """Edit records from header-less CSV files (a directory or a glob), a task for each range of a file.

    PERMISSIVE: a row with an extra trailing column (files written with a
    tenth ``user_hash`` field) keeps its first nine; a malformed field
    becomes NULL.
    """
    return read_quoted_csv(spark, path, EDIT_SCHEMA)


# -- listings (CSV with header, gzip) -------------------------------------------

def write_listings_csv(df: DataFrame, path: str, records_per_file: int = DEFAULT_RECORDS_PER_FILE) -> None:
    (df.write.mode("overwrite").options(**CSV_OPTIONS).option("header", "true")
       .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).csv(path))


def read_listings_csv(spark: SparkSession, path: str, schema=LISTING_SCHEMA) -> DataFrame:
    """Listings CSV with header and multi-line quoted fields.

    Plain files are split at records; a gzip file cannot be split, so it is one
    task, and ``write_listings_csv`` bounds the records of a file.
    """
    return read_quoted_csv(spark, path, schema, header=True)


def listings_from_parts(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                       F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"))


# -- page-view top list (nested JSON) ---------------------------------------------

# Article title derived from a page URL: capitalised host label, language
# path segment and last path segment joined by underscores.
ARTICLE_HOST_RE = r"^[a-z]+://(?:m\.)?([^./]+)"
ARTICLE_LANG_RE = r"^[a-z]+://[^/]+/([^/?#]+)/"
ARTICLE_PAGE_RE = r"/([^/?#]+)(?:[?#].*)?$"
ITEM_SIZE = 100


def article_titles(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    host = F.regexp_extract(url, ARTICLE_HOST_RE, 1)
    title = F.concat(F.upper(F.substr(host, F.lit(1), F.lit(1))), F.substr(host, F.lit(2)), F.lit("_"),
                     F.regexp_extract(url, ARTICLE_LANG_RE, 1), F.lit("_"),
                     F.regexp_extract(url, ARTICLE_PAGE_RE, 1))
    return pages.select("page_id", title.alias("article"))


def write_pageviews_json(pages: DataFrame, path: str) -> None:
    """Page-view lists as JSON lines: ``{"items": [{"articles": [...]}]}``,
    one line per block of ``ITEM_SIZE`` page ids (bounded groups)."""
    t = article_titles(pages)
    block = F.floor(F.col("page_id") / ITEM_SIZE)
    lines = (t.groupBy(block.alias("blk"))
              .agg(F.collect_list(F.struct(F.col("article"))).alias("articles"))
              .select(F.array(F.struct(F.col("articles"))).alias("items")))
    lines.write.mode("overwrite").json(path)


def read_pageviews(spark: SparkSession, path: str) -> DataFrame:
    """Flatten items[].articles[].article to one ``article`` column."""
    raw = spark.read.schema(PAGEVIEW_SCHEMA).json(path)
    items = raw.select(F.explode("items").alias("item"))
    arts = items.select(F.explode("item.articles").alias("a"))
    return arts.select(F.col("a.article").alias("article"))


def normalize_article_names(articles: DataFrame) -> DataFrame:
    """Lower-case, ``_`` -> space, drop empty, one row per name."""
    name = F.lower(F.replace(F.col("article"), F.lit("_"), F.lit(" ")))
    return articles.select(name.alias("name")).filter(F.col("name") != "").dropDuplicates(["name"])


# -- JSON records ---------------------------------------------------------------

def edits_to_json(df: DataFrame) -> DataFrame:
    """One JSON object per edit (``value``), nulls written out as ``null``."""
    return df.select("id", F.to_json(F.struct(*EDIT_COLUMNS), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str, records_per_file: int = DEFAULT_RECORDS_PER_FILE) -> None:
    df.select("value").write.mode("overwrite").option("maxRecordsPerFile", records_per_file).text(path)


def read_raw_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_CHANGE_SCHEMA).json(path)


def raw_changes_from_tables(documents: DataFrame, events: DataFrame) -> DataFrame:
    """Feed-shaped change events derived from documents and events.

    Languages give the server, event types the change type, the value the
    new length (old length 50, missing for every 13th event); user names
    of every 7th event carry a comma the normaliser must strip.
    """
    d = documents.select("doc_id", "text", "lang", "source")
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    j = d.join(e, d.doc_id == e.event_id)
    typ = (F.when(F.col("event_type").isin("click", "view", "purchase"), F.lit("edit"))
            .when(F.col("event_type") == "signup", F.lit("new")).otherwise(F.lit("log")))
    user = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("user,"), F.col("user_id").cast("string"))) \
            .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string")))
    return j.select(
        F.col("doc_id").alias("id"), typ.alias("type"),
        F.concat(F.col("lang"), F.lit(".wikipedia.org")).alias("server_name"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(", "), F.col("source")).alias("title"),
        user.alias("user"), (F.col("event_type") == "error").alias("bot"),
        F.concat(F.col("lang"), F.lit("wiki")).alias("wiki"),
        F.col("event_type").isin("click", "view").alias("minor"),
        F.col("text").alias("comment"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.struct(F.floor(F.col("value")).cast("int").alias("new"),
                 F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("int")).otherwise(F.lit(50)).alias("old"))
         .alias("length"))


def edit_json_lines(edits_df: DataFrame, garbage: DataFrame | None = None) -> DataFrame:
    """Stream messages for the edits: mostly single JSON objects, pairs of
    consecutive ids as two-element arrays (every third pair), plus any
    ``garbage`` text lines (which must parse to no record)."""
    rec = F.struct(*EDIT_COLUMNS)
    opts = {"ignoreNullFields": "false"}
    pair = F.floor(F.col("id") / 2)
    keyed = edits_df.withColumn("_pair", pair)
    singles = keyed.filter(F.col("_pair") % 3 != 0).select(F.to_json(rec, opts).alias("value"))
    arrays = (keyed.filter(F.col("_pair") % 3 == 0).groupBy("_pair")
                   .agg(F.to_json(F.array_sort(F.collect_list(rec)), opts).alias("value"))
                   .select("value"))
    out = singles.unionByName(arrays)
    if garbage is not None:
        out = out.unionByName(garbage.select(F.col("value").cast("string").alias("value")))
    return out
