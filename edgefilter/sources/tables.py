"""Readers for the provided parquet tables and the derived ``edits`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.session import warehouse_root

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; projections and filters applied later reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit records derived from documents, events and labels.

    Columns follow the edit record layout (``schemas.EDIT_SCHEMA``); the
    timestamp is the producer's ``yyyy-MM-dd HH:mm:ss`` string. Nulls in
    user, comment, minor and bot are part of the fixture on purpose.
    """
    return edits_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "events"),
                      table(spark, sf_dir, "labels"))


# Join keys of the three inputs of the edits view.
EDIT_INPUT_KEYS = (("documents", "doc_id"), ("events", "event_id"), ("labels", "doc_id"))


def bucket_edit_inputs(spark: SparkSession, sf_dir: str, database: str = "edgefilter",
                       buckets: int = 64) -> None:
    """Write documents, events and labels once as tables bucketed and sorted
    on the join id (under ``spark.sql.warehouse.dir``, which on a cluster
    must be shared storage). Every later edits view over them joins without
    shuffling either side."""
    warehouse_root(spark)            # raises on a cluster without a shared one
    spark.sql(f"create database if not exists {database}")
    for name, key in EDIT_INPUT_KEYS:
        (table(spark, sf_dir, name).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
         .saveAsTable(f"{database}.{name}"))


def edits_bucketed(spark: SparkSession, database: str = "edgefilter") -> DataFrame:
    """The edits view over the bucketed tables of :func:`bucket_edit_inputs`."""
    return edits_from(*(spark.table(f"{database}.{name}") for name, _ in EDIT_INPUT_KEYS))


def edits_from(documents: DataFrame, events: DataFrame, labels: DataFrame) -> DataFrame:
    d = documents.select("doc_id", "text", "lang", "source")
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    lab = labels.select("doc_id", "toxic")
    joined = (d.join(e, d.doc_id == e.event_id)
               .join(lab, "doc_id", "left"))
    doc = F.col("doc_id")
    return joined.select(
        doc.alias("id"),
        F.concat(F.lit("doc "), doc.cast("string"), F.lit(", "), F.col("source")).alias("title"),
        F.when(doc % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("user"),
        (F.col("toxic") == 1).alias("bot"),
        (F.floor(F.col("value")).cast("int") - 50).alias("length"),
        F.concat(F.col("lang"), F.lit("wiki")).alias("wiki"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(doc % 31 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("event_type").isin("click", "view")).alias("minor"),
        F.when(doc % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("comment"),
    )


# The same view as DuckDB text, used by the oracle statements.
EDITS_SQL = """
select d.doc_id as id,
       concat('doc ', cast(d.doc_id as varchar), ', ', d.source) as title,
       case when d.doc_id % 29 = 0 then null
            else concat('user', cast(e.user_id as varchar)) end as "user",
       l.toxic = 1 as bot,
       cast(floor(e.value) as int) - 50 as length,
       concat(d.lang, 'wiki') as wiki,
       strftime(e.ts, '%Y-%m-%d %H:%M:%S') as "timestamp",
       case when d.doc_id % 31 = 0 then null
            else e.event_type in ('click', 'view') end as minor,
       case when d.doc_id % 17 = 0 then null else d.text end as comment
from documents d
join events e on e.event_id = d.doc_id
left join labels l on l.doc_id = d.doc_id
"""

# clean_edits() as DuckDB text over the view above.
CLEAN_SQL = """
select id, title, "user", coalesce(bot, false) as bot,
       abs(coalesce(length, 0)) as length, wiki,
       try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp",
       cast(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') as date) as date,
       hour(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S')) as hour,
       coalesce(minor, false) as minor,
       coalesce(comment, '') as comment,
       length(coalesce(comment, '')) as comment_length,
       cast(coalesce(bot, false) as double) as label,
       bot is not null as labelled
from edits
"""


# clean_edits(fill_minor=False): the exploratory stage keeps minor nullable.
EDA_SQL = CLEAN_SQL.replace("coalesce(minor, false) as minor", "minor")


def with_ctes(body: str, clean: bool = True, extra: list[tuple[str, str]] | None = None,
              materialized: bool = False) -> str:
    """Prefix an oracle statement with the ``edits``, ``clean`` and ``eda``
    CTEs, followed by ``extra`` (name, body) CTEs in order (worked out once each if ``materialized``)."""
    ctes = [f"edits as ({EDITS_SQL})"]
    if clean:
        ctes.append(f"clean as ({CLEAN_SQL})")
        ctes.append(f"eda as ({EDA_SQL})")
    for name, sql in extra or []:
        ctes.append(f"{name} as {'materialized ' * materialized}({sql})")
    return "with " + ",\n".join(ctes) + "\n" + body
