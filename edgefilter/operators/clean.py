"""Record normalisation and the one cleaning step shared by every path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgefilter.schemas import EDIT_COLUMNS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
_WALL_CLOCK = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"

# The feed filter of the change-event producer.
KEPT_SERVERS = ("en.wikipedia.org", "de.wikipedia.org")
KEPT_TYPE = "edit"
# Fields without which an event is skipped.
REQUIRED = ("id", "title", "user", "bot", "length.new", "length.old", "wiki", "timestamp", "minor", "comment")


def kept_change_events(raw: DataFrame, since: str | None = None) -> DataFrame:
    """Edits of the two wikis, with ``complete``: whether no required field is missing."""
    out = raw.filter(F.col("server_name").isin(*KEPT_SERVERS) & (F.col("type") == KEPT_TYPE))
    if since is not None:
        out = out.filter(F.col("timestamp") >= F.unix_timestamp(F.lit(since).cast("timestamp")))
    complete = F.lit(True)
    for name in REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return out.withColumn("complete", complete)


def change_event_skips(raw: DataFrame, since: str | None = None) -> DataFrame:
    """How many of the feed's edits are kept and how many skipped as malformed; one aggregate."""
    return kept_change_events(raw, since).agg(F.count_if("complete").alias("n_kept"),
                                              F.count_if(~F.col("complete")).alias("n_skipped"))


def normalize_change_events(raw: DataFrame, since: str | None = None) -> DataFrame:
    """Raw change events -> edit records; events that lack a required field are skipped.

    Keeps edits of the two wikis, computes ``length = new - old``, strips
    commas from the free-text fields and renders the epoch-second timestamp
    as a ``yyyy-MM-dd HH:mm:ss`` string in the session time zone (UTC here,
    where the original producer used its process-local zone). ``since``
    restricts to events at or after a ``yyyy-MM-dd[ HH:mm:ss]`` instant.
    """
    out = kept_change_events(raw, since).filter("complete")
    strip = lambda c: F.replace(F.col(c), F.lit(","), F.lit(""))
    return out.select(
        F.col("id"),
        strip("title").alias("title"),
        strip("user").alias("user"),
        F.col("bot"),
        F.try_subtract(F.col("length.new"), F.col("length.old")).cast("int").alias("length"),
        strip("wiki").alias("wiki"),
        F.date_format(F.timestamp_seconds(F.col("timestamp")), TIMESTAMP_FORMAT).alias("timestamp"),
        F.col("minor"),
        strip("comment").alias("comment"),
    )


def parse_wall_clock(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> timestamp without zone; malformed -> NULL.

    Spark 4 parses with ANSI semantics, where one bad string would fail the
    whole task (and a stream epoch with it). The shape is checked first and
    the value built with ``try_make_timestamp_ntz``, so an impossible date
    is NULL too, and no session time zone is involved.
    """
    part = lambda i: F.regexp_extract(c, _WALL_CLOCK, i).cast("int")
    return F.when(c.rlike(_WALL_CLOCK),
                  F.try_make_timestamp_ntz(part(1), part(2), part(3), part(4), part(5), part(6)))


def clean_edits(df: DataFrame, abs_length: bool = True, fill_minor: bool = True) -> DataFrame:
    """Typed, null-filled edit rows ready for profiling and for the model.

    One function for the offline, the extended and the stream path:
    timestamp string -> timestamp (wall clock, no zone), ``date`` and ``hour``
    derived, nulls filled (length 0, bot/minor False, comment ''),
    ``comment_length`` and the double ``label``. ``labelled`` keeps whether
    the ground truth was present before the fill.

    ``fill_minor=False`` is the exploratory stage, where ``minor`` is still
    nullable: counts by minor keep a NULL group and correlations skip the
    rows without it. The model stage fills it (the assembler rejects NULL).
    """
    ts = parse_wall_clock(F.col("timestamp"))
    length = F.coalesce(F.col("length"), F.lit(0))
    comment = F.coalesce(F.col("comment"), F.lit(""))
    bot = F.coalesce(F.col("bot"), F.lit(False))
    extra = [c for c in df.columns if c not in EDIT_COLUMNS]
    return df.select(
        "id", "title", "user",
        bot.alias("bot"),
        (F.abs(length) if abs_length else length).alias("length"),
        "wiki",
        ts.alias("timestamp"),
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        (F.coalesce(F.col("minor"), F.lit(False)) if fill_minor else F.col("minor")).alias("minor"),
        comment.alias("comment"),
        F.length(comment).alias("comment_length"),
        bot.cast("double").alias("label"),
        F.col("bot").isNotNull().alias("labelled"),
        *extra,
    )


def bot_split(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bot rows, human rows) of cleaned edits; both stay native filters."""
    return clean.filter(F.col("bot")), clean.filter(~F.col("bot"))
