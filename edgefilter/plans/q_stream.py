"""Streaming queries. Each runs a
Structured Streaming query over files with ``availableNow`` and returns
what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket_sql
from edgefilter.operators import linear as LIN
from edgefilter.operators import model as M
from edgefilter.operators.scoring import rule_prediction, rule_prediction_sql
from edgefilter.plans.q_model import model_sql, train_test
from edgefilter.plans.registry import register
from edgefilter.schemas import EDIT_COLUMNS
from edgefilter.session import scratch_path
from edgefilter.sources import files as FS
from edgefilter.sources.tables import EDITS_SQL, edits, table, with_ctes
from edgefilter.streaming import event_log as EL
from edgefilter.streaming import jobs as J
from edgefilter.streaming import state_blacklist as SB

#: Files taken in one epoch.
FILES_PER_EPOCH = 16
SAMPLE_PERCENT = 20
_COLS = ", ".join(f'"{c}"' for c in EDIT_COLUMNS)


def stream_input(spark, sf_dir) -> str:
    """JSON lines of all edits plus conversation text as noise, in as many files as their tasks write."""
    conv = table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    lines = FS.edit_json_lines(edits(spark, sf_dir), conv)
    path = scratch_path(spark, "stream_in")
    lines.write.mode("overwrite").option("maxRecordsPerFile", FS.DEFAULT_RECORDS_PER_FILE).text(path)
    return path


@register("stream_parse", f"select {_COLS} from ({EDITS_SQL})")
def q_stream_parse(spark, sf_dir):
    src = stream_input(spark, sf_dir)
    out, ck = scratch_path(spark, "stream_parsed"), scratch_path(spark, "ck_parse")
    q = (J.edit_stream(J.file_source(spark, src, FILES_PER_EPOCH)).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    J.finish(q)
    return spark.read.parquet(out)


@register("stream_sample", f"""
select {_COLS} from ({EDITS_SQL}) where {hash_bucket_sql('"user"', 100)} < {SAMPLE_PERCENT}""")
def q_stream_sample(spark, sf_dir):
    src = stream_input(spark, sf_dir)
    out, ck = scratch_path(spark, "stream_sample"), scratch_path(spark, "ck_sample")
    J.run_sample_job(spark, J.file_source(spark, src, FILES_PER_EPOCH), out, ck, SAMPLE_PERCENT)
    return FS.read_edits_csv(spark, out)


def rule_scorer(clean):
    return clean.withColumn("prediction", rule_prediction())


@register("stream_blacklist_growth", with_ctes(f"""
select distinct "user" from clean where {rule_prediction_sql()} >= 0.5 and "user" is not null"""))
def q_stream_blacklist_growth(spark, sf_dir):
    src = stream_input(spark, sf_dir)
    state = J.BlacklistState(spark, scratch_path(spark, "blacklist"))
    J.run_filter_score_job(spark, J.file_source(spark, src, FILES_PER_EPOCH), state, rule_scorer,
                           scratch_path(spark, "ck_blacklist"))
    return state.keys().select("user").distinct()


_FLAGGED_SQL = f"""select distinct "user" from clean where {rule_prediction_sql()} >= 0.5 and "user" is not null"""


def state_job(spark, sf_dir) -> tuple[str, str]:
    """(verdicts, checkpoint) of the job that keeps its filter in the state store, after all edits."""
    out, ck = scratch_path(spark, "state_verdicts"), scratch_path(spark, "ck_state")
    SB.run_state_job(spark, J.file_source(spark, stream_input(spark, sf_dir), FILES_PER_EPOCH), rule_scorer, out, ck)
    return out, ck


@register("stream_state_blacklist", with_ctes(_FLAGGED_SQL))
def q_stream_state_blacklist(spark, sf_dir):
    """Users flagged by the job whose Bloom filter lies in the state store."""
    out, _ = state_job(spark, sf_dir)
    return SB.blacklist(spark, out)


@register("stream_state_filter", with_ctes(SB.first_slice_sql(_FLAGGED_SQL)))
def q_stream_state_filter(spark, sf_dir):
    """Keys and set bits of every block of that filter, read back from the state store."""
    _, ck = state_job(spark, sf_dir)
    return SB.filter_state(spark, ck).groupBy("block").agg(
        F.sum("n_keys").cast("long").alias("n_keys"), F.sum(F.bitmap_count("bits")).cast("long").alias("bits_set"))


@register("stream_filter_score", f"""
select cast(sum(n_lines) as bigint) as n_batch, true as unseen_within_batch, true as new_keys_within_unseen
from (select count(*) as n_lines from ({EDITS_SQL}))""")
def q_stream_filter_score(spark, sf_dir):
    """The stream job with the trained classifier; totals of the per-epoch report.

    How many senders a fitted model flags has no SQL equivalent; that every
    edit passed through an epoch, and that unseen and new rows stay within
    their batch, has.
    """
    train, _ = train_test(spark, sf_dir)
    model = M.fit(train)
    src = stream_input(spark, sf_dir)
    state = J.BlacklistState(spark, scratch_path(spark, "blacklist_ml"))
    J.run_filter_score_job(spark, J.file_source(spark, src, FILES_PER_EPOCH), state, model.transform,
                           scratch_path(spark, "ck_blacklist_ml"))
    return state.reports().agg(
        F.sum("n_batch").cast("bigint").alias("n_batch"),
        F.min(F.col("n_unseen") <= F.col("n_batch")).alias("unseen_within_batch"),
        F.min(F.col("n_new_keys") <= F.col("n_unseen")).alias("new_keys_within_unseen"))


@register("stream_model_blacklist", model_sql(f"""
select distinct r."user" from rows r join scored using (id) where p > {M.THRESHOLD} and r."user" is not null""", "rows"))
def q_stream_model_blacklist(spark, sf_dir):
    """Users on the blacklist after the stream job with the fitted classifier has seen all edits."""
    train, _ = train_test(spark, sf_dir)
    model = LIN.fit(train)
    state = J.BlacklistState(spark, scratch_path(spark, "blacklist_model"))
    J.run_filter_score_job(spark, J.file_source(spark, stream_input(spark, sf_dir), FILES_PER_EPOCH), state,
                           lambda clean: LIN.score(model, clean, ["user"]), scratch_path(spark, "ck_blacklist_model"))
    return state.keys().select("user").distinct()


STREAM_SINCE = "2024-01-03 05:30:00"


@register("stream_since", f"select event_id, user_id, event_type, value from events where ts >= timestamp '{STREAM_SINCE}'")
def q_stream_since(spark, sf_dir):
    """A stream over the event log that starts at a time."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    log, out, ck = (scratch_path(spark, n) for n in ("event_log", "stream_since", "ck_since"))
    EL.append_events(events, log)
    later = EL.event_source(spark, log, events.schema, STREAM_SINCE).drop("ts")
    J.finish(later.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    return spark.read.schema(later.schema).parquet(out)
