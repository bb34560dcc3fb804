"""The event source: start time, growth of the log, epochs that read the same rows again."""

import datetime as dt

import pytest

from edgefilter.streaming import event_log as EL
from edgefilter.streaming.jobs import finish

SCHEMA = "event_id long, ts timestamp, user string"


def events(spark, ids):
    start = dt.datetime(2024, 1, 3, 4, 0, 0)
    return spark.createDataFrame([(i, start + dt.timedelta(minutes=7 * i), f"u{i % 5}") for i in ids], SCHEMA)


def run(source, out, ck):
    finish(source.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
           .trigger(availableNow=True).start())


def ids(df):
    return sorted(r.event_id for r in df.collect())


@pytest.mark.parametrize("since", [None, "2024-01-03 05:30:00", "2024-01-04 00:00:00"])
def test_stream_starts_at_a_time_and_epochs_replay(spark, tmp_path, since):
    log, out, ck = (str(tmp_path / n) for n in ("log", "out", "ck"))
    EL.append_events(events(spark, range(60)), log)
    first = events(spark, range(60))
    run(EL.event_source(spark, log, first.schema, since, files_per_epoch=2), out, ck)
    want = [r.event_id for r in first.collect() if since is None or str(r.ts) >= since]
    read = spark.read.schema(first.schema).parquet(out)
    assert ids(read) == want
    # later events come with the next run, each once
    EL.append_events(events(spark, range(60, 70)), log)
    run(EL.event_source(spark, log, first.schema, since, files_per_epoch=2), out, ck)
    more = [r.event_id for r in events(spark, range(70)).collect() if since is None or str(r.ts) >= since]
    assert ids(spark.read.schema(first.schema).parquet(out)) == more
    # every epoch again from the noted files: the same rows, each in one epoch
    epochs = [EL.replay_epoch(spark, log, first.schema, ck, e, since) for e in range(8)]
    again = [ids(e) for e in epochs]
    assert sorted(i for e in again for i in e) == more
    assert [ids(EL.replay_epoch(spark, log, first.schema, ck, e, since)) for e in range(8)] == again


def test_start_time_prunes_folders(spark, tmp_path):
    log = str(tmp_path / "log")
    EL.append_events(events(spark, range(60)), log)
    seen = []
    q = EL.event_source(spark, log, events(spark, []).schema, "2024-01-03 09:00:00").writeStream.foreachBatch(
        lambda df, e: seen.append((df.count(), df.inputFiles()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(
        availableNow=True).start()
    finish(q)
    assert sum(n for n, _ in seen) == sum(7 * i >= 5 * 60 for i in range(60))
    plan = EL.event_source(spark, log, events(spark, []).schema, "2024-01-03 09:00:00")._jdf.queryExecution().analyzed().toString()
    assert "hour" in plan


def test_events_without_a_time_are_left_out(spark, tmp_path):
    log = str(tmp_path / "log")
    EL.append_events(spark.createDataFrame([(1, None, "a"), (2, dt.datetime(2024, 1, 1), "b")], SCHEMA), log, files_per_hour=3)
    assert ids(spark.read.parquet(log)) == [2]
