import os

from pyspark.sql import functions as F

from edgefilter.operators.clean import clean_edits
from edgefilter.operators.scoring import rule_prediction
from edgefilter.sources import files as FS
from edgefilter.sources.tables import edits
from edgefilter.streaming import jobs as J
from tests.conftest import SF001


def _scorer(clean):
    return clean.withColumn("prediction", rule_prediction(1000))


def _write_files(spark, df, path, n):
    FS.edit_json_lines(df).repartition(n).write.mode("overwrite").text(path)


def test_stream_equals_batch_and_survives_restart(spark, tmp_path):
    e = edits(spark, SF001)
    first, second = e.filter("id < 120"), e.filter("id >= 120")
    src = str(tmp_path / "in")
    _write_files(spark, first, src + "/a", 2)
    state = J.BlacklistState(spark, str(tmp_path / "state"))
    ck = str(tmp_path / "ck")
    J.run_filter_score_job(spark, J.file_source(spark, src + "/*"), state, _scorer, ck)
    n_epochs_1 = state.reports().count()
    # new input arrives; the restarted query resumes from its checkpoint
    _write_files(spark, second, src + "/b", 2)
    J.run_filter_score_job(spark, J.file_source(spark, src + "/*"), state, _scorer, ck)
    assert state.reports().count() == n_epochs_1 + 2
    batch = _scorer(clean_edits(e)).filter("prediction >= 0.5 and user is not null") \
        .select("user").distinct()
    got = state.keys().select("user").distinct()
    assert sorted(r.user for r in got.collect()) == sorted(r.user for r in batch.collect())
    # a user lands in the key table only in the first epoch that flags it
    assert state.keys().groupBy("user").count().filter("count > 1").count() == 0


def test_epoch_replay_is_idempotent(spark, tmp_path):
    state = J.BlacklistState(spark, str(tmp_path / "state"), expected_items=10, false_positive_rate=0.01)
    keys = spark.createDataFrame([("u1",), ("u2",)], "user string")
    bf0 = state.filter_before(0)
    state.commit(0, keys, bf0)
    snap1 = sorted(r.pos for r in state.filter_before(1).positions().collect())
    state.commit(0, keys, bf0)                      # replay of epoch 0
    assert sorted(r.pos for r in state.filter_before(1).positions().collect()) == snap1
    assert state.keys().count() == 2
    # growing past n rebuilds from the key table: no key is lost
    many = spark.range(0, 40).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("user"))
    state.commit(1, many, state.filter_before(1))
    bf = state.filter_before(2)
    assert bf.spec.n >= 42
    assert bf.members(state.keys(), "user").count() == 42


def test_sample_job_file_sink(spark, tmp_path):
    e = edits(spark, SF001)
    src = str(tmp_path / "in")
    _write_files(spark, e, src, 3)
    out = str(tmp_path / "out")
    J.run_sample_job(spark, J.file_source(spark, src), out, str(tmp_path / "ck"), 20, records_per_file=10)
    back = FS.read_edits_csv(spark, out)
    from edgefilter.plans.q_sources import user_sample
    assert back.count() == user_sample(e).count()
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) >= back.count() // 10


def test_snapshots_stay_two_and_replay_reads_the_earlier_one(spark, tmp_path):
    state = J.BlacklistState(spark, str(tmp_path / "state"), expected_items=1000, false_positive_rate=0.01)
    for e in range(5):
        keys = spark.createDataFrame([(f"u{e}",)], "user string")
        state.commit(e, keys, state.filter_before(e))
    slots = [d for d in os.listdir(tmp_path / "state" / "bloom") if d.startswith("slot=")]
    assert len(slots) == 2
    assert state.filter_before(5).n_keys == 5
    # replaying epoch 4 must start from the snapshot of epoch 3
    before4 = state.filter_before(4)
    assert before4.n_keys == 4
    probe = spark.createDataFrame([(f"u{i}",) for i in range(4)], "user string")
    assert before4.members(probe, "user").count() == 4


def test_ten_epochs_leave_a_constant_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "COMPACT_EVERY", 4)
    e = edits(spark, SF001)
    src, root = str(tmp_path / "in"), tmp_path / "state"
    _write_files(spark, e, src, 10)
    state = J.BlacklistState(spark, str(root))
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = sum(d.startswith("bloom_members") for d in os.listdir(scratch))
    J.run_filter_score_job(spark, J.file_source(spark, src), state, _scorer, str(tmp_path / "ck"))
    assert sum(d.startswith("bloom_members") for d in os.listdir(scratch)) == before
    for name in ("members", "bloom"):
        assert len([d for d in os.listdir(root / name) if d.startswith("slot=")]) <= 2
    for name in ("keys", "reports"):
        assert len([d for d in os.listdir(root / name) if d.startswith("epoch=")]) <= 5
        assert len([d for d in os.listdir(root / f"{name}_base") if d.startswith("upto=")]) == 1
    assert state.reports().count() == 10 and state.reports().select("epoch").distinct().count() == 10
    batch = _scorer(clean_edits(e)).filter("prediction >= 0.5 and user is not null").select("user").distinct()
    assert sorted(r.user for r in state.keys().collect()) == sorted(r.user for r in batch.collect())


def test_record_sink_writes_json_lines(spark, tmp_path):
    e = edits(spark, SF001)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write_files(spark, e, src, 2)
    records = J.edit_stream(J.file_source(spark, src))
    J.finish(J.record_sink(records, str(tmp_path / "ck"), "text", path=out))
    from edgefilter.streaming.parse import parse_edit_json
    assert parse_edit_json(spark.read.text(out)).count() == e.count()


def test_an_epoch_holds_its_batch_once(spark, tmp_path):
    """Before, the marked rows were cached beside the batch they come from."""
    state = J.BlacklistState(spark, str(tmp_path / "state"))
    held = []

    def scorer(clean):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size() - before)
        return _scorer(clean)

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    process = J.filter_score_update(state, scorer)
    e = edits(spark, SF001)
    process(e, 0)
    process(e, 1)
    assert held == [1, 1]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    seen = {r.user for r in state.keys().collect()}
    reports = {r.epoch: r for r in state.reports().collect()}
    n = e.count()
    assert (reports[0].n_batch, reports[0].n_unseen, reports[0].n_new_keys) == (n, n, len(seen))
    assert reports[1].n_batch == n and reports[1].n_unseen <= n - e.where(F.col("user").isin(sorted(seen))).count()
    assert reports[1].n_new_keys == 0
