import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from edgefilter.operators.clean import clean_edits
from edgefilter.operators.scoring import rule_prediction
from edgefilter.sources import files as FS
from edgefilter.sources.tables import edits
from edgefilter.streaming import jobs as J
from edgefilter.streaming import state_blacklist as SB
from tests.conftest import SF001


def _scorer(clean):
    return clean.withColumn("prediction", rule_prediction(1000))


def _write_files(df, path, n):
    FS.edit_json_lines(df).repartition(n).write.mode("overwrite").text(path)


def test_equals_batch_survives_restart_and_state_is_bounded(spark, tmp_path):
    e = edits(spark, SF001)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    before = spark.conf.get(SB._PROVIDER, None)
    _write_files(e.filter("id < 120"), src + "/a", 2)
    SB.run_state_job(spark, J.file_source(spark, src + "/*"), _scorer, out, ck, expected_items=10_000)
    _write_files(e.filter("id >= 120"), src + "/b", 2)
    SB.run_state_job(spark, J.file_source(spark, src + "/*"), _scorer, out, ck, expected_items=10_000)
    assert spark.conf.get(SB._PROVIDER, None) == before
    batch = _scorer(clean_edits(e)).filter("prediction >= 0.5 and user is not null").select("user").distinct()
    want = sorted(r.user for r in batch.collect())
    assert sorted(r.user for r in SB.blacklist(spark, out).collect()) == want
    told = spark.read.parquet(out).agg(F.sum("n_rows").alias("n")).first()
    assert told.n == e.count()
    state = SB.filter_state(spark, ck)
    size = state.agg(F.sum(F.length("bits")).alias("bytes"), F.sum("n_keys").alias("n")).first()
    assert size.n == len(want)
    assert size.bytes <= SB.n_blocks(10_000, 0.001) * SB.slice_shape(0, 0.001)[0] // 8


def test_known_users_are_dropped_in_later_epochs_and_null_users_never_flagged(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = lambda users: edits(spark, SF001).limit(1).drop("user").crossJoin(
        spark.createDataFrame([(u,) for u in users], "user string"))
    flag_all = lambda clean: clean.withColumn("prediction", F.lit(1.0))
    _write_files(rows(["a", "a", None, "b"]), src + "/a", 1)
    SB.run_state_job(spark, J.file_source(spark, src + "/*"), flag_all, out, ck, expected_items=100)
    _write_files(rows(["a", "c", None]), src + "/b", 1)
    SB.run_state_job(spark, J.file_source(spark, src + "/*"), flag_all, out, ck, expected_items=100)
    got = sorted(((r.user or "", r.n_rows, r.unseen, r.is_new) for r in spark.read.parquet(out).collect()))
    assert got == [("", 1, True, False), ("", 1, True, False), ("a", 1, False, False), ("a", 2, True, True),
                   ("b", 1, True, True), ("c", 1, True, True)]


class _State:
    """Stands in for the engine's group state."""
    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def _keys(rng, n):
    return rng.integers(0, 1 << 60, n), rng.integers(0, 1 << 60, n)


def test_a_block_grows_by_slices_and_keeps_its_rate():
    rng = np.random.default_rng(1)
    p = 0.01
    update, state = SB.block_filter(p), _State()
    capacity = SB.slice_shape(0, p)[1]
    h1, h2 = _keys(rng, 11 * capacity)

    def ask(a, b, flagged):
        frame = pd.DataFrame({"user": [f"u{x}" for x in a], "h1": a, "h2": b, "n_rows": 1, "flagged": flagged})
        return pd.concat(update((0,), iter([frame]), state)).set_index("user").loc[frame["user"]]

    for part in np.array_split(np.arange(len(h1)), 7):
        ask(h1[part], h2[part], True)
    counts = state.get[1]
    assert len(counts) == 4                                          # together 11.7 times the first capacity
    assert all(n <= SB.slice_shape(i, p)[1] for i, n in enumerate(counts))
    assert not ask(h1, h2, False)["unseen"].any()                    # no false negative over four slices
    other = _keys(rng, 20_000)
    assert (~ask(*other, False)["unseen"]).mean() < p


def test_rows_of_a_hot_user_collapse_before_the_shuffle(spark):
    scored = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(
        F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("user"), F.lit(0.0).alias("prediction"))
    rows = SB.user_rows(scored.coalesce(1), 4, 0.5)
    assert rows.agg(F.sum("n_rows")).first()[0] == 20_000
    assert rows.where("user = 'hot'").count() <= 3                   # one for each Arrow batch of 10,000
