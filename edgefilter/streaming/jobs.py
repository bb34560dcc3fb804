"""Structured Streaming jobs: sources, user-sampled file sink, and the
filter -> score -> blacklist job.

Blacklist state lives in tables under one root, written once per epoch:

* ``keys/epoch=E``      distinct users flagged in epoch E
* ``keys_base/upto=E``  the keys of all epochs before E, once compacted
* ``bloom/slot=0|1``    the latest two snapshots of the bit table, each with
                        its epoch and spec
* ``reports/epoch=E``   per-epoch counts (``reports_base/upto=E`` likewise)
* ``members/slot=0|1``  the batch's users that the filter may hold

Each epoch reads the latest snapshot of an *earlier* epoch and writes its
own into the other slot, overwriting only its own partitions. Replaying an
epoch after a failure therefore reads the same snapshot and rewrites the
same data (idempotent), so blacklist and offsets cannot drift apart. The
overwritten slot held a snapshot no epoch can read again, and the listing
stays at two directories however long the stream runs. Every
``COMPACT_EVERY`` epochs the keys and reports of settled epochs are written
as one base table and their folders removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket
from edgefilter.operators.bloom import (
    DEFAULT_EXPECTED_ITEMS,
    DEFAULT_FALSE_POSITIVE_RATE,
    BloomFilter,
    BloomSpec,
    empty_table,
)
from edgefilter.operators.clean import clean_edits
from edgefilter.schemas import EDIT_COLUMNS
from edgefilter.session import remove_path
from edgefilter.sources.files import CSV_OPTIONS, DEFAULT_RECORDS_PER_FILE, edits_to_json
from edgefilter.streaming.parse import parse_edit_json

Scorer = Callable[[DataFrame], DataFrame]
COMPACT_EVERY = 64
KEYS_SCHEMA = "user string, epoch long"
REPORTS_SCHEMA = "n_batch long, n_unseen long, n_new_keys long, epoch long"


# -- sources ---------------------------------------------------------------------

def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Text lines from files landing in ``path`` (one epoch per file by default)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str = "wikipedia-edits",
                 since_ms: int | None = None) -> DataFrame:
    """Kafka topic as text values, from the start or from ``since_ms`` (epoch milliseconds).

    Needs the Kafka connector on the classpath; not exercised here.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("failOnDataLoss", "false"))
    r = r.option("startingOffsets", "earliest") if since_ms is None else r.option(
        "startingTimestamp", str(since_ms)).option("startingOffsetsByTimestampStrategy", "latest")
    raw = r.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def socket_source(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Line socket source (testing only in Spark; not fault tolerant)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def edit_stream(lines: DataFrame) -> DataFrame:
    return parse_edit_json(lines)


# -- sampling job ---------------------------------------------------------------------

def run_sample_job(spark: SparkSession, lines: DataFrame, out_path: str, checkpoint: str,
                   percent: int = 20, records_per_file: int = DEFAULT_RECORDS_PER_FILE,
                   timeout_s: int | None = None) -> None:
    """Keep all edits of ~percent % of users; append them as CSV files.

    The file sink is exactly-once through its metadata log, files are
    bounded by ``records_per_file``; with ``availableNow`` the query stops
    once the input present at start is processed.
    """
    sampled = edit_stream(lines).filter(hash_bucket(F.col("user"), 100) < percent).select(*EDIT_COLUMNS)
    q = (sampled.writeStream.format("csv").options(**CSV_OPTIONS).option("header", "false")
         .option("maxRecordsPerFile", records_per_file)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    finish(q, timeout_s)


def record_sink(records: DataFrame, checkpoint: str, fmt: str = "text", **options):
    """Start a stream that writes edit records as JSON lines (``value``) to ``fmt``: files, or Kafka by its options."""
    return (edits_to_json(records).select("value").writeStream.format(fmt).options(**options)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def finish(q, timeout_s: int | None = None) -> None:
    """Wait until the query has taken all its input; a time limit only if the caller gives one."""
    done = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if done is False:
        q.stop()
        raise TimeoutError(f"stream query {q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


# -- blacklist state ---------------------------------------------------------------------

class BlacklistState:
    """Per-epoch key table and Bloom snapshots under ``root``."""

    def __init__(self, spark: SparkSession, root: str,
                 expected_items: int = DEFAULT_EXPECTED_ITEMS,
                 false_positive_rate: float = DEFAULT_FALSE_POSITIVE_RATE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.default_spec = BloomSpec(expected_items, false_positive_rate)
        self._read_slot: dict[int, int] = {}

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except Exception as exc:  # noqa: BLE001 - nothing written yet
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) or "UNABLE_TO_INFER" in str(exc):
                return None
            raise

    def keys(self, before: int | None = None) -> DataFrame:
        k = self._all("keys", KEYS_SCHEMA)
        return k if before is None else k.filter(F.col("epoch") < before)

    def _base(self, name: str) -> tuple[DataFrame | None, int]:
        """The latest compacted table and the epoch it goes up to."""
        base = self._read(f"{name}_base")
        upto = None if base is None else base.agg(F.max("upto")).first()[0]
        return (None, -1) if upto is None else (base.filter(F.col("upto") == upto).drop("upto"), int(upto))

    def _all(self, name: str, schema: str) -> DataFrame:
        base, upto = self._base(name)
        new = self._read(name)
        columns = [f.split()[0] for f in schema.split(", ")]
        out = empty_table(self.spark, schema)
        for part in (base, None if new is None else new.filter(F.col("epoch") >= upto)):
            if part is not None:
                out = out.unionByName(part.select(*(F.col(c).cast(out.schema[c].dataType) for c in columns)))
        return out

    def compact(self, epoch: int) -> None:
        """One base table for the epochs before ``epoch``, which no replay can reach; their folders go.

        The base is written whole before anything is removed, and readers skip
        the epochs it covers, so a failure in between loses and doubles nothing.
        """
        for name, schema in (("keys", KEYS_SCHEMA), ("reports", REPORTS_SCHEMA)):
            _, had = self._base(name)
            if self._read(name) is None:
                continue
            rows = self._all(name, schema).filter(F.col("epoch") < epoch)
            if rows.isEmpty():
                continue
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}_base/upto={epoch}")
            for e in range(max(0, had), epoch):
                remove_path(self.spark, f"{self.root}/{name}/epoch={e}")
            if had >= 0:
                remove_path(self.spark, f"{self.root}/{name}_base/upto={had}")

    def _latest_before(self, epoch: int):
        """(snapshot rows, spec row) of the latest epoch before ``epoch``; one job."""
        snaps = self._read("bloom")
        if snaps is None:
            return None, None
        prior = snaps.filter(F.col("epoch") < epoch)
        meta = prior.agg(F.max_by(F.struct("slot", "epoch", "expected_items", "false_positive_rate",
                                           "n_keys"), F.col("epoch")).alias("m")).first()["m"]
        if meta is None:
            return None, None
        return prior.filter((F.col("slot") == meta["slot"]) & (F.col("epoch") == meta["epoch"])), meta

    def filter_before(self, epoch: int) -> BloomFilter:
        """The filter as of the end of the latest epoch before ``epoch``."""
        snap, meta = self._latest_before(epoch)
        if snap is None:
            self._read_slot[epoch] = 1                    # first snapshot goes to slot 0
            return BloomFilter.empty(self.spark, self.default_spec)
        self._read_slot[epoch] = int(meta["slot"])
        spec = BloomSpec(int(meta["expected_items"]), float(meta["false_positive_rate"]))
        return BloomFilter(spec, snap.select("bucket", "bits"), int(meta["n_keys"]))

    def commit(self, epoch: int, new_keys: DataFrame, before: BloomFilter) -> int:
        """Write epoch's keys and the updated snapshot; returns the new key count.

        Keys of different epochs are disjoint (a flagged user is in every
        later filter, which has no false negatives), so the running key count
        is carried in the snapshot instead of re-counting the key table.
        """
        new_keys = new_keys.select("user").filter(F.col("user").isNotNull()).distinct()
        new_keys.write.mode("overwrite").parquet(f"{self.root}/keys/epoch={epoch}")
        written = self.spark.read.parquet(f"{self.root}/keys/epoch={epoch}")
        n_new = written.count()
        if n_new == 0:
            return 0
        total = (before.n_keys or 0) + n_new
        spec = before.spec
        if total > spec.n:
            # Grow: rebuild from the key table (source of truth) at >= 2n.
            spec = spec.grown(total)
            bf = BloomFilter.build(self.keys(before=epoch + 1), "user", spec)
        else:
            bf = before.add(written, "user")
        snap = bf.bits.select("bucket", "bits",
                              F.lit(epoch).cast("bigint").alias("epoch"),
                              F.lit(spec.expected_items).cast("bigint").alias("expected_items"),
                              F.lit(spec.false_positive_rate).alias("false_positive_rate"),
                              F.lit(total).cast("bigint").alias("n_keys"))
        if epoch not in self._read_slot:
            self.filter_before(epoch)
        target = 1 - self._read_slot[epoch]
        self._read_slot = {epoch: self._read_slot[epoch]}
        # the new bits are derived from the snapshot in the read slot; the
        # write goes to the other one, so no table is read and overwritten
        # by the same job
        snap.write.mode("overwrite").parquet(f"{self.root}/bloom/slot={target}")
        return n_new

    def report(self, epoch: int, n_batch: int, n_unseen: int, n_new: int) -> None:
        row = {"epoch": epoch, "n_batch": n_batch, "n_unseen": n_unseen, "n_new_keys": n_new}
        (self.spark.range(0, 1, 1, 1).select(*[F.lit(v).cast("long").alias(k) for k, v in row.items()])
             .write.mode("overwrite").parquet(f"{self.root}/reports/epoch={epoch}"))

    def reports(self) -> DataFrame:
        return self._all("reports", REPORTS_SCHEMA)


def filter_score_update(state: BlacklistState, scorer: Scorer, threshold: float = 0.5):
    """foreachBatch function: drop known senders, score the rest, grow the list."""

    def process(batch: DataFrame, epoch_id: int) -> None:
        if epoch_id and epoch_id % COMPACT_EVERY == 0:
            state.compact(epoch_id - 1)
        bf = state.filter_before(epoch_id)
        # The source is parsed once: for the probe, the counts and the rows to score. The marked rows are not held
        # as well: the counts read the senders only, and scoring is the one pass over the texts.
        batch = batch.persist()
        marked = bf.mark(batch, "user", "_seen", f"{state.root}/members/slot={epoch_id % 2}")
        try:
            counts = marked.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_seen")).alias("u")).first()
            n_batch, n_unseen = int(counts["n"]), int(counts["u"])
            unseen = marked.filter(~F.col("_seen")).drop("_seen")
            if n_unseen == 0:
                state.commit(epoch_id, unseen.select("user"), bf)
                state.report(epoch_id, n_batch, 0, 0)
                return
            scored = scorer(clean_edits(unseen))
            bots = scored.filter(F.col("prediction") >= threshold).select("user")
            n_new = state.commit(epoch_id, bots, bf)
            state.report(epoch_id, n_batch, n_unseen, n_new)
        finally:
            batch.unpersist()

    return process


def run_filter_score_job(spark: SparkSession, lines: DataFrame, state: BlacklistState,
                         scorer: Scorer, checkpoint: str, timeout_s: int | None = None) -> None:
    q = (edit_stream(lines).writeStream.foreachBatch(filter_score_update(state, scorer))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(q, timeout_s)
