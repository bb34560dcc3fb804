"""The blacklist job with its Bloom filter in Spark's state store.

One streaming query: edits are scored, collapsed to one row for each user of an
Arrow batch and keyed by bit block; ``applyInPandasWithState`` tests a block's users
against the block's bits, and sets the bits of those newly flagged (it hands the state
through the worker's own Arrow stream; ``transformWithState`` would open a server for
each task). There is no snapshot to write and read back: an epoch touches the state of the blocks it
meets, RocksDB writes its changes to the checkpoint, and Spark commits state,
offsets and output files together, so a replayed epoch changes nothing.

The filter is blocked. A user's bits all lie in one block, chosen by one hash, so
a test reads one state row. A block starts with 2^15 bits (4 KiB); their capacity,
some 2,100 keys at p = 0.001, makes the blocks' uneven loads (two parts in a
hundred) cost little. A block that is full opens a slice of twice the bits and half the rate
(as ``operators/bloom_series.py`` does for a whole filter), so no key is read
again, and all slices of a block together stay below p. The state is bounded by
2^15 / 8 bytes times the number of blocks until the expected number of keys is
passed, and doubles when they double.

Unlike ``streaming/jobs.py``, where a batch is probed first and only unseen edits
are scored, every edit is scored here: one streaming plan can't feed a score back
into an earlier state. Use it where the score is a cheap expression. A user with a
third of the edits is a row for each Arrow batch, not a row for each edit. Edits
without a user are counted and never flagged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from edgefilter.functions.hashing import md5_u60, md5_u60_sql
from edgefilter.operators.bloom import DEFAULT_EXPECTED_ITEMS, DEFAULT_FALSE_POSITIVE_RATE
from edgefilter.operators.clean import clean_edits
from edgefilter.streaming.jobs import Scorer, edit_stream, finish

#: Bits of a block's first slice, as a power of two.
BLOCK_LOG2 = 15
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
USER_ROWS = "block long, user string, h1 long, h2 long, n_rows long, flagged boolean"
STATE = "slices array<binary>, n_keys array<long>"
VERDICTS = "block long, user string, n_rows long, unseen boolean, is_new boolean"


def slice_shape(i: int, p: float) -> tuple[int, int, int]:
    """(bits, capacity, hashes) of a block's slice ``i``, whose rate is p / 2^(i+1)."""
    bits, rate = 1 << (BLOCK_LOG2 + i), p / 2 ** (i + 1)
    capacity = int(bits * math.log(2) ** 2 / -math.log(rate))
    return bits, capacity, math.ceil(bits / capacity * math.log(2))


def n_blocks(expected_items: int, p: float) -> int:
    return max(1, math.ceil(expected_items / slice_shape(0, p)[1]))


def positions(h1: np.ndarray, h2: np.ndarray, bits: int, k: int) -> np.ndarray:
    """(keys x k) bit places: h1 + j h2 with an odd step, so the k places differ in a power of two."""
    step = h2.astype(np.uint64) | np.uint64(1)
    at = h1.astype(np.uint64)[:, None] + np.arange(k, dtype=np.uint64) * step[:, None]
    return (at & np.uint64(bits - 1)).astype(np.int64)


def _is_set(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def add_keys(slices: list[np.ndarray], counts: list[int], h1: np.ndarray, h2: np.ndarray, p: float) -> None:
    """Set the keys' bits in the last slice, as many as it takes, and in new ones."""
    while len(h1):
        if not slices or counts[-1] >= slice_shape(len(slices) - 1, p)[1]:
            slices.append(np.zeros(slice_shape(len(slices), p)[0] // 8, np.uint8))
            counts.append(0)
        bits, capacity, k = slice_shape(len(slices) - 1, p)
        take = min(capacity - counts[-1], len(h1))
        at = positions(h1[:take], h2[:take], bits, k).ravel()
        np.bitwise_or.at(slices[-1], at >> 3, (1 << (at & 7)).astype(np.uint8))
        counts[-1] += take
        h1, h2 = h1[take:], h2[take:]


def block_filter(p: float):
    """The stateful function of a block; its state holds the bits of its slices and how many keys each took."""

    def update(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        users = pd.concat(list(rows), ignore_index=True).groupby("user", as_index=False, dropna=False).agg(
            {"h1": "first", "h2": "first", "n_rows": "sum", "flagged": "max"})
        h1, h2 = users["h1"].to_numpy(np.int64), users["h2"].to_numpy(np.int64)
        slices, counts = state.get if state.exists else ([], [])
        slices, counts = [np.frombuffer(b, np.uint8).copy() for b in slices], list(counts)
        known = users["user"].notna().to_numpy()
        seen = np.zeros(len(users), bool)
        for i, data in enumerate(slices):
            bits, _, k = slice_shape(i, p)
            seen |= _is_set(data, positions(h1, h2, bits, k))
        seen &= known
        is_new = users["flagged"].to_numpy(bool) & ~seen & known
        if is_new.any():
            add_keys(slices, counts, h1[is_new], h2[is_new], p)
            state.update(([b.tobytes() for b in slices], counts))
        yield pd.DataFrame({"block": key[0], "user": users["user"], "n_rows": users["n_rows"], "unseen": ~seen, "is_new": is_new})

    return update


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g = pa.Table.from_batches([batch]).group_by(["block", "user", "h1", "h2"]).aggregate(
            [("n_rows", "sum"), ("flagged", "max")]).rename_columns(["block", "user", "h1", "h2", "n_rows", "flagged"])
        yield from g.combine_chunks().to_batches()


def user_rows(scored: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """Scored edits as (block, user, h1, h2, n_rows, flagged), one row for each user of an Arrow batch."""
    user = F.col("user")
    digest = lambda j: F.coalesce(md5_u60(F.concat(user, F.lit(f"#{j}"))), F.lit(0)).cast("long")
    keyed = scored.select(
        F.coalesce(F.pmod(md5_u60(user), F.lit(blocks)), F.lit(0)).cast("long").alias("block"), user,
        digest(1).alias("h1"), digest(2).alias("h2"),      # never null: pandas would turn the column to doubles
        F.lit(1).cast("long").alias("n_rows"), F.coalesce(F.col("prediction") >= threshold, F.lit(False)).alias("flagged"))
    return keyed.mapInArrow(_collapse, USER_ROWS)


def verdicts(scored: DataFrame, expected_items: int = DEFAULT_EXPECTED_ITEMS, p: float = DEFAULT_FALSE_POSITIVE_RATE,
             threshold: float = 0.5) -> DataFrame:
    """A stream of (block, user, n_rows, unseen, is_new), a row for each user of an epoch, from a stream of scored edits."""
    return user_rows(scored, n_blocks(expected_items, p), threshold).groupBy("block").applyInPandasWithState(
        block_filter(p), VERDICTS, STATE, "append", "NoTimeout")


@contextmanager
def rocksdb(spark: SparkSession):
    """The RocksDB state store for queries started or state read inside; other queries keep what they had."""
    had = {k: spark.conf.get(k, None) for k in _ROCKSDB}
    for k, v in _ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in had.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_state_job(spark: SparkSession, lines: DataFrame, scorer: Scorer, out: str, checkpoint: str,
                  expected_items: int = DEFAULT_EXPECTED_ITEMS, p: float = DEFAULT_FALSE_POSITIVE_RATE,
                  threshold: float = 0.5, timeout_s: int | None = None) -> None:
    """Take all input present; verdicts are appended to Parquet at ``out``.

    The number of blocks follows from ``expected_items`` and ``p``: keep them when a checkpoint is taken up again.
    """
    with rocksdb(spark):
        found = verdicts(scorer(clean_edits(edit_stream(lines))), expected_items, p, threshold)
        finish(found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start(), timeout_s)


def blacklist(spark: SparkSession, out: str) -> DataFrame:
    """(user) of every user flagged so far, each once: the sink's log names the files of committed epochs only."""
    return spark.read.schema(VERDICTS).parquet(out).where("is_new").select("user")


def filter_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(block, slice, bits, n_keys): the filter as a table, read from the state store."""
    with rocksdb(spark):
        rows = spark.read.format("statestore").load(checkpoint)
        return rows.select(F.col("key.block").alias("block"), F.posexplode(
            F.arrays_zip(F.col("value.groupState.slices").alias("bits"), F.col("value.groupState.n_keys").alias("n_keys"))
        ).alias("slice", "s")).select("block", "slice", "s.bits", "s.n_keys")


def first_slice_sql(keys: str, expected_items: int = DEFAULT_EXPECTED_ITEMS, p: float = DEFAULT_FALSE_POSITIVE_RATE) -> str:
    """DuckDB text: (block, n_keys, bits_set) of the blocks that hold the users of ``keys`` in their first slice."""
    bits, _, k = slice_shape(0, p)
    h1, h2 = (md5_u60_sql(f"\"user\" || '#{j}'") for j in (1, 2))
    return f"""select block, count(distinct "user") as n_keys, count(distinct pos) as bits_set from (
  select "user", {md5_u60_sql('"user"')} % {n_blocks(expected_items, p)} as block,
    ({h1}::hugeint + j::hugeint * ({h2} | 1)) % {bits} as pos
  from ({keys}), range({k}) t(j)) group by block"""
