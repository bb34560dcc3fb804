"""Small shared helpers: names, hashes of ids, Arrow blocks, written tables, sides of joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.session import scratch_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` query of this subpackage."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_hash_mod(col: str | Column, m: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``m`` (null id: null)."""
    id_col = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(m))


def hash_share(col: Column, part: float) -> Column:
    """True for the share ``part`` of ids of smallest hash (all ids from 1 on); null ids count as one id."""
    if part >= 1:
        return F.lit(True)
    return F.xxhash64(F.coalesce(col.cast("string"), F.lit(""))) < F.lit(int((part - 0.5) * 2**64))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written once as a table bucketed by ``key``; later joins on ``key`` don't move it again.

    The files lie in the shared scratch folder. The table's name is private to
    the call; the catalog entry stays until the session ends because returned
    plans still read it.
    """
    spark = df.sparkSession
    n = partitions(spark)
    name = f"llm_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, key).write.format("parquet").option("compression", "zstd")
       .option("path", scratch_path(spark, name)).bucketBy(n, key).saveAsTable(name))
    return spark.table(name)


#: Bytes of rows, as a hash table holds them, up to which a written table may be broadcast; a row of a few numbers.
SENT_BYTES, NARROW_ROW = 1 << 25, 64


def by_rows(df: DataFrame, row_bytes: int | Column = NARROW_ROW) -> DataFrame:
    """``df``, columns of written tables, as a side of a join: above SENT_BYTES of rows it is merged, never broadcast.

    Spark goes by the size of the files, and the driver holds the rows: compressed columns take many times
    their files there, and what an explode makes of a row is in no estimate (``row_bytes`` has it).
    """
    each = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    return df.hint("merge") if (df.agg(F.sum(each)).first()[0] or 0) > SENT_BYTES else df


def release() -> None:
    """Give freed memory back to the system; a Python worker that is used again would keep its last task's."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


#: Text of a block. The vectorised passes hold some fifteen numbers a byte at a time.
BLOCK_BYTES = (1 << 20) - 1


def blocks(batch: pa.RecordBatch, column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose ``column`` holds at most ``max_bytes`` (or one row)."""
    ends = offsets(batch.column(column))
    n, start = len(ends) - 1, 0
    while start < n:
        stop = int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def offsets(arr: pa.Array) -> np.ndarray:
    """Byte offsets of a (large) string or binary array, one more than its rows."""
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)


def raw_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a string or binary array end to end, and each row's offsets. Null rows are empty."""
    ends = offsets(arr)
    if len(arr) == 0 or arr.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return data, ends - ends[0]
