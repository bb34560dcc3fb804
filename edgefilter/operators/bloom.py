"""Relational Bloom filter.

The bit array is a table of ``(bucket, bits)`` rows: bucket ``b`` holds bits
``[(b-1)*32768, b*32768)`` as a 4 KiB binary built by ``bitmap_construct_agg``.
Only buckets with a set bit exist, so the table never exceeds ``m/8`` bytes.

Bit positions come from k independent hashes,
``pos_i = u60(md5(key || '#' || i)) mod m`` for ``i < k`` (60 bits, so that
every position of any real filter can be reached), so any engine with md5 can
recompute them (the oracle statements do). Double hashing on
two halves of one digest would be cheaper but degenerates on small filters:
when h2 shares a factor with m, a key's k positions collapse onto few bits.

Probing never runs Python: the distinct probe keys are expanded to their k
positions, joined to the bit table on ``bucket`` and tested with binary
expressions; a key is a member when all k bits are set. The bit table is
broadcast only when ``m/8`` bytes, a bound known before any job runs, is
under the limit; above it the probe positions are shuffled on ``bucket``
(uniform by construction, so no skew).
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.functions.hashing import md5_u60, md5_u60_sql
from edgefilter.session import cut_lineage, materialize

BITS_PER_BUCKET = 32768
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: Registers of a distinct-count sketch, as a power of two: standard error 0.8 %, some 8 KiB.
SKETCH_LOG2 = 14

# The stream job's filter when no saved one exists.
DEFAULT_EXPECTED_ITEMS = 1_000_000
DEFAULT_FALSE_POSITIVE_RATE = 0.001


@dataclass(frozen=True)
class BloomSpec:
    """Sizing from expected items n and false-positive rate p."""

    expected_items: int
    false_positive_rate: float

    @property
    def n(self) -> int:
        # n = 0 would divide by zero in the hash count; an empty filter
        # is sized as for one item.
        return max(int(self.expected_items), 1)

    @property
    def size(self) -> int:
        """m = ceil(-(n ln p) / (ln 2)^2)."""
        return math.ceil(-(self.n * math.log(self.false_positive_rate)) / (math.log(2) ** 2))

    @property
    def hash_count(self) -> int:
        """k = ceil(m / n * ln 2)."""
        return math.ceil((self.size / self.n) * math.log(2))

    @property
    def bit_bytes(self) -> int:
        return (self.size + 7) // 8

    def grown(self, total_items: int) -> "BloomSpec":
        """Spec for a rebuild once the key count passes n: at least double."""
        return BloomSpec(max(total_items, 2 * self.n), self.false_positive_rate)


def key_positions(keys: DataFrame, key: str, spec: BloomSpec) -> DataFrame:
    """(key, pos) for each non-null key and each of its k hash functions."""
    m, k = spec.size, spec.hash_count
    salted = F.concat(F.col(key).cast("string"), F.lit("#"), F.col("_i").cast("string"))
    return (keys.filter(F.col(key).isNotNull())
                .select(F.col(key), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"))
                .select(F.col(key), F.pmod(md5_u60(salted), F.lit(m)).alias("pos")))


def _bucket(pos: Column) -> Column:
    return F.bitmap_bucket_number(pos + 1).cast("int")


def _bit(pos: Column) -> Column:
    return F.bitmap_bit_position(pos + 1)


def bits_from_positions(positions: DataFrame, size: int | None = None) -> DataFrame:
    """Fold bit positions into (bucket, bits).

    With the filter size known, positions are hash-partitioned by bucket
    (at most one partition per bucket) and folded inside that stage: the
    shuffle carries n*k positions, not a partial 4 KiB bitmap per bucket
    from every map task (tasks x m/8 bytes once keys are spread widely).
    """
    keyed = positions.select(_bucket(F.col("pos")).alias("bucket"), _bit(F.col("pos")).alias("bit"))
    if size is not None:
        n_buckets = -(-size // BITS_PER_BUCKET)
        par = positions.sparkSession.sparkContext.defaultParallelism
        keyed = keyed.repartition(max(1, min(n_buckets, 4 * par)), "bucket")
    return keyed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bit_is_set(bits: Column, bit: Column) -> Column:
    """Bit ``bit`` (0-based, LSB first in each byte) of a bitmap binary."""
    byte = F.substr(bits, (bit / 8).cast("int") + 1, F.lit(1))
    val = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(val, (bit % 8).cast("int")) == 1


def positions_from_bits(bits: DataFrame) -> DataFrame:
    """Decode a bit table back to positions (one row per set bit)."""
    offs = F.explode(F.sequence(F.lit(0), F.lit(BITS_PER_BUCKET - 1))).alias("_b")
    return (bits.select("bucket", "bits", offs)
                .filter(bit_is_set(F.col("bits"), F.col("_b")))
                .select(((F.col("bucket") - 1).cast("bigint") * BITS_PER_BUCKET
                         + F.col("_b")).alias("pos")))


def key_sketch(keys: DataFrame, key: str) -> DataFrame:
    """(sketch): one HyperLogLog sketch of the non-null values of ``key``; sketches of parts can be joined."""
    return keys.where(F.col(key).isNotNull()).agg(F.hll_sketch_agg(F.col(key).cast("string"), F.lit(SKETCH_LOG2)).alias("sketch"))


def joined_sketches(sketches: DataFrame) -> DataFrame:
    """(sketch): the sketch of all values of the given ones, without reading a key again."""
    return sketches.agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_spec(sketch: DataFrame, false_positive_rate: float) -> BloomSpec:
    """Sizing from a one-row sketch table; a little room for the estimate's error."""
    n = sketch.select(F.hll_sketch_estimate("sketch")).first()[0]
    return BloomSpec(math.ceil(1.02 * (n or 0)), false_positive_rate)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and no Python task that would have to make them."""
    fields = [f.split() for f in schema.split(", ")]
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])


class BloomFilter:
    """A Bloom filter whose bit array is a DataFrame."""

    def __init__(self, spec: BloomSpec, bits: DataFrame, n_keys: int | None = None):
        self.spec = spec
        self.bits = bits
        self.n_keys = n_keys

    # -- construction ---------------------------------------------------
    @classmethod
    def empty(cls, spark: SparkSession, spec: BloomSpec) -> "BloomFilter":
        return cls(spec, empty_table(spark, "bucket int, bits binary"), 0)

    @classmethod
    def build_by_sketch(cls, keys: DataFrame, key: str, false_positive_rate: float = 0.1) -> "BloomFilter":
        """Filter over the values of ``key``, sized by a distinct-count sketch.

        One aggregate of a few kilobytes a task says how many keys there are
        (within about 2 %), so they are neither made distinct, written nor
        counted before they are hashed; equal keys set equal bits.
        """
        spec = sketched_spec(key_sketch(keys, key), false_positive_rate)
        bits = cut_lineage(bits_from_positions(key_positions(keys, key, spec).select("pos"), spec.size))
        return cls(spec, bits, spec.n)

    @classmethod
    def build(cls, keys: DataFrame, key: str, spec: BloomSpec | None = None,
              false_positive_rate: float = 0.1, materialize: bool = False) -> "BloomFilter":
        """Filter over the distinct non-null values of ``key``.

        Without a spec, n is the distinct key count: the distinct keys are
        then checkpointed once, counted, and hashed from the checkpoint, and
        the bit table is checkpointed too, so every later probe reads at
        most m/8 bytes instead of re-deriving the keys.
        ``materialize`` checkpoints the bit table also when a spec is given.
        """
        distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct()
        n_keys = None
        if spec is None:
            distinct = cut_lineage(distinct)
            n_keys = distinct.count()
            spec = BloomSpec(n_keys, false_positive_rate)
            materialize = True
        bits = bits_from_positions(key_positions(distinct, key, spec).select("pos"), spec.size)
        if materialize:
            bits = cut_lineage(bits)
        return cls(spec, bits, n_keys)

    def add(self, keys: DataFrame, key: str) -> "BloomFilter":
        """Filter with the keys added at the same (m, k): bitwise OR."""
        return self.merge(BloomFilter.build(keys, key, self.spec))

    def merge(self, other: "BloomFilter") -> "BloomFilter":
        if (other.spec.size, other.spec.hash_count) != (self.spec.size, self.spec.hash_count):
            raise ValueError("merge needs filters of equal size and hash count")
        both = self.bits.unionByName(other.bits)
        merged = both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        n = None if self.n_keys is None or other.n_keys is None else self.n_keys + other.n_keys
        return BloomFilter(self.spec, merged, n)

    # -- probing --------------------------------------------------------
    def _bits_for_join(self) -> DataFrame:
        if self.spec.bit_bytes <= BROADCAST_LIMIT_BYTES:
            return F.broadcast(self.bits)
        return self.bits

    def members(self, keys: DataFrame, key: str) -> DataFrame:
        """Distinct non-null values of ``key`` that the filter may contain."""
        k = self.spec.hash_count
        distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct()
        pos = key_positions(distinct, key, self.spec)
        probe = pos.select(key, _bucket(F.col("pos")).alias("bucket"), _bit(F.col("pos")).alias("bit"))
        hit = probe.join(self._bits_for_join(), "bucket", "inner") \
                   .filter(bit_is_set(F.col("bits"), F.col("bit")))
        # Two of a key's k positions may coincide; they then match the same
        # bit twice, so counting matched (key, i) rows against k is exact.
        return hit.groupBy(key).agg(F.count(F.lit(1)).alias("_hits")) \
                  .filter(F.col("_hits") == k).select(key)

    def _member_table(self, df: DataFrame, key: str, path: str | None = None) -> DataFrame:
        # Written and re-read: the join back to ``df`` then sees two ordinary
        # shuffle stages, so AQE broadcasts the members when they turn out
        # small (``df`` is not shuffled at all) and otherwise splits the
        # partition of a hot key (one user may own a third of the rows).
        # A caller that probes again and again names the path to overwrite.
        if path is None:
            return materialize(self.members(df, key), "bloom_members")
        self.members(df, key).write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)

    @property
    def is_empty(self) -> bool:
        """Known to hold no key (all bits zero): every probe is negative."""
        return self.n_keys == 0

    def semi_join(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose key may be in the filter (approximate IN)."""
        if self.is_empty:
            return df.filter(F.lit(False))
        return df.join(self._member_table(df, key), key, "left_semi")

    def anti_join(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose key is certainly not in the filter; NULL keys stay."""
        if self.is_empty:
            return df
        return df.join(self._member_table(df, key), key, "left_anti")

    def mark(self, df: DataFrame, key: str, out: str = "predicted", path: str | None = None) -> DataFrame:
        """``df`` with a boolean column: may the key be in the filter."""
        if self.is_empty:
            return df.withColumn(out, F.lit(False))
        m = self._member_table(df, key, path).withColumn(out, F.lit(True))
        return df.join(m, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))

    # -- inspection and persistence ------------------------------------
    def stats(self) -> DataFrame:
        s = self.spec
        return self.bits.agg(
            F.lit(s.n).cast("bigint").alias("expected_items"),
            F.lit(s.false_positive_rate).alias("false_positive_rate"),
            F.lit(s.size).cast("bigint").alias("size"),
            F.lit(s.hash_count).alias("hash_count"),
            F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("bits_set"),
        )

    def positions(self) -> DataFrame:
        return positions_from_bits(self.bits)

    def save(self, path: str) -> None:
        """Bit table as parquet plus a one-line JSON spec, under ``path``."""
        spark = self.bits.sparkSession
        self.bits.write.mode("overwrite").parquet(f"{path}/bits")
        meta = {"expected_items": self.spec.expected_items,
                "false_positive_rate": self.spec.false_positive_rate,
                "size": self.spec.size, "hash_count": self.spec.hash_count,
                "n_keys": self.n_keys}
        spark.createDataFrame([(json.dumps(meta),)], "value string") \
             .coalesce(1).write.mode("overwrite").text(f"{path}/spec")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BloomFilter":
        meta = json.loads(spark.read.text(f"{path}/spec").first()["value"])
        spec = BloomSpec(meta["expected_items"], meta["false_positive_rate"])
        if (spec.size, spec.hash_count) != (meta["size"], meta["hash_count"]):
            raise ValueError("stored spec does not match its own sizing")
        return cls(spec, spark.read.parquet(f"{path}/bits"), meta.get("n_keys"))

    @classmethod
    def load_or_create(cls, spark: SparkSession, path: str,
                       expected_items: int = DEFAULT_EXPECTED_ITEMS,
                       false_positive_rate: float = DEFAULT_FALSE_POSITIVE_RATE) -> "BloomFilter":
        try:
            return cls.load(spark, path)
        except Exception as exc:  # noqa: BLE001 - missing path is the normal first run
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
            return cls.empty(spark, BloomSpec(expected_items, false_positive_rate))


# -- DuckDB text of the same filter, for oracle statements ---------------

def spec_sql(keys_cte: str, p: float) -> str:
    """CTE body giving one row (n, m, k) from a CTE of distinct keys ``k``."""
    return (f"select n, m, cast(ceil(m / n * ln(2)) as bigint) as kk from ("
            f"select n, cast(ceil(-(n * ln({p!r})) / (ln(2) * ln(2))) as bigint) as m from ("
            f"select greatest(count(*), 1) as n from {keys_cte}))")


def positions_sql(keys_cte: str, key: str, spec_cte: str) -> str:
    """CTE body of (key, pos) rows, the DuckDB text of :func:`key_positions`."""
    salted = f"(cast({key} as varchar) || '#' || cast(i as varchar))"
    return (f"select {key}, {md5_u60_sql(salted)} % m as pos "
            f"from (select {key}, unnest(range(kk)) as i, m from {keys_cte}, {spec_cte} "
            f"where {key} is not null)")


def members_sql(probe_cte: str, key: str, bits_cte: str, spec_cte: str) -> str:
    """CTE body of probe keys whose k positions are all in ``bits_cte(pos)``."""
    distinct = f"(select distinct {key} from {probe_cte})"
    return (f"select p.{key} from ({positions_sql(distinct, key, spec_cte)}) p "
            f"join {bits_cte} b on b.pos = p.pos, {spec_cte} "
            f"group by p.{key}, kk having count(*) = kk")
