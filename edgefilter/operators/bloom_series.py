"""A growing Bloom filter as a series of slices.

A full filter is left as it is and a new slice of twice its capacity is opened,
so no key is read or hashed a second time. Slice i has the rate p / 2^(i+1); a
key is a member if any slice has it, and the rates of all slices add up to less
than p however many there are. Keys that the series already has (or seems to
have) take no room.

Every slice is a :class:`BloomFilter` over its own bit table, so probing is its
equi-join for each of the slices, whose number grows with the logarithm of the
keys.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.operators.bloom import BloomFilter, BloomSpec
from edgefilter.session import cut_lineage, materialize


class BloomSeries:
    """Slices in the order they were opened; ``n_keys`` of a slice is how many keys it took."""

    def __init__(self, first_capacity: int, false_positive_rate: float, slices: list[BloomFilter] | None = None):
        self.first_capacity = max(1, int(first_capacity))
        self.false_positive_rate = false_positive_rate
        self.slices = list(slices or [])

    def rate(self, i: int) -> float:
        return self.false_positive_rate / 2 ** (i + 1)

    def members(self, keys: DataFrame, key: str) -> DataFrame:
        """Distinct non-null values of ``key`` that some slice may contain."""
        if not self.slices:
            return keys.select(key).limit(0)
        found = [s.members(keys, key) for s in self.slices]
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        return out.distinct()

    def add(self, keys: DataFrame, key: str) -> "BloomSeries":
        """The series with the keys added: to the last slice if they fit, else to a new one.

        A batch larger than the next capacity opens a slice of its own size.
        """
        distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
        if self.slices:
            distinct = materialize(distinct, "series_keys")
            distinct = distinct.join(materialize(self.members(distinct, key), "series_members"), key, "left_anti")
        new = materialize(distinct, "series_new")
        n = new.count()
        if n == 0:
            return self
        last = self.slices[-1] if self.slices else None
        if last is not None and last.n_keys + n <= last.spec.n:
            grown = last.add(new, key)
            return self._with([*self.slices[:-1], BloomFilter(last.spec, cut_lineage(grown.bits), last.n_keys + n)])
        capacity = self.first_capacity if last is None else 2 * last.spec.n
        spec = BloomSpec(max(capacity, n), self.rate(len(self.slices)))
        slice_ = BloomFilter.build(new, key, spec, materialize=True)
        return self._with([*self.slices, BloomFilter(spec, slice_.bits, n)])

    def _with(self, slices: list[BloomFilter]) -> "BloomSeries":
        return BloomSeries(self.first_capacity, self.false_positive_rate, slices)

    def stats(self, spark: SparkSession) -> DataFrame:
        """(slice, expected_items, false_positive_rate, size, hash_count, bits_set, n_keys), a row a slice."""
        out = spark.createDataFrame([], "slice int, expected_items long, false_positive_rate double, size long, "
                                        "hash_count int, bits_set long, n_keys long")
        for i, s in enumerate(self.slices):
            out = out.union(s.stats().select(F.lit(i), "*", F.lit(s.n_keys).cast("long")))
        return out

    def save(self, path: str, spark: SparkSession) -> None:
        """A folder for each slice and one line about the series."""
        for i, s in enumerate(self.slices):
            s.save(f"{path}/slice={i}")
        line = json.dumps({"first_capacity": self.first_capacity, "p": self.false_positive_rate, "slices": len(self.slices)})
        spark.createDataFrame([(line,)], "value string").write.mode("overwrite").text(f"{path}/series")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BloomSeries":
        told = json.loads(spark.read.text(f"{path}/series").first()["value"])
        return cls(told["first_capacity"], told["p"],
                   [BloomFilter.load(spark, f"{path}/slice={i}") for i in range(told["slices"])])
