"""The growing filter: rate over doublings, slices left alone, save and load."""

from pyspark.sql import functions as F

from edgefilter.operators.bloom import BloomFilter, joined_sketches, key_sketch, sketched_spec
from edgefilter.operators.bloom_series import BloomSeries


def keys(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))


def test_rate_holds_over_four_doublings(spark, tmp_path):
    series, n = BloomSeries(100, 0.05), 0
    others = keys(spark, 1_000_000, 1_020_000)
    for size in (100, 200, 400, 800, 1600):
        series = series.add(keys(spark, n, n + size), "key")
        n += size
        assert series.members(keys(spark, 0, n), "key").count() == n          # nothing is forgotten
        assert series.members(others, "key").count() < 0.05 * 20_000
    assert len(series.slices) == 5
    caps = [s.spec.n for s in series.slices]
    assert all(b == 2 * a for a, b in zip(caps, caps[1:])) and all(s.n_keys <= s.spec.n for s in series.slices)
    series.save(str(tmp_path / "s"), spark)
    again = BloomSeries.load(spark, str(tmp_path / "s"))
    both = keys(spark, 0, n).union(others)
    assert {tuple(r) for r in again.members(both, "key").collect()} == {tuple(r) for r in series.members(both, "key").collect()}


def test_known_keys_and_small_batches_take_no_new_slice(spark):
    series = BloomSeries(50, 0.01).add(keys(spark, 0, 20), "key")
    bits = series.slices[0].bits
    same = series.add(keys(spark, 0, 20), "key")
    assert same.slices[0].bits is bits and same.slices[0].n_keys == 20
    more = series.add(keys(spark, 10, 40).union(spark.createDataFrame([(None,)], "key string")), "key")
    assert len(more.slices) == 1 and 38 <= more.slices[0].n_keys <= 40
    large = more.add(keys(spark, 100, 1100), "key")
    assert len(large.slices) == 2 and large.slices[1].spec.n >= 990


def test_empty_series(spark):
    series = BloomSeries(10, 0.1)
    assert series.members(keys(spark, 0, 5), "key").collect() == []
    assert series.add(keys(spark, 0, 0), "key").slices == [] and series.stats(spark).collect() == []


def test_sketch_sizing(spark):
    some = keys(spark, 0, 30_000).union(keys(spark, 0, 20_000)).union(spark.createDataFrame([(None,)], "key string"))
    bf = BloomFilter.build_by_sketch(some, "key", 0.05)
    assert abs(bf.spec.n / 1.02 - 30_000) < 600
    assert bf.members(some, "key").count() == 30_000
    assert bf.members(keys(spark, 10**6, 10**6 + 20_000), "key").count() < 0.06 * 20_000
    parts = key_sketch(keys(spark, 0, 20_000), "key").union(key_sketch(keys(spark, 10_000, 30_000), "key"))
    assert abs(sketched_spec(joined_sketches(parts), 0.05).n / 1.02 - 30_000) < 600
    assert BloomFilter.build_by_sketch(some.where("false"), "key").spec.n == 1
