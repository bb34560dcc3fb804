import math

from pyspark.sql import functions as F

from edgefilter.operators.bloom import BloomFilter, BloomSpec, key_positions
from tests.conftest import SF01


def test_sizing_matches_formulas():
    s = BloomSpec(300, 0.1)
    assert (s.size, s.hash_count) == (1438, 4)
    s = BloomSpec(1_000_000, 0.001)
    assert s.size == math.ceil(-(1_000_000 * math.log(0.001)) / (math.log(2) ** 2))
    assert s.hash_count == math.ceil(s.size / 1_000_000 * math.log(2))
    # n = 0 is sized as n = 1 instead of dividing by zero
    assert BloomSpec(0, 0.1).hash_count == BloomSpec(1, 0.1).hash_count


def _customers(spark):
    return spark.read.parquet(f"{SF01}/customer.parquet").select(F.col("c_name").alias("k"))


def test_no_false_negatives_and_fp_rate(spark):
    c = _customers(spark)
    inside = c.filter(F.col("k") < "Customer#000000800")
    outside = c.filter(F.col("k") >= "Customer#000000800")
    bf = BloomFilter.build(inside, "k", false_positive_rate=0.1)
    n_in = inside.count()
    assert bf.members(inside, "k").count() == n_in
    fp = bf.members(outside, "k").count() / outside.count()
    assert fp <= 1.5 * 0.1


def test_edge_cases_single_duplicates_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("a",)], "k string")
    bf = BloomFilter.build(df, "k", false_positive_rate=0.01)
    assert bf.spec.n == 1
    assert [r.k for r in bf.members(df, "k").collect()] == ["a"]
    # NULL keys are never members: semi drops them, anti keeps them
    assert bf.semi_join(df, "k").count() == 3
    assert bf.anti_join(df, "k").filter(F.col("k").isNull()).count() == 1


def test_merge_equals_build_of_union(spark):
    c = _customers(spark)
    spec = BloomSpec(c.count(), 0.05)
    a = BloomFilter.build(c.filter(F.col("k") < "Customer#000000700"), "k", spec)
    b = BloomFilter.build(c.filter(F.col("k") >= "Customer#000000700"), "k", spec)
    whole = BloomFilter.build(c, "k", spec)
    merged = a.merge(b)
    assert sorted(r.pos for r in merged.positions().collect()) == \
        sorted(r.pos for r in whole.positions().collect())


def test_positions_decode_matches_hash_positions(spark):
    c = _customers(spark).limit(50)
    spec = BloomSpec(50, 0.1)
    bf = BloomFilter.build(c, "k", spec)
    expect = {r.pos for r in key_positions(c, "k", spec).collect()}
    assert {r.pos for r in bf.positions().collect()} == expect
    assert bf.stats().first()["bits_set"] == len(expect)


def test_rebuild_at_grown_size_keeps_all_keys(spark):
    c = _customers(spark)
    first = BloomFilter.build(c.filter(F.col("k") < "Customer#000000100"), "k", false_positive_rate=0.1)
    total = c.count()
    spec = first.spec.grown(total)
    assert spec.n >= max(total, 2 * first.spec.n)
    rebuilt = BloomFilter.build(c, "k", spec)
    assert rebuilt.members(c, "k").count() == total


def test_save_load_roundtrip(spark, tmp_path):
    c = _customers(spark)
    bf = BloomFilter.build(c, "k", false_positive_rate=0.1)
    bf.save(str(tmp_path / "bf"))
    back = BloomFilter.load(spark, str(tmp_path / "bf"))
    assert back.spec == bf.spec
    assert back.members(c, "k").count() == c.count()
    fresh = BloomFilter.load_or_create(spark, str(tmp_path / "missing"))
    assert (fresh.spec.expected_items, fresh.spec.false_positive_rate) == (1_000_000, 0.001)


def test_mark_flags_every_row(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("", False)], "user string, bot boolean")
    bf = BloomFilter.build(df.filter("bot"), "user", false_positive_rate=0.001)
    out = {r.user: r.predicted for r in bf.mark(df, "user").collect()}
    assert out["a"] is True and len(out) == 3


def test_positions_reach_beyond_32_bits(spark):
    """A filter of more than 2^32 bits uses all of them; no bit table is built here."""
    from edgefilter.operators.bloom import key_positions
    spec = BloomSpec(1_000_000_000, 0.001)
    assert spec.size > 1 << 33
    keys = spark.range(0, 3000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user"))
    pos = key_positions(keys, "user", spec)
    above, top, n = pos.agg(F.avg((F.col("pos") >= 1 << 32).cast("double")), F.max("pos"), F.count("*")).first()
    assert n == 3000 * spec.hash_count and top < spec.size
    assert abs(above - (1 - (1 << 32) / spec.size)) < 0.02
