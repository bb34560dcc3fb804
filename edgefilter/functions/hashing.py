"""Deterministic hashing expressions that DuckDB can repeat bit for bit.

Spark's ``hash``/``xxhash64`` use seeds and tail handling no other engine
shares, so every hash whose result must be checkable is derived from md5:
an unsigned 32-bit integer taken from a fixed slice of the hex digest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_u32(c: Column, part: int = 0) -> Column:
    """Unsigned 32-bit integer from hex digits [8*part, 8*part+8) of md5(c)."""
    return F.conv(F.substring(F.md5(c.cast("string")), 8 * part + 1, 8), 16, 10).cast("bigint")


def md5_u32_sql(expr: str, part: int = 0) -> str:
    """DuckDB text of :func:`md5_u32`."""
    return f"('0x' || substr(md5(cast({expr} as varchar)), {8 * part + 1}, 8))::BIGINT"


def md5_u60(c: Column) -> Column:
    """Unsigned 60-bit integer from the first 15 hex digits of md5(c)."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("bigint")


def md5_u60_sql(expr: str) -> str:
    """DuckDB text of :func:`md5_u60`."""
    return f"('0x' || substr(md5(cast({expr} as varchar)), 1, 15))::BIGINT"


def hash_bucket(c: Column, buckets: int) -> Column:
    """Bucket in [0, buckets) from md5; NULL input gives NULL."""
    return F.pmod(md5_u32(c), F.lit(buckets))


def hash_bucket_sql(expr: str, buckets: int) -> str:
    return f"({md5_u32_sql(expr)} % {buckets})"


def unit_uniform(c: Column, part: int = 0) -> Column:
    """Uniform in [0, 1) from md5, exact in double arithmetic."""
    return md5_u32(c, part) / F.lit(4294967296.0)


def unit_uniform_sql(expr: str, part: int = 0) -> str:
    return f"({md5_u32_sql(expr, part)} / 4294967296.0)"
