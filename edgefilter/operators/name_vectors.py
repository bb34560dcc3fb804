"""Name vectors by random indexing: hashed tokens, no vocabulary.

Every token stands for a sparse vector of its own: ``ENTRIES`` slots of ``DIM``
with a sign each, read off its md5 digests. A name is the sum of its tokens'
vectors, each weighted by how rare the token is, scaled to length one; names that
share rare tokens lie close. Rarity is counted by md5 bucket of the token
(``WEIGHT_BUCKETS`` of them), so the one aggregate has a fixed size however many
tokens there are, and its table may be broadcast. Tokens are neither collected
nor joined by their text, and a very frequent token is no hot key.

Weights are whole thousandths, so sums don't depend on their order and any SQL
engine gets the same vectors.

A null name, or one without a token, has no vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgefilter.functions.hashing import md5_u32, md5_u32_sql

DIM = 100
ENTRIES = 8
WEIGHT_BUCKETS = 1 << 18
#: Marker bucket whose frequency is the number of names.
_ALL = -1


def name_tokens(name: Column) -> Column:
    """Lower-case tokens between white space, repeats included."""
    return F.filter(F.split(F.lower(name), r"\s"), lambda t: t != "")


def token_entries(token: Column) -> Column:
    """array<struct<slot, sign>>: the token's own vector."""
    parts = [md5_u32(F.concat(token, F.lit(f"/{d}")), p) for d in range(ENTRIES // 4) for p in range(4)]
    return F.array(*[F.struct(F.pmod(x, F.lit(DIM)).cast("int").alias("slot"),
                              (1 - 2 * F.pmod(F.floor(x / DIM), F.lit(2))).alias("sign")) for x in parts])


def token_weights(names: DataFrame) -> DataFrame:
    """(bucket, weight): 1000 (1 + ln((N + 1) / (df + 1))) cut to whole numbers, for at most ``WEIGHT_BUCKETS`` buckets."""
    buckets = F.array_union(F.transform(name_tokens(F.col("name")), lambda t: F.pmod(md5_u32(t), F.lit(WEIGHT_BUCKETS))),
                            F.array(F.lit(_ALL).cast("bigint")))
    counts = names.select(F.explode(buckets).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))
    total = F.max(F.when(F.col("bucket") == _ALL, F.col("df"))).over(Window.partitionBy())   # over the bounded table
    weight = 1000 + F.floor(1000 * F.log((total + 1) / (F.col("df") + 1)))
    return counts.select("bucket", weight.alias("weight")).where(F.col("bucket") != _ALL)


def _sums(weights: dict[int, int]) -> Callable:
    """(name, vec) of a task's names, from the buckets and entries of their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(WEIGHT_BUCKETS, np.int64)
        weight[list(weights)] = list(weights.values())
        for batch in batches:
            n, buckets, entries = batch.num_rows, batch.column("buckets"), batch.column("entries")
            row = np.repeat(np.arange(n), buckets.value_lengths().to_numpy(zero_copy_only=False))
            w = weight[buckets.flatten().to_numpy(zero_copy_only=False)]
            e = entries.flatten().to_numpy(zero_copy_only=False)          # slot, its sign in the lowest bit
            v = np.zeros(n * DIM, np.int64)
            np.add.at(v, np.repeat(row, ENTRIES) * DIM + (e >> 1), np.repeat(w, ENTRIES) * (1 - 2 * (e & 1)))
            v = v.reshape(n, DIM)
            length = np.sqrt((v * v).sum(axis=1).astype(float))[:, None]
            vec = np.divide(v.astype(float), length, out=np.zeros((n, DIM)), where=length > 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * DIM, pa.int32()), pa.array(vec.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("name"), lists], ["name", "vec"])
    return run


def name_vectors(names: DataFrame) -> DataFrame:
    """(name, vec): a unit vector of ``DIM`` doubles for each distinct name of ``names``.

    A name's vector is made from its own row and the table of weights, which every
    task has: tokens are not shuffled again.
    """
    # the names are short but their vectors are not: as many tasks as shuffles have, whatever the names' bytes
    many = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = names.select("name").distinct()
    weights = {r["bucket"]: r["weight"] for r in token_weights(distinct).collect()}      # at most WEIGHT_BUCKETS
    tokens = name_tokens(F.col("name"))
    packed = F.flatten(F.transform("tokens", lambda t: F.transform(
        token_entries(t), lambda e: (2 * e["slot"] + F.when(e["sign"] < 0, 1).otherwise(0)).cast("bigint"))))
    rows = distinct.where(F.size(tokens) > 0).repartition(many).select("name", tokens.alias("tokens")).select(
        "name", F.transform("tokens", lambda t: F.pmod(md5_u32(t), F.lit(WEIGHT_BUCKETS))).alias("buckets"), packed.alias("entries"))
    return rows.mapInArrow(_sums(weights), "name string, vec array<double>")


def name_vectors_sql(names: str) -> str:
    """DuckDB text of :func:`name_vectors` over a relation with a column ``name``."""
    parts = [md5_u32_sql(f"token || '/{d}'", p) for d in range(ENTRIES // 4) for p in range(4)]
    return f"""(with n as (select distinct name from {names} x),
t as materialized (select name, token, {md5_u32_sql('token')} % {WEIGHT_BUCKETS} as bucket from (
  select name, unnest(list_filter(string_split_regex(lower(name), '\\s'), lambda t: t <> '')) as token from n)),
w as (select bucket, 1000 + floor(1000 * ln(((select count(*) from n) + 1) / (count(distinct name) + 1)))::BIGINT as weight
  from t group by bucket),
c as (select name, x % {DIM} as slot, sum((1 - 2 * ((x // {DIM}) % 2)) * weight)::BIGINT as v
  from (select name, weight, unnest([{', '.join(parts)}]) as x from t join w using (bucket)) group by all),
s as (select name, sqrt(sum(v * v)::DOUBLE) as length, map(list(slot), list(v)) as m from c group by name)
select name, list_transform(range(0, {DIM}), lambda i: case when length > 0 then coalesce(m[i], 0)::DOUBLE / length
  else 0.0 end) as vec from s)"""
