"""Blacklist and Bloom-filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket, hash_bucket_sql
from edgefilter.operators import evaluate as EV
from edgefilter.operators.bloom import (
    BloomFilter,
    BloomSpec,
    joined_sketches,
    key_sketch,
    members_sql,
    positions_sql,
    sketched_spec,
    spec_sql,
)
from edgefilter.operators.bloom_series import BloomSeries
from edgefilter.operators.clean import clean_edits
from edgefilter.operators.scoring import rule_prediction, rule_prediction_sql, split_column, split_sql
from edgefilter.plans.registry import register
from edgefilter.session import materialize, scratch_path
from edgefilter.sources.tables import edits, table, with_ctes

P_BLACKLIST = 0.1


def split_edits(spark, sf_dir):
    """Cleaned edits tagged train/test by a hash of the id, with the rule prediction."""
    c = clean_edits(edits(spark, sf_dir))
    return c.withColumn("split", split_column(F.col("id"))).withColumn("prediction", rule_prediction())


def blacklist_users(spark, sf_dir):
    """Labelled bots of the train part, union users predicted bot on the test part."""
    labelled = (F.col("split") == "train") & F.col("bot")
    predicted = (F.col("split") == "test") & (F.col("prediction") >= 0.5)
    return split_edits(spark, sf_dir).filter((labelled | predicted) & F.col("user").isNotNull()).select("user").distinct()


def blacklist_filter(spark, sf_dir, p: float = P_BLACKLIST) -> BloomFilter:
    return BloomFilter.build(blacklist_users(spark, sf_dir), "user", false_positive_rate=p)


# -- DuckDB text ----------------------------------------------------------
_SPLIT = ("split", f"select *, {split_sql('id')} as split, {rule_prediction_sql()} as prediction from clean")
_TRUTH = ("truth", "select distinct \"user\" from split where split = 'train' and bot and \"user\" is not null")
_PRED = ("pred", "select distinct \"user\" from split where split = 'test' and prediction >= 0.5 "
                 "and \"user\" is not null")
_KEYS = ("keys", "select \"user\" from truth union select \"user\" from pred")
_SPEC = ("spec", spec_sql("keys", P_BLACKLIST))
_BITS = ("bits", f"select distinct pos from ({positions_sql('keys', chr(34) + 'user' + chr(34), 'spec')})")
_FILTER = [_SPLIT, _TRUTH, _PRED, _KEYS, _SPEC, _BITS]
_U = '"user"'


@register("blacklist_union", with_ctes("select \"user\" from keys", extra=_FILTER[:4]))
def q_blacklist_union(spark, sf_dir):
    return blacklist_users(spark, sf_dir)


@register("bloom_params", with_ctes("""
select n as expected_items, p as false_positive_rate, m as size,
       cast(ceil(m / n * ln(2)) as bigint) as hash_count
from (select n, p, cast(ceil(-(n * ln(p)) / (ln(2) * ln(2))) as bigint) as m
      from (select greatest(count(*), 1) as n from keys), (values (0.1::DOUBLE), (0.01::DOUBLE), (0.001::DOUBLE)) t(p))""",
    extra=_FILTER[:4]))
def q_bloom_params(spark, sf_dir):
    n = blacklist_users(spark, sf_dir).agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n"))
    rates = F.explode(F.array(F.lit(0.1), F.lit(0.01), F.lit(0.001))).alias("p")
    ln2 = F.log(F.lit(2.0))
    m = F.ceil(-(F.col("n") * F.log(F.col("p"))) / (ln2 * ln2)).cast("bigint")
    return (n.select("n", rates)
             .select(F.col("n").cast("bigint").alias("expected_items"),
                     F.col("p").alias("false_positive_rate"), m.alias("size"))
             .withColumn("hash_count", F.ceil(F.col("size") / F.col("expected_items") * ln2).cast("bigint")))


@register("bloom_build", with_ctes("""
select n as expected_items, 0.1::DOUBLE as false_positive_rate, m as size, kk as hash_count,
       (select count(*) from bits) as bits_set
from spec""", extra=_FILTER))
def q_bloom_build(spark, sf_dir):
    return blacklist_filter(spark, sf_dir).stats()


@register("bloom_semi_join", with_ctes(f"""
select c.id, c.{_U} from clean c
where c.{_U} in (select {_U} from ({members_sql('clean', _U, 'bits', 'spec')}))""", extra=_FILTER))
def q_bloom_semi_join(spark, sf_dir):
    bf = blacklist_filter(spark, sf_dir)
    return bf.semi_join(clean_edits(edits(spark, sf_dir)).select("id", "user"), "user")


@register("bloom_anti_join", with_ctes(f"""
select c.id, c.{_U} from clean c
where c.{_U} is null or c.{_U} not in (select {_U} from ({members_sql('clean', _U, 'bits', 'spec')}))""",
    extra=_FILTER))
def q_bloom_anti_join(spark, sf_dir):
    bf = blacklist_filter(spark, sf_dir)
    return bf.anti_join(clean_edits(edits(spark, sf_dir)).select("id", "user"), "user")


@register("bloom_evaluation", with_ctes(f"""
select count(*) filter (where predicted and bot) as tp,
       count(*) filter (where predicted and not bot) as fp,
       count(*) filter (where not predicted and not bot) as tn,
       count(*) filter (where not predicted and bot) as fn,
       count(*) as total,
       round((count(*) filter (where predicted = bot)) / count(*), 6) as accuracy,
       coalesce(round((count(*) filter (where predicted and bot))
             / nullif(count(*) filter (where predicted), 0), 6), 0.0) as precision,
       coalesce(round((count(*) filter (where predicted and bot))
             / nullif(count(*) filter (where bot), 0), 6), 0.0) as recall
from (select u.{_U}, u.bot, u.{_U} in (select {_U} from mem) as predicted from users u)""",
    extra=_FILTER + [
        ("users", f"select distinct coalesce({_U}, '') as {_U}, bot from split where split = 'test'"),
        ("mem", members_sql("users", _U, "bits", "spec"))]))
def q_bloom_evaluation(spark, sf_dir):
    bf = blacklist_filter(spark, sf_dir)
    test = split_edits(spark, sf_dir).filter(F.col("split") == "test")
    users = test.select(F.coalesce(F.col("user"), F.lit("")).alias("user"), "bot").distinct()
    return EV.blacklist_evaluation(bf.mark(users, "user"))


@register("bloom_merge", with_ctes("select pos from bits", extra=_FILTER))
def q_bloom_merge(spark, sf_dir):
    """Filters of the two halves at one spec, OR-ed, equal the filter of the union."""
    spec = BloomSpec(blacklist_users(spark, sf_dir).count(), P_BLACKLIST)
    s = split_edits(spark, sf_dir)
    truth = s.filter((F.col("split") == "train") & F.col("bot")).select("user")
    pred = s.filter((F.col("split") == "test") & (F.col("prediction") >= 0.5)).select("user")
    merged = BloomFilter.build(truth, "user", spec).merge(BloomFilter.build(pred, "user", spec))
    return merged.positions()


@register("bloom_roundtrip", with_ctes("select pos from bits", extra=_FILTER))
def q_bloom_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bloom")
    blacklist_filter(spark, sf_dir).save(path)
    return BloomFilter.load(spark, path).positions()


_GROWN = [
    _SPLIT, _TRUTH, _PRED, _KEYS,
    ("spec0", spec_sql("truth", P_BLACKLIST)),
    ("grown", "select greatest((select count(*) from keys), 2 * (select n from spec0)) as n"),
    ("spec", f"select n, m, cast(ceil(m / n * ln(2)) as bigint) as kk from (select n, "
             f"cast(ceil(-(n * ln({P_BLACKLIST!r})) / (ln(2) * ln(2))) as bigint) as m from grown)"),
    _BITS,
]


@register("bloom_rebuild", with_ctes("""
select n as expected_items, 0.1::DOUBLE as false_positive_rate, m as size, kk as hash_count,
       (select count(*) from bits) as bits_set,
       (select count(*) from keys k where k."user" in (select "user" from mem)) as keys_found,
       (select count(*) from keys) as keys_total
from spec""", extra=_GROWN + [("mem", members_sql("keys", _U, "bits", "spec"))]))
def q_bloom_rebuild(spark, sf_dir):
    """Start sized for the labelled bots, then rebuild from the stored key table
    once the predicted users push the key count past n (no false negatives,
    unlike appending zero bits)."""
    s = split_edits(spark, sf_dir)
    truth = s.filter((F.col("split") == "train") & F.col("bot")).select("user")
    first = BloomFilter.build(truth, "user", false_positive_rate=P_BLACKLIST)
    keys = materialize(blacklist_users(spark, sf_dir), "blacklist_keys")
    total = keys.count()
    spec = first.spec.grown(total) if total > first.spec.n else first.spec
    rebuilt = BloomFilter.build(keys, "user", spec)
    found = rebuilt.members(keys, "user").count()
    return rebuilt.stats().withColumns({"keys_found": F.lit(found).cast("bigint"),
                                        "keys_total": F.lit(total).cast("bigint")})


# -- growing series ---------------------------------------------------------------------
# Users arrive in batches, each about twice the one before; every batch outgrows the last slice.
_BATCHES = ((0, 1), (1, 3), (3, 7), (7, 15))
_SERIES_FIRST = 1


def _series_sql() -> list[tuple[str, str]]:
    ctes = []
    for i, (low, high) in enumerate(_BATCHES):
        batch = f"(select distinct {_U} from clean where {_U} is not null and {hash_bucket_sql(_U, 15)} between {low} and {high - 1})"
        seen = " union ".join(f"({members_sql(f'batch{i}', _U, f'bits{j}', f'spec{j}')})" for j in range(i))
        p = P_BLACKLIST / 2 ** (i + 1)
        ctes += [
            (f"batch{i}", f"select * from {batch}"),
            (f"new{i}", f"select {_U} from batch{i}" + (f" where {_U} not in (select {_U} from ({seen}))" if seen else "")),
            (f"cap{i}", f"select greatest((select count(*) from new{i}), {f'(select 2 * n from cap{i - 1})' if i else _SERIES_FIRST}) as n"),
            (f"spec{i}", f"select n, m, cast(ceil(m / n * ln(2)) as bigint) as kk from (select n, "
                         f"cast(ceil(-(n * ln({p!r})) / (ln(2) * ln(2))) as bigint) as m from cap{i})"),
            (f"bits{i}", f"select distinct pos from ({positions_sql(f'new{i}', _U, f'spec{i}')})"),
        ]
    return ctes


def user_series(spark, sf_dir) -> BloomSeries:
    users = clean_edits(edits(spark, sf_dir)).select("user").where(F.col("user").isNotNull())
    series = BloomSeries(_SERIES_FIRST, P_BLACKLIST)
    for low, high in _BATCHES:
        series = series.add(users.where(hash_bucket(F.col("user"), 15).between(low, high - 1)), "user")
    return series


@register("bloom_series", with_ctes(" union all ".join(
    f"select {i}::INT as slice, n as expected_items, {P_BLACKLIST / 2 ** (i + 1)!r}::DOUBLE as false_positive_rate, m as size, "
    f"kk as hash_count, (select count(*) from bits{i}) as bits_set, (select count(*) from new{i}) as n_keys from spec{i}"
    for i in range(len(_BATCHES))), extra=_series_sql(), materialized=True))
def q_bloom_series(spark, sf_dir):
    """Slices of a filter that users are added to in four growing batches."""
    return user_series(spark, sf_dir).stats(spark)


@register("bloom_series_probe", with_ctes("select distinct key from (" + " union ".join(
    f"({members_sql('probes', 'key', f'bits{i}', f'spec{i}')})" for i in range(len(_BATCHES))) + ")", extra=[
        *_series_sql(), ("probes", f"select {_U} as key from clean union select c_name from customer")], materialized=True))
def q_bloom_series_probe(spark, sf_dir):
    """All users, and the customer names that the series takes for users."""
    users = clean_edits(edits(spark, sf_dir)).select(F.col("user").alias("key"))
    probes = users.union(table(spark, sf_dir, "customer").select("c_name"))
    return user_series(spark, sf_dir).members(probes, "key")


@register("bloom_sketch_sizing", with_ctes(f"""
select count(distinct {_U}) as n_users, true as within_2_percent, true as merged_alike from clean"""))
def q_bloom_sketch_sizing(spark, sf_dir):
    """The exact number of users beside a sketch's estimate: of all at once, and of a sketch for each wiki, merged."""
    rows = clean_edits(edits(spark, sf_dir)).select("user", "wiki")
    parts = rows.where(F.col("user").isNotNull()).groupBy("wiki").agg(
        F.hll_sketch_agg("user", F.lit(14)).alias("sketch"))
    whole = sketched_spec(key_sketch(rows, "user"), P_BLACKLIST).n / 1.02
    merged = sketched_spec(joined_sketches(parts), P_BLACKLIST).n / 1.02
    exact = F.count_distinct("user")
    close = lambda n: F.abs(F.lit(n) - exact) <= 0.02 * exact + 1
    return rows.agg(exact.alias("n_users"), close(whole).alias("within_2_percent"), close(merged).alias("merged_alike"))
