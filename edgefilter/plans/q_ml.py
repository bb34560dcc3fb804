"""Similar-name search.

Names become vectors by random indexing (`operators/name_vectors.py`); hashes,
neighbours and recall are those of the bucketed random projections in
`operators/knn.py`, and DuckDB states all values. Spark ML's Word2Vec, whose
vocabulary lies on the driver, is an option (`operators/ml_lsh.py`); it draws
from Spark's own random generator, so `word2vec_names` returns what holds for
any draw."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from edgefilter.functions.text import WORD_PATTERN
from edgefilter.operators import knn
from edgefilter.operators import ml_lsh as ML
from edgefilter.operators import multiprobe as MP
from edgefilter.operators import name_vectors as NV
from edgefilter.operators import word_vectors as WV
from edgefilter.plans.q_knn import base_sql, dist_sql, dot_sql, grid_sql, hash_sql, lsh_topk_sql
from edgefilter.plans.q_sources import ARTICLE_SQL as _ARTICLE_SQL
from edgefilter.plans.registry import register
from edgefilter.session import materialize, scratch_path
from edgefilter.sources import files as FS
from edgefilter.sources.tables import table

K = 250
SEED = 42
TRANSFER = (3, 0.5)
# The original tuning grid.
GRID_TABLES = (1, 3, 5)
GRID_LENGTHS = (0.5, 1.0, 2.0)
SIMILAR_N = 6


#: Listing names: the first three words of a document, so that distinct names grow with the data.
NAME_RE = r"^(\S+ \S+ \S+)"
_NAMES = f"(select distinct regexp_extract(text, '{NAME_RE}', 1) as name from documents where regexp_extract(text, '{NAME_RE}', 1) <> '')"
_ARTICLES = f"(select distinct lower(replace({_ARTICLE_SQL}, '_', ' ')) as name from pages where lower(replace({_ARTICLE_SQL}, '_', ' ')) <> '')"
QUERY_PERCENT, MAX_QUERIES = 10, 50


_PROJECTIONS = knn.projections(NV.DIM, TRANSFER[0], SEED)


def listing_names(spark, sf_dir):
    """Distinct listing names."""
    name = F.regexp_extract("text", NAME_RE, 1)
    return table(spark, sf_dir, "documents").select(name.alias("name")).filter("name <> ''").distinct()


def article_names(spark, sf_dir):
    path = scratch_path(spark, "pageviews")
    FS.write_pageviews_json(table(spark, sf_dir, "pages"), path)
    return FS.normalize_article_names(FS.read_pageviews(spark, path))


@register("word2vec_names", f"select name, {ML.VECTOR_SIZE} as n_components, true as unit from {_NAMES}")
def q_word2vec_names(spark, sf_dir):
    v = ML.name_vectors(listing_names(spark, sf_dir), SEED).select("name", vector_to_array(ML.VEC).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return v.select("name", F.size("v").alias("n_components"), (F.abs(norm - 1) < 1e-6).alias("unit"))


_NAME_VECTORS, _ARTICLE_VECTORS = (f"(select name as vec_id, vec as embedding from {NV.name_vectors_sql(n)} v)"
                                   for n in (_NAMES, _ARTICLES))


def _vectors(names):
    """Written once: every later pass reads the same vectors."""
    return materialize(NV.name_vectors(names), "name_vectors")


@register("name_vectors", f"select vec_id as name, list_transform(embedding, lambda x: round(x, 6)) as vec from {_NAME_VECTORS} s")
def q_name_vectors(spark, sf_dir):
    return NV.name_vectors(listing_names(spark, sf_dir)).select(
        "name", F.transform("vec", lambda x: F.round(x, 6)).alias("vec"))


@register("lsh_hashes", f"""
select vec_id as name, [{', '.join(hash_sql('embedding', r, TRANSFER[1], NV.DIM) for r in _PROJECTIONS)}] as hash_values
from {_NAME_VECTORS} s""")
def q_lsh_hashes(spark, sf_dir):
    hashes = knn.lsh_hash_array(F.col("vec"), _PROJECTIONS, TRANSFER[1])
    return NV.name_vectors(listing_names(spark, sf_dir)).select("name", hashes.alias("hash_values"))


@register("ann_topk", f"select q_id, vec_id as name, dist, rank from ({lsh_topk_sql(*TRANSFER, _NAME_VECTORS, NV.DIM)})")
def q_ann_topk(spark, sf_dir):
    """Each query name's nearest among the names that share a bucket with it: at most K, by distance, then name."""
    v = _vectors(listing_names(spark, sf_dir))
    queries = knn.query_set(v, "name", "vec", QUERY_PERCENT, MAX_QUERIES)
    return knn.lsh_topk(v, queries, "name", "vec", K, _PROJECTIONS, TRANSFER[1])


@register("similar_items", f"""
select name, dist, row_number() over (order by dist, name) as rank from (
  select vec_id as name, dist from ({lsh_topk_sql(*TRANSFER, _ARTICLE_VECTORS, NV.DIM, 100, 1)}) where dist > 0)
order by dist, name limit {SIMILAR_N}""")
def q_similar_items(spark, sf_dir):
    """The nearest articles of one article (the first in hash order), those at distance 0 dropped."""
    v = _vectors(article_names(spark, sf_dir))
    one = knn.query_set(v, "name", "vec", 100, 1)
    near = knn.lsh_topk(v, one, "name", "vec", K, _PROJECTIONS, TRANSFER[1]).where("dist > 0")
    best = near.orderBy("dist", "name").limit(SIMILAR_N)
    return best.select("name", "dist", F.row_number().over(Window.orderBy("dist", "name")).alias("rank"))


@register("lsh_tune_names", grid_sql(GRID_TABLES, GRID_LENGTHS, _NAME_VECTORS, NV.DIM))
def q_lsh_tune_names(spark, sf_dir):
    """Recall and share of candidates of every grid point over the listing names, all in one pass."""
    return knn.lsh_grid(_vectors(listing_names(spark, sf_dir)), "name", "vec", K, GRID_TABLES, GRID_LENGTHS,
                        QUERY_PERCENT, MAX_QUERIES, SEED, dim=NV.DIM)


@register("lsh_tune_articles", grid_sql(GRID_TABLES, GRID_LENGTHS, _ARTICLE_VECTORS, NV.DIM))
def q_lsh_tune_articles(spark, sf_dir):
    return knn.lsh_grid(_vectors(article_names(spark, sf_dir)), "name", "vec", K, GRID_TABLES, GRID_LENGTHS,
                        QUERY_PERCENT, MAX_QUERIES, SEED, dim=NV.DIM)


@register("lsh_transfer_eval", grid_sql((TRANSFER[0],), (TRANSFER[1],), _ARTICLE_VECTORS, NV.DIM))
def q_lsh_transfer_eval(spark, sf_dir):
    """The parameters tuned on listings (3 tables, length 0.5) applied to the article names."""
    return knn.recall_at_k(_vectors(article_names(spark, sf_dir)), "name", "vec", K, *TRANSFER, percent=QUERY_PERCENT,
                           max_queries=MAX_QUERIES, seed=SEED, dim=NV.DIM)


_WORDS_SQL = f"regexp_extract_all(lower(text), '{WORD_PATTERN}')"


@register("cooccurrence_ppmi", f"""
with d as (select doc_id, {_WORDS_SQL} as t from documents where text is not null),
p as (select doc_id, unnest(range(1, len(t) + 1)) as i, unnest(t) as w from d),
known as (select w from p group by w having count(*) >= {WV.MIN_COUNT}),
one as (select a.w, b.w as c, count(*) as n from p a join p b on a.doc_id = b.doc_id and b.i > a.i and b.i <= a.i + {WV.WINDOW}
        group by all),
pairs as (select w, c, sum(n)::BIGINT as n from (select w, c, n from one union all select c, w, n from one)
          where w in (select w from known) and c in (select w from known) group by all),
m as (select w, sum(n) as m from pairs group by w)
select p.w, p.c, p.n, round(ln(p.n * (select sum(m) from m)::DOUBLE / (a.m * b.m::DOUBLE)), 6) as ppmi
from pairs p join m a on a.w = p.w join m b on b.w = p.c
where ln(p.n * (select sum(m) from m)::DOUBLE / (a.m * b.m::DOUBLE)) > 0""")
def q_cooccurrence_ppmi(spark, sf_dir):
    """Pairs of frequent words that stand near each other more often than by chance."""
    pairs = WV.pair_counts(table(spark, sf_dir, "documents"), "text", half=True)
    return WV.shifted_ppmi(pairs, half=True).withColumn("ppmi", F.round("ppmi", 6))


PROBE_K, PROBES = 10, (1, 32, 128, 256)
_PROBE_DIRECTIONS = knn.projections(NV.DIM, MP.PROJECTIONS, SEED)


def _probe_sql() -> str:
    """CTEs data, q, exact (the nearest) and met (q_id, vec_id, probe, dist) over the listing names."""
    def place(v):
        return [dot_sql(v, r, NV.DIM) + f" / {MP.WIDTH!r}" for r in _PROBE_DIRECTIONS]

    m = range(MP.PROJECTIONS)
    cost = " + ".join(f"case when s{i} = 0 then 0.0 when s{i} < 0 then (x{i} - floor(x{i})) * (x{i} - floor(x{i})) "
                      f"else (1 - (x{i} - floor(x{i}))) * (1 - (x{i} - floor(x{i}))) end" for i in m)
    return f"""with {base_sql(_NAME_VECTORS, NV.DIM, k=PROBE_K)},
held as materialized (select vec_id, embedding, [{', '.join(f'floor({x})::BIGINT' for x in place('embedding'))}] as bucket from data),
placed as (select q_id, q_vec, {', '.join(f'{x} as x{i}' for i, x in enumerate(place('q_vec')))} from q),
steps as (select combo, {', '.join(f'(combo // {3 ** i}) % 3 - 1 as s{i}' for i in m)} from range({MP.BUCKETS}) r(combo)),
probes as materialized (select q_id, q_vec, bucket, row_number() over (partition by q_id order by cost, combo) as probe from (
  select q_id, q_vec, combo, {cost} as cost, [{', '.join(f'floor(x{i})::BIGINT + s{i}' for i in m)}] as bucket
  from placed, steps)),
met as materialized (select p.q_id, h.vec_id, p.probe, {dist_sql('h.embedding', 'p.q_vec', NV.DIM)} as dist
  from probes p join held h on h.bucket = p.bucket and h.vec_id <> p.q_id where p.probe <= {max(PROBES)})"""


@register("multiprobe_recall", f"""{_probe_sql()}
select n_probes, round(count(*) filter (where probe <= n_probes and near) / (any_value(q) * least({PROBE_K}, any_value(n) - 1)), 6)
  as recall, round(count(*) filter (where probe <= n_probes) / (any_value(q) * (any_value(n) - 1)), 6) as candidate_fraction
from (select m.*, e.q_id is not null as near from met m left join exact e on e.q_id = m.q_id and e.vec_id = m.vec_id),
  (select (select count(*) from data) as n, (select count(*) from q) as q), (values {', '.join(f'({p}::INT)' for p in PROBES)}) t(n_probes)
group by n_probes""")
def q_multiprobe_recall(spark, sf_dir):
    """Recall and share of candidates of one table by the number of buckets a query looks into."""
    v = _vectors(listing_names(spark, sf_dir))
    queries = knn.query_set(v, "name", "vec", QUERY_PERCENT, MAX_QUERIES)
    return MP.recall_by_probes(v, queries, "name", "vec", PROBE_K, _PROBE_DIRECTIONS, list(PROBES))


@register("multiprobe_topk", f"""{_probe_sql()}
select q_id, vec_id as name, round(dist, 6) as dist, rank from (
  select *, row_number() over (partition by q_id order by dist, vec_id) as rank from met where probe <= {PROBES[-2]})
where rank <= {PROBE_K}""")
def q_multiprobe_topk(spark, sf_dir):
    """Each query name's nearest names among the buckets closest to it."""
    v = _vectors(listing_names(spark, sf_dir))
    queries = knn.query_set(v, "name", "vec", QUERY_PERCENT, MAX_QUERIES)
    return MP.search(v, queries, "name", "vec", PROBE_K, _PROBE_DIRECTIONS, PROBES[-2])
