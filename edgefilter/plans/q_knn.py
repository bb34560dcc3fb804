"""Nearest-neighbour queries over ``embeddings`` (SURVEY 2.3 J3/J4, 2.4 A11,
2.6 K1, 2.7 U3, 2.9 L6-L8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgefilter.functions.hashing import hash_bucket_sql, md5_u32_sql
from edgefilter.operators import knn
from edgefilter.operators.knn_join import knn_join
from edgefilter.plans.registry import register
from edgefilter.sources.tables import table

K = 250
QUERY_PERCENT = 10
MAX_QUERIES = 50
DIM = 64
SEED = 42
# The original tuning grid and its transferred parameters.
GRID_TABLES = (1, 3, 5)
GRID_LENGTHS = (0.5, 1.0, 2.0)
TRANSFER = (3, 0.5)
# Extension of the grid to bucket lengths that actually change selectivity.
FINE_LENGTHS = (0.05, 0.1, 0.2)


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def queries_of(spark, sf_dir):
    return knn.query_set(vectors(spark, sf_dir), "vec_id", "embedding", QUERY_PERCENT, MAX_QUERIES)


# -- DuckDB text ----------------------------------------------------------

def dist_sql(a: str, b: str, dim: int = DIM) -> str:
    return (f"sqrt(list_reduce(list_transform(range(1, {dim + 1}), lambda i: "
            f"({a}[i]::DOUBLE - {b}[i]::DOUBLE) * ({a}[i]::DOUBLE - {b}[i]::DOUBLE)), "
            f"lambda x, y: x + y))")


def dot_sql(v: str, r: list[float], dim: int = DIM) -> str:
    lit = "[" + ", ".join(repr(float(x)) for x in r) + "]::DOUBLE[]"
    return f"list_reduce(list_transform(range(1, {dim + 1}), lambda i: {v}[i]::DOUBLE * ({lit})[i]), lambda x, y: x + y)"


def hash_sql(v: str, r: list[float], b: float, dim: int = DIM) -> str:
    return f"floor({dot_sql(v, r, dim)} / {float(b)!r})::BIGINT"


def base_sql(source: str = "embeddings", dim: int = DIM, percent: int = QUERY_PERCENT, most: int = MAX_QUERIES,
             k: int = K) -> str:
    return f"""
data as materialized (select vec_id, embedding from {source} src),
n as (select count(*) as n from data),
q as (select vec_id as q_id, embedding as q_vec from data
      where {hash_bucket_sql('vec_id', 100)} < {percent}
      order by {md5_u32_sql('vec_id')}, vec_id limit {most}),
exact as (select q_id, vec_id, dist, rank from (
      select q_id, vec_id, dist, row_number() over (partition by q_id order by dist, vec_id) as rank
      from (select q_id, vec_id, {dist_sql('embedding', 'q_vec', dim)} as dist
            from data, q where vec_id <> q_id)) where rank <= {k})"""


def _cand_sql(b: float, t_max: int, dim: int = DIM) -> str:
    projs = knn.projections(dim, t_max, SEED)
    dh = "[" + ", ".join(hash_sql("embedding", r, b, dim) for r in projs) + "]"
    qh = "[" + ", ".join(hash_sql("q_vec", r, b, dim) for r in projs) + "]"
    return f"""select q_id, vec_id, {float(b)!r}::DOUBLE as bucket_length, dist,
       list_position(list_transform(range(1, {t_max + 1}), lambda i: h[i] = qh[i]), true) - 1 as first_table
from (select vec_id, embedding, {dh} as h from data) d,
     (select q_id, q_vec, {qh} as qh from q) qq
cross join lateral (select {dist_sql('embedding', 'q_vec', dim)} as dist)
where vec_id <> q_id"""


def grid_sql(tables, lengths, source: str = "embeddings", dim: int = DIM) -> str:
    t_max = max(tables)
    cand = " union all ".join(f"({_cand_sql(b, t_max, dim)})" for b in lengths)
    grid = ", ".join(f"({float(b)!r}::DOUBLE, {int(t)})" for b in lengths for t in tables)
    return f"""with {base_sql(source, dim)},
cand as (select c.*, g.num_hash_tables from ({cand}) c
         join (values {grid}) g(bucket_length, num_hash_tables)
           on g.bucket_length = c.bucket_length
         where c.first_table is not null and c.first_table >= 0 and c.first_table < g.num_hash_tables),
counts as (select bucket_length, num_hash_tables, q_id, count(*) as c from cand group by all),
top as (select * from (select *, row_number() over (partition by bucket_length, num_hash_tables, q_id
                                                    order by dist, vec_id) as r from cand) where r <= {K}),
hits as (select t.bucket_length, t.num_hash_tables, t.q_id, count(*) as hits
         from top t join exact e on e.q_id = t.q_id and e.vec_id = t.vec_id group by all)
select g.num_hash_tables, g.bucket_length, count(*) as n_queries,
       round(avg(coalesce(h.hits, 0) / least({K}, n.n - 1)), 6) as recall,
       round(avg(coalesce(c.c, 0) / (n.n - 1)), 6) as candidate_fraction
from (values {grid}) g(bucket_length, num_hash_tables)
cross join q
left join hits h on h.bucket_length = g.bucket_length and h.num_hash_tables = g.num_hash_tables and h.q_id = q.q_id
left join counts c on c.bucket_length = g.bucket_length and c.num_hash_tables = g.num_hash_tables and c.q_id = q.q_id
cross join n
group by g.num_hash_tables, g.bucket_length"""


def lsh_topk_sql(t: int, b: float, source: str = "embeddings", dim: int = DIM, percent: int = QUERY_PERCENT,
                 most: int = MAX_QUERIES) -> str:
    return f"""with {base_sql(source, dim, percent, most)},
cand as ({_cand_sql(b, t, dim)})
select q_id, vec_id, round(dist, 6) as dist, rank from (
  select q_id, vec_id, dist, row_number() over (partition by q_id order by dist, vec_id) as rank
  from cand where first_table is not null and first_table >= 0) where rank <= {K}"""


# -- queries -------------------------------------------------------------------

@register("exact_knn", f"with {base_sql()}\nselect q_id, vec_id, round(dist, 6) as dist, rank from exact")
def q_exact_knn(spark, sf_dir):
    return knn.exact_knn(vectors(spark, sf_dir), queries_of(spark, sf_dir), "vec_id", "embedding", K)


JOIN_K = 10


@register("knn_join", f"""
select q_id, vec_id, round(dist, 6) as dist, rank from (
  select q_id, vec_id, dist, row_number() over (partition by q_id order by dist, vec_id) as rank
  from (select a.vec_id as q_id, b.vec_id, {dist_sql('b.embedding', 'a.embedding')} as dist
        from embeddings a join embeddings b on a.vec_id <> b.vec_id)) where rank <= {JOIN_K}""")
def q_knn_join(spark, sf_dir):
    """The nearest rows of every row."""
    v = vectors(spark, sf_dir)
    return knn_join(v, v.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_vec")), "vec_id", "embedding", JOIN_K)


@register("lsh_bucket_topk", lsh_topk_sql(*TRANSFER))
def q_lsh_bucket_topk(spark, sf_dir):
    projs = knn.projections(DIM, TRANSFER[0], SEED)
    return knn.lsh_topk(vectors(spark, sf_dir), queries_of(spark, sf_dir), "vec_id", "embedding",
                        K, projs, TRANSFER[1])


@register("recall_at_k", grid_sql((TRANSFER[0],), (TRANSFER[1],)))
def q_recall_at_k(spark, sf_dir):
    return knn.recall_at_k(vectors(spark, sf_dir), "vec_id", "embedding", K, TRANSFER[0], TRANSFER[1],
                           percent=QUERY_PERCENT, max_queries=MAX_QUERIES, seed=SEED, dim=DIM)


@register("lsh_grid", grid_sql(GRID_TABLES, GRID_LENGTHS))
def q_lsh_grid(spark, sf_dir):
    return knn.lsh_grid(vectors(spark, sf_dir), "vec_id", "embedding", K, GRID_TABLES, GRID_LENGTHS,
                        QUERY_PERCENT, MAX_QUERIES, SEED, dim=DIM)


@register("lsh_grid_fine", grid_sql(GRID_TABLES, FINE_LENGTHS))
def q_lsh_grid_fine(spark, sf_dir):
    return knn.lsh_grid(vectors(spark, sf_dir), "vec_id", "embedding", K, GRID_TABLES, FINE_LENGTHS,
                        QUERY_PERCENT, MAX_QUERIES, SEED, dim=DIM)


@register("normalize_vectors", """
select vec_id, list_transform(embedding, lambda x: round(x::DOUBLE / nrm, 6)) as normalized
from (select vec_id, embedding,
             sqrt(list_reduce(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE),
                              lambda a, b: a + b)) as nrm
      from embeddings)""")
def q_normalize_vectors(spark, sf_dir):
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = vectors(spark, sf_dir).select("vec_id", array_to_vector("embedding").alias("v"))
    out = Normalizer(inputCol="v", outputCol="nv", p=2.0).transform(v)
    return out.select("vec_id", F.transform(vector_to_array("nv"), lambda x: F.round(x, 6)).alias("normalized"))


@register("lsh_best_params", f"""
select * from ({grid_sql(GRID_TABLES, GRID_LENGTHS)})
order by recall desc, num_hash_tables, bucket_length limit 1""")
def q_lsh_best_params(spark, sf_dir):
    """Best grid point; ties keep the first in grid order (tables, then length)."""
    grid = knn.lsh_grid(vectors(spark, sf_dir), "vec_id", "embedding", K, GRID_TABLES, GRID_LENGTHS,
                        QUERY_PERCENT, MAX_QUERIES, SEED, dim=DIM)
    return knn.best_grid_point(grid)
