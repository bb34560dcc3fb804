"""Logistic regression whose fit any SQL engine can repeat: proximal gradient with fixed steps.

Features of a row: its tokens' md5 values folded into ``num_features`` buckets,
counted, weighted by inverse document frequency and scaled to length one; whether
the edit is minor; ln(1 + length) / 16, at most 1; and a constant. ``STEPS``
accelerated proximal gradient steps are taken from zero, with the elastic net's
soft threshold. Each feature has a fixed step width of its own, 1 / d with

    d = 1/4 mean(x_b |x|_1) + the quadratic penalty,

the diagonal that bounds the loss's curvature on the rows learnt from, found by
one aggregate before the first step. Nothing is drawn at random and nothing
depends on partitions.

One aggregate a step. Rows lie written and cached as bucket arrays; a task turns a
block of rows into a matrix and adds up the gradients of *all* models of a
selection at once (numpy), a model's fold being a mask on the rows; the sums of
all tasks, features x models numbers, are the only thing that is shuffled and the
only thing the driver sees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.functions.hashing import hash_bucket, md5_u32
from edgefilter.operators import model as M
from edgefilter.session import materialize

STEPS = 30
LENGTH_SCALE = 16.0
#: Features beside the buckets: minor, length, the constant.
MORE = 3
#: Cells of a block of rows as a matrix.
_CELLS = 1 << 21


@dataclass(frozen=True)
class Setting:
    """Hyper-parameters of one model, and the fold that it doesn't learn from (-1: it learns from all)."""
    num_features: int = M.NUM_FEATURES
    reg_param: float = 0.0
    elastic_net: float = 0.0
    fold: int = -1


@dataclass
class Linear:
    """A fitted model: the weights of its buckets, of minor, length and the constant, and the buckets' idf."""
    setting: Setting
    idf: np.ndarray
    weights: np.ndarray


# -- rows -----------------------------------------------------------------
def fold_column(key, folds: int = M.FOLDS):
    """Fold of a row by md5 of its key (another part than the train/test split's)."""
    return F.pmod(md5_u32(key, 1), F.lit(folds)).cast("int")


def hashed_rows(clean: DataFrame, keep: list[str], folds: int = M.FOLDS) -> DataFrame:
    """``keep`` and h (md5 values of the tokens, repeats included), minor, length, fold of cleaned edits."""
    rows = M.remove_stop_words(M.tokens(clean))
    return rows.select(*keep, F.transform("tokens", lambda t: md5_u32(t)).alias("h"),
                       F.col("minor").cast("double").alias("minor_feature"),
                       F.least(F.log1p(F.col("comment_length")) / LENGTH_SCALE, F.lit(1.0)).alias("length_feature"),
                       fold_column(F.col("id"), folds).alias("fold"))


def _counts(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """Rows x buckets: how often each bucket's tokens are in a row."""
    lists, n = batch.column("h"), batch.num_rows
    row = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False))
    bucket = lists.flatten().to_numpy(zero_copy_only=False) % k
    return np.bincount(row * k + bucket, minlength=n * k).reshape(n, k).astype(float)


def _more(batch: pa.RecordBatch) -> np.ndarray:
    """Minor, length, 1 of each row."""
    return np.column_stack([*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("minor_feature", "length_feature")),
                            np.ones(batch.num_rows)])


def _matrix(batch: pa.RecordBatch, idf: np.ndarray) -> np.ndarray:
    """Rows as a dense matrix: scaled bucket weights, minor, length, 1."""
    x = _counts(batch, len(idf)) * idf
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x /= np.where(size > 0, size, 1.0)
    return np.column_stack([x, _more(batch)])


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, _CELLS // width)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


# -- inverse document frequencies -----------------------------------------
def document_frequencies(rows: DataFrame, sizes: list[int], folds: list[int]) -> dict[tuple[int, int], np.ndarray]:
    """(num_features, fold left out) -> idf of each bucket, ln((n + 1) / (df + 1)) to six digits; one aggregate.

    What is collected is a number for each bucket, size and fold.
    """
    def of(size: int):
        buckets = F.transform("h", lambda h: F.pmod(h, F.lit(size)))       # and -1: every row has it
        return F.struct(F.lit(size).alias("size"), F.array_union(buckets, F.array(F.lit(-1).cast("bigint"))).alias("buckets"))

    each = F.array(*map(of, sizes))
    counts = rows.select("fold", F.explode(each).alias("e")).select("fold", "e.size", F.explode("e.buckets").alias("b")).groupBy(
        "size", "b", "fold").agg(F.count("*").alias("n")).collect()
    out = {}
    for size in sizes:
        for left in folds:
            df, total = np.zeros(size), 0
            for r in counts:
                if r["size"] == size and r["fold"] != left:
                    if r["b"] < 0:
                        total += r["n"]
                    else:
                        df[r["b"]] += r["n"]
            out[size, left] = np.array([round(math.log((total + 1) / (d + 1)), 6) for d in df])
    return out


# -- fitting --------------------------------------------------------------
def _sums(points: dict | None, idfs: dict, settings: list[Setting]) -> Callable:
    """Gradient sums of all models over a task's rows; ``points`` are their weights now. Without: sums of x |x|_1."""
    keys = sorted({(s.num_features, s.fold) for s in settings})
    by_size = {size: [key for key in keys if key[0] == size] for size, _ in keys}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for part in _parts(batches, max(by_size)):
            label, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            more = _more(part)
            for size, own in by_size.items():
                # the folds of a size have one matrix of counts; idf and length scale its sides
                tf = _counts(part, size)
                length = np.sqrt((tf * tf) @ np.column_stack([idfs[key] ** 2 for key in own]))
                scale = 1 / np.where(length > 0, length, 1.0)
                at = [np.ones((size + MORE, 1)) if points is None else points[key] for key in own]      # no feature is negative
                sums = tf @ np.column_stack([idfs[key][:, None] * w[:size] for key, w in zip(own, at, strict=True)])
                ends = np.cumsum([w.shape[1] for w in at])
                per_row = []
                for i, (key, w) in enumerate(zip(own, at, strict=True)):
                    r = sums[:, ends[i] - w.shape[1]:ends[i]] * scale[:, i:i + 1] + more @ w[size:]
                    if points is not None:
                        r = 1 / (1 + np.exp(-r)) - label[:, None]
                    r[fold == key[1]] = 0.0
                    per_row.append(r)
                back = tf.T @ np.column_stack([r * scale[:, i:i + 1] for i, r in enumerate(per_row)])
                for i, (key, r) in enumerate(zip(own, per_row, strict=True)):
                    g = np.vstack([idfs[key][:, None] * back[:, ends[i] - r.shape[1]:ends[i]], more.T @ r])
                    total[key] = total.get(key, 0.0) + g
        for key, out in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(out), pa.int32()), pa.array([key[1]] * len(out), pa.int32()),
                 pa.array(range(len(out)), pa.int32()), pa.array(out.tolist(), pa.list_(pa.float64()))],
                ["size", "left", "k", "g"])
    return run


def _total(rows: DataFrame, points: dict | None, idfs: dict, settings: list[Setting], like: dict) -> dict:
    """The sums of :func:`_sums` over all rows, features x models numbers."""
    sums = rows.mapInArrow(_sums(points, idfs, settings), "size int, left int, k int, g array<double>").select(
        "size", "left", "k", F.posexplode("g").alias("m", "v")).groupBy("size", "left", "k", "m").agg(F.sum("v").alias("v"))
    out = {key: np.zeros_like(x) for key, x in like.items()}
    for size, left, k, m, v in sums.collect():
        out[size, left][k, m] = v
    return out


def fit_all(rows: DataFrame, settings: list[Setting], steps: int = STEPS) -> list[Linear]:
    """All models of ``settings`` on (label, fold, h, minor_feature, length_feature), together."""
    cached = rows.select("label", "fold", "h", "minor_feature", "length_feature").persist()
    try:
        keys = sorted({(s.num_features, s.fold) for s in settings})
        idfs = {key: idf for key, idf in document_frequencies(
            cached, sorted({k[0] for k in keys}), sorted({k[1] for k in keys})).items() if key in keys}
        own = {key: [i for i, s in enumerate(settings) if (s.num_features, s.fold) == key] for key in keys}
        by_fold = {r["fold"]: r["n"] for r in cached.groupBy("fold").agg(F.count("*").alias("n")).collect()}
        n = {key: sum(c for f, c in by_fold.items() if f != key[1]) for key in keys}
        now = {key: np.zeros((key[0] + MORE, len(own[key]))) for key in keys}
        before = now
        l1, l2 = ({key: np.array([s.reg_param * (s.elastic_net if first else 1 - s.elastic_net) for s in (
            settings[i] for i in own[key])]) for key in keys} for first in (True, False))
        flat = {key: np.zeros((len(x), 1)) for key, x in now.items()}
        bound = _total(cached, None, idfs, settings, flat)
        free, width = {}, {}
        for key in keys:
            free[key] = np.ones_like(flat[key])
            free[key][-1] = 0.0                                                    # the constant is not held down
            d = 0.25 * bound[key] / max(1, n[key]) + l2[key] * free[key]
            width[key] = np.divide(1.0, d, out=np.zeros_like(d), where=d > 0)
        for t in range(steps):
            points = {key: now[key] + t / (t + 3) * (now[key] - before[key]) for key in keys}
            gradient = _total(cached, points, idfs, settings, now)
            before, after = now, {}
            for key in keys:
                y, held = points[key], free[key] * width[key]
                z = y - width[key] * gradient[key] / max(1, n[key]) - held * l2[key] * y
                after[key] = np.sign(z) * np.maximum(np.abs(z) - held * l1[key], 0.0)
            now = after
        return [Linear(s, idfs[s.num_features, s.fold],
                       now[s.num_features, s.fold][:, own[s.num_features, s.fold].index(i)]) for i, s in enumerate(settings)]
    finally:
        cached.unpersist()


def fit(clean: DataFrame, setting: Setting = Setting()) -> Linear:
    """One model of the labelled, cleaned edits ``clean``."""
    return fit_all(materialize(hashed_rows(clean, ["label"]), "linear_rows"), [setting])[0]


# -- scoring --------------------------------------------------------------
def score(model: Linear, clean: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of cleaned edits with ``p_bot`` and ``prediction`` (1.0 above one half)."""
    rows = hashed_rows(clean, keep)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("p_bot", T.DoubleType()),
                           T.StructField("prediction", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, len(model.weights)):
            p = 1 / (1 + np.exp(-(_matrix(part, model.idf) @ model.weights)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(p),
                                              pa.array((p > M.THRESHOLD).astype(float))], schema.names)

    return rows.mapInArrow(run, schema)


def weights_table(spark, model: Linear) -> DataFrame:
    """(feature, weight): buckets, then minor, length and the constant."""
    return spark.createDataFrame(list(enumerate(model.weights.tolist())), "feature int, weight double")


def save(spark, model: Linear, path: str) -> None:
    """One JSON line in a folder, replacing what is there."""
    line = json.dumps({"setting": asdict(model.setting), "idf": model.idf.tolist(), "weights": model.weights.tolist()})
    spark.createDataFrame([(line,)], "value string").write.mode("overwrite").text(path)


def load(spark, path: str) -> Linear:
    told = json.loads(spark.read.text(path).first()["value"])
    return Linear(Setting(**told["setting"]), np.array(told["idf"]), np.array(told["weights"]))


# -- selection ------------------------------------------------------------
def grid_settings(num_features=M.GRID_NUM_FEATURES, reg_param=M.GRID_REG_PARAM, elastic_net=M.GRID_ELASTIC_NET,
                  folds: int = M.FOLDS) -> list[Setting]:
    return [Setting(n, r, e, f) for n in num_features for r in reg_param for e in elastic_net for f in range(folds)]


def confusion(rows: DataFrame, models: list[Linear]) -> DataFrame:
    """(num_features, reg_param, elastic_net, fold, label, prediction, n) of every model on the fold it did not see."""
    groups: dict[tuple[int, int], list[Linear]] = {}
    for m in models:
        groups.setdefault((m.setting.num_features, m.setting.fold), []).append(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, int] = {}
        for part in _parts(batches, max(k[0] for k in groups)):
            label, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            for (_, left), own in groups.items():
                here = fold == left
                if not here.any():
                    continue
                x = _matrix(part.filter(pa.array(here)), own[0].idf)
                said = (1 / (1 + np.exp(-(x @ np.column_stack([m.weights for m in own])))) > M.THRESHOLD).astype(float)
                for j, m in enumerate(own):
                    s = m.setting
                    for pair, c in zip(*np.unique(np.column_stack([label[here], said[:, j]]), axis=0, return_counts=True),
                                       strict=True):
                        key = (s.num_features, s.reg_param, s.elastic_net, s.fold, *pair.tolist())
                        found[key] = found.get(key, 0) + int(c)
        if found:
            cols = list(zip(*((*k, n) for k, n in found.items()), strict=True))
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
            names = ["num_features", "reg_param", "elastic_net", "fold", "label", "prediction", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    parts = rows.select("label", "fold", "h", "minor_feature", "length_feature").mapInArrow(
        run, "num_features int, reg_param double, elastic_net double, fold int, label double, prediction double, n long")
    return parts.groupBy(*parts.columns[:-1]).agg(F.sum("n").alias("n"))


def weighted_f1(cells: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and f1 (class-weighted; a class never predicted counts 0) from (label, prediction, n) rows."""
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    label, said = F.col("label"), F.col("prediction")
    wide = cells.groupBy(*by).agg(F.sum("n").alias("all"), *(x for c in (0, 1) for x in (
        count(label == c).alias(f"of{c}"), count(said == c).alias(f"said{c}"), count((label == c) & (said == c)).alias(f"hit{c}"))))
    f1 = sum(F.col(f"of{c}") * F.coalesce(F.try_divide(2 * F.col(f"hit{c}"), F.col(f"of{c}") + F.col(f"said{c}")), F.lit(0.0))
             for c in (0, 1)) / F.col("all")
    return wide.select(*by, f1.alias("f1"))


def select_model(clean: DataFrame, settings: list[Setting] | None = None) -> DataFrame:
    """(num_features, reg_param, elastic_net, f1, best): mean F1 over the folds; ties: the first in grid order."""
    rows = materialize(hashed_rows(clean, ["label"]), "linear_rows")
    point = ["num_features", "reg_param", "elastic_net"]
    models = fit_all(rows, settings or grid_settings())
    means = materialize(weighted_f1(confusion(rows, models), [*point, "fold"]).groupBy(*point).agg(
        F.round(F.avg("f1"), 6).alias("f1")), "grid")
    top = means.orderBy(F.desc("f1"), *point).limit(1).select(*point, F.lit(True).alias("best"))
    return means.join(F.broadcast(top), point, "left").withColumn("best", F.coalesce("best", F.lit(False)))


# -- the same as DuckDB text ----------------------------------------------
def fit_sql(settings: list[Setting], steps: int = STEPS) -> list[tuple[str, str]]:
    """CTEs (name, body) over ``train`` (id, label, fold, minor, comment_length, tokens) up to ``w{steps}``.

    ``feat`` holds (size, left, id, label, fold, b, x); ``w{t}`` (size, left, m, b, w, prev). To be materialised.
    """
    from edgefilter.functions.hashing import md5_u32_sql
    keys = sorted({(s.num_features, s.fold) for s in settings})
    own = [(s.num_features, s.fold, [i for i, o in enumerate(settings) if (o.num_features, o.fold) == (
        s.num_features, s.fold)].index(k), s.reg_param, s.elastic_net) for k, s in enumerate(settings)]
    values = ", ".join(f"({a}, {b}, {c}, {d!r}::DOUBLE, {e!r}::DOUBLE)" for a, b, c, d, e in own)
    ctes = [
        ("sizes", f"select * from (values {', '.join(f'({a}, {b})' for a, b in keys)}) v(size, lft)"),
        ("hyper", f"select * from (values {values}) v(size, lft, m, reg, en)"),
        ("terms", f"select id, fold, {md5_u32_sql('term')} as h, count(*) as tf from "
                  "(select id, fold, unnest(tokens) as term from train) group by all"),
        ("buckets", "select s.size, t.id, t.fold, t.h % s.size as b, sum(t.tf)::DOUBLE as tf "
                    "from terms t cross join (select distinct size from sizes) s group by all"),
        ("folds", "select s.size, s.lft, count(*) as n from train t join sizes s on t.fold <> s.lft group by all"),
        ("idf", "select b.size, s.lft, b.b, round(ln((max(f.n) + 1) / (count(*) + 1)), 6) as idf from buckets b "
                "join sizes s on s.size = b.size and b.fold <> s.lft join folds f on f.size = s.size and f.lft = s.lft "
                "group by all"),
        # a bucket without documents in the learning folds has df 0
        ("cells", "select s.size, s.lft, b.id, b.b, b.tf * coalesce(i.idf, round(ln(f.n + 1), 6)) as x "
                  "from buckets b join sizes s on s.size = b.size "
                  "join folds f on f.size = s.size and f.lft = s.lft "
                  "left join idf i on i.size = b.size and i.lft = s.lft and i.b = b.b"),
        ("lengths", "select size, lft, id, sqrt(sum(x * x)) as d from cells group by all"),
        ("feat", "select c.size, c.lft, c.id, c.b, case when d > 0 then x / d else 0.0 end as x from cells c "
                 "join lengths l on l.size = c.size and l.lft = c.lft and l.id = c.id "
                 "union all select size, lft, id, size, minor::INT::DOUBLE from train, sizes "
                 f"union all select size, lft, id, size + 1, least(ln(1 + comment_length) / {LENGTH_SCALE}, 1.0) from train, sizes "
                 "union all select size, lft, id, size + 2, 1.0 from train, sizes"),
        ("curve", "select f.size, f.lft, f.b, 0.25 * sum(f.x * l.s) / max(o.n) as d from feat f join (select size, lft, id, sum(x) as s "
                  "from feat group by all) l using (size, lft, id) join train t using (id) join folds o on o.size = f.size "
                  "and o.lft = f.lft where t.fold <> f.lft group by all"),
        ("w0", f"select size, lft, m, unnest(range(size + {MORE})) as b, 0.0::DOUBLE as w, 0.0::DOUBLE as prev from hyper"),
    ]
    for t in range(steps):
        ctes += [
            (f"y{t}", f"select size, lft, m, b, w, w + {t / (t + 3)!r}::DOUBLE * (w - prev) as y from w{t}"),
            (f"r{t}", "select s.size, s.lft, s.m, s.id, 1 / (1 + exp(-s.z)) - t.label as r from (select f.size, f.lft, y.m, f.id, "
                      f"sum(f.x * y.y) as z from feat f join y{t} y on y.size = f.size and y.lft = f.lft and y.b = f.b "
                      "group by all) s join train t on t.id = s.id where t.fold <> s.lft"),
            (f"g{t}", "select f.size, f.lft, r.m, f.b, sum(f.x * r.r) as g from feat f "
                      f"join r{t} r on r.size = f.size and r.lft = f.lft and r.id = f.id group by all"),
            (f"w{t + 1}", f"""
select size, lft, m, b, sign(z) * greatest(abs(z) - reg * en * free * step, 0.0) as w, w as prev from (
  select *, y - step * (g / n + reg * (1 - en) * y * free) as z from (
    select y.size, y.lft, y.m, y.b, y.w, y.y, reg, en, free, n, coalesce(g.g, 0) as g,
           case when coalesce(d, 0) + reg * (1 - en) * free > 0 then 1 / (coalesce(d, 0) + reg * (1 - en) * free) else 0 end as step
    from (select *, case when b = size + 2 then 0 else 1 end as free from y{t}) y
    join hyper h on h.size = y.size and h.lft = y.lft and h.m = y.m
    join folds f on f.size = y.size and f.lft = y.lft
    left join curve c on c.size = y.size and c.lft = y.lft and c.b = y.b
    left join g{t} g on g.size = y.size and g.lft = y.lft and g.m = y.m and g.b = y.b))"""),
        ]
    return ctes


def score_sql(source: str, steps: int = STEPS) -> list[tuple[str, str]]:
    """CTEs up to ``scored`` (id, p) of the rows of ``source`` by the one model of :func:`fit_sql`."""
    from edgefilter.functions.hashing import md5_u32_sql
    size, lft = Setting().num_features, Setting().fold
    one = f"size = {size} and lft = {lft}"
    return [
        ("s_cells", f"""
select id, t.b, tf * coalesce(i.idf, (select round(ln(n + 1), 6) from folds where {one})) as x from (
  select id, {md5_u32_sql('term')} % {size} as b, count(*)::DOUBLE as tf
  from (select id, unnest(tokens) as term from {source}) group by all) t
left join (select * from idf where {one}) i on i.b = t.b"""),
        ("scored", f"""
select e.id, 1 / (1 + exp(-(coalesce(c.z, 0.0) + e.minor::INT * k.w0 + least(ln(1 + e.comment_length) / {LENGTH_SCALE}, 1.0) * k.w1
  + k.w2))) as p
from {source} e cross join (select max(w) filter (b = {size}) as w0, max(w) filter (b = {size + 1}) as w1,
  max(w) filter (b = {size + 2}) as w2 from w{steps} where {one} and m = 0) k
left join (select c.id, case when max(l.d) > 0 then sum(c.x * w.w) / max(l.d) else 0.0 end as z
  from s_cells c join (select id, sqrt(sum(x * x)) as d from s_cells group by id) l on l.id = c.id
  join (select * from w{steps} where {one} and m = 0) w on w.b = c.b group by c.id) c on c.id = e.id"""),
    ]
