"""Language identification by prediction by partial matching (PPM).

For each language a context tree over the bytes of lower-cased text holds how
often each byte followed each context of up to ``ORDER`` bytes. A byte is coded
in its longest context that the tree has; where that context never saw the
byte, an escape (method C: number of distinct followers over that number plus
all followers) is paid and the context shortened, down to a uniform byte. The
statistics are frozen: a document's code length in a language is the exact sum
over its bytes, whatever came before it. The shortest code names the language.

All languages share one table of n-grams with their log probabilities already
resolved along the escapes, so a byte costs one or two look-ups for all of them.

Defined cases: null text or text without a letter is ``und`` with score 0; so
is every text if there is nothing to learn from. Null ids are predicted but not
learned from, and count as not held out. Equal code lengths: the smaller name.
Repeated rows each come out, other columns are kept by ``predict``, also those
named as its results. Very long texts are scored in parts of SCORE_BYTES, whose
contexts reach into the part before. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import blocks, fresh, hash_share, id_hash_mod, raw_bytes, register, table

ORDER = 4
#: Bound of the labelled sample: about so many documents of each language, those of smallest id hash.
SAMPLE_PER_LANGUAGE = 1000
#: Bound of the model: contexts-with-byte kept for each language and order, the most frequent.
NODES_PER_ORDER = 150_000
#: Bytes that are scored at once.
SCORE_BYTES = 1 << 18
#: Bytes that are counted at once.
COUNT_BYTES = 1 << 20
UNKNOWN = "und"


def _gram_keys(data: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order o the last o+1 bytes up to each place, packed into one number."""
    keys = [data.astype(np.uint64)]
    for o in range(1, order + 1):
        key = np.zeros(len(data), np.uint64)
        if len(data) > o:
            key[o:] = keys[0][o:] | (keys[o - 1][o - 1:-1] << np.uint64(8))
        keys.append(key)
    return keys


class _Lookup:
    """Open-addressing table from packed n-grams to rows of a matrix."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.shift, self.mask, self.values = np.uint64(64 - bits), (1 << bits) - 1, values
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.rows = np.zeros(1 << bits, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[slot[put]], self.rows[slot[put]] = keys[put], put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MULT) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rows[slot], -1)
        todo = np.flatnonzero((held != keys) & (held != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.rows[slot[todo[hit]]]
            todo = todo[~hit & (held != np.uint64(2**64 - 1))]
        return out


@dataclass
class Model:
    """Frozen statistics: resolved log probabilities of n-grams and log escapes of contexts, by order."""

    languages: list[str]
    grams: list[_Lookup]
    escapes: list[_Lookup]

    def score(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code lengths in nats (texts x languages) of texts that lie end to end."""
        order = len(self.grams) - 1
        out = np.zeros((len(ends) - 1, len(self.languages)))
        # a part at a time, with the bytes before it that its contexts reach into
        for start in range(0, len(data), SCORE_BYTES):
            stop = min(len(data), start + SCORE_BYTES)
            before = min(order, start)
            lengths = self._code(data[start - before:stop], ends, start - before)[before:]
            first = int(np.searchsorted(ends, start, "right")) - 1
            last = int(np.searchsorted(ends, stop, "left"))
            begins = np.maximum(ends[first:last], start) - start
            full = np.flatnonzero(np.diff(np.append(begins, stop - start)))
            out[first + full] += np.add.reduceat(lengths, begins[full], axis=0, dtype=np.float64)
        return -out

    def _code(self, data: np.ndarray, ends: np.ndarray, offset: int) -> np.ndarray:
        """Log probabilities (bytes x languages) of a part of the texts that begins at ``offset``."""
        total = np.zeros((len(data), len(self.languages)), np.float32)
        order = len(self.grams) - 1
        place = np.arange(offset, offset + len(data))
        depth = place - ends[np.searchsorted(ends, place, "right") - 1]
        keys = _gram_keys(data, order)
        todo = np.arange(len(data))
        for o in range(order, -1, -1):
            deep = depth[todo] >= o
            at = todo[deep]
            row = self.grams[o].find(keys[o][at])
            hit = row >= 0
            total[at[hit]] += self.grams[o].values[row[hit]]
            missed = at[~hit]
            ctx = self.escapes[o].find(keys[o][missed] >> np.uint64(8))
            known = ctx >= 0
            total[missed[known]] += self.escapes[o].values[ctx[known]]
            todo = np.concatenate([todo[~deep], missed])
        total[todo] += np.float32(-np.log(256))
        return total


def build(counts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], languages: list[str], order: int) -> Model:
    """The model of ``counts[(order, language)] = (sorted n-grams, how often)``."""
    n_lang = len(languages)
    grams: list[_Lookup] = []
    escapes: list[_Lookup] = []
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def lower(o: int, keys: np.ndarray) -> np.ndarray:
        """Log probabilities along the escapes, from order ``o`` down."""
        if o < 0:
            return np.full((len(keys), n_lang), -np.log(256), np.float32)
        row = grams[o].find(keys)
        out = np.zeros((len(keys), n_lang), np.float32)
        out[row >= 0] = grams[o].values[row[row >= 0]]
        miss = np.flatnonzero(row < 0)
        if len(miss):
            out[miss] = lower(o - 1, keys[miss] & np.uint64((1 << 8 * o) - 1))
            ctx = escapes[o].find(keys[miss] >> np.uint64(8))
            out[miss[ctx >= 0]] += escapes[o].values[ctx[ctx >= 0]]
        return out

    for o in range(order + 1):
        own = [counts.get((o, j), empty) for j in range(n_lang)]
        keys = np.unique(np.concatenate([k for k, _ in own]))
        contexts = np.unique(keys >> np.uint64(8))
        log_p = lower(o - 1, keys & np.uint64((1 << 8 * o) - 1))
        log_e = np.zeros((len(contexts), n_lang), np.float32)
        in_ctx = np.searchsorted(contexts, keys >> np.uint64(8))
        for j, (k, n) in enumerate(own):
            place = np.searchsorted(contexts, k >> np.uint64(8))
            seen = np.bincount(place, weights=n, minlength=len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            with np.errstate(divide="ignore"):
                log_e[:, j] = np.where(kinds > 0, np.log(kinds / np.maximum(seen + kinds, 1)), 0)
            log_p[:, j] += log_e[in_ctx, j]
            log_p[np.searchsorted(keys, k), j] = np.log(n / (seen + kinds)[place])
        grams.append(_Lookup(keys, log_p))
        escapes.append(_Lookup(contexts, log_e))
    return Model(languages, grams, escapes)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        order: int = ORDER, sample: int = SAMPLE_PER_LANGUAGE, nodes: int = NODES_PER_ORDER) -> Model:
    """Count the context trees of a bounded sample of ``labelled`` rows on the executors and freeze them.

    The sample is about ``sample`` documents of each language (all, if it has
    fewer), whole texts: a count by language sets the share of id hashes that
    is taken, so no text is shuffled to choose them. The trees keep the
    ``nodes`` most frequent n-grams of each order and language, so the model's
    size has a bound that the data don't change.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.lower(text_col).cast("binary").alias("text"))
    share = {r["lang"]: sample / r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    taken = F.lit(False)
    for lang, part in sorted(share.items()):
        taken = taken | ((F.col("lang") == lang) & hash_share(F.col("id"), part))
    rows = rows.where(taken).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            for start, stop in blocks(batch, "text"):
                whole, bounds = raw_bytes(batch.column("text").slice(start, stop - start))
                for a in range(0, len(whole), COUNT_BYTES):
                    b, before = min(len(whole), a + COUNT_BYTES), min(order, a)
                    place = np.arange(a - before, b)
                    row = np.searchsorted(bounds, place, "right") - 1
                    depth, owner = place - bounds[row], names[start:stop][row]
                    keys = _gram_keys(whole[a - before:b], order)
                    for lang in sorted(set(owner[before:])):
                        mine = (owner == lang) & (place >= a)
                        for o in range(order + 1):
                            k, n = np.unique(keys[o][mine & (depth >= o)], return_counts=True)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang] * len(k), pa.string()), pa.array(np.full(len(k), o), pa.int32()),
                                 pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "o", "k", "n"])

    spread = rows.repartition("lang", F.pmod(F.xxhash64("text"), F.lit(16)))
    grams = spread.mapInArrow(count, "lang string, o int, k long, n long").groupBy("lang", "o", "k").agg(
        F.sum("n").alias("n"))
    often = Window.partitionBy("lang", "o").orderBy(F.desc("n"), "k")
    got = grams.withColumn("r", F.row_number().over(often)).where(F.col("r") <= nodes).select(
        "lang", "o", "k", "n").toArrow()
    langs = got.column("lang").to_numpy(zero_copy_only=False)
    o, k, n = (got.column(c).to_numpy() for c in ("o", "k", "n"))
    names = sorted(set(langs))
    counts = {}
    for j, name in enumerate(names):
        mine = langs == name
        for level in range(order + 1):
            at = np.flatnonzero(mine & (o == level))
            at = at[np.argsort(k[at])]
            counts[level, j] = k[at].astype(np.uint64), n[at]
    return build(counts, names, order) if names else Model([], [], [])


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score"),
            keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted language and its posterior under equal priors.

    The names of the two give way to columns of that name.
    """
    keep = docs.columns if keep is None else keep
    kept = docs.select(*keep)
    first = fresh(kept, names[0])
    second = fresh(kept.withColumn(first, F.lit(0)), names[1])
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(first, T.StringType()),
                           T.StructField(second, T.DoubleType())])
    text = fresh(docs, "lowered")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keep, F.when(letters, F.lower(text_col).cast("binary")).alias(text))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        labels = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start, stop in blocks(batch, text):
                part = batch.slice(start, stop - start)
                best, sure = np.full(stop - start, len(labels) - 1), np.zeros(stop - start)
                valid = np.flatnonzero(~np.asarray(part.column(at).is_null()))
                if len(valid) and m.languages:
                    data, ends = raw_bytes(part.column(at))
                    cost = m.score(data, ends)[valid]
                    best[valid] = cost.argmin(axis=1)
                    sure[valid] = 1 / np.exp(cost.min(axis=1, keepdims=True) - cost).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(labels[best], pa.string()), pa.array(sure)],
                    [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def fit_on_known(docs: DataFrame) -> Model:
    """The production fit: rows whose crc32(doc_id) modulo 4 is not 2."""
    return fit(docs.where(id_hash_mod("doc_id", 4) != 2))


@register("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = predict(docs, fit_on_known(docs), keep=["doc_id"])
    return got.select("doc_id", F.coalesce(id_hash_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
