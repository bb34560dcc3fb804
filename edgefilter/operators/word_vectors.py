"""Word vectors from co-occurrence: windowed pair counts, shifted PPMI, subspace iteration.

A word's vector is its row of the best low-rank approximation of the matrix of
positive pointwise mutual information, which Word2Vec's loss factorises as well.
The vocabulary, the matrix and the vectors are tables: no list of words is
collected or broadcast.

1. Pairs at most ``window`` words apart. A task counts some ``CHUNK`` words at a
   time, each pair once, and passes on a list a word; a word's lists meet in one
   partition and are added up. Until then a word is a 64-bit hash, with a seed
   by which no two words of the texts share one. Words met fewer than
   ``min_count`` times are left out.
2. ppmi = ln(n_wc N / (n_w n_c)) - ln(shift), where that is positive.
3. Subspace iteration: the basis is a table (word, k columns); a step multiplies
   it by the matrix (one join and one aggregate) and makes it orthonormal again
   by its Gram matrix, k x k numbers, the only thing that the driver sees. The
   singular values are those of the last product.

A null text has no words. Starting columns come from md5 of the word, so results
don't depend on partitions but for the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgefilter.functions.hashing import unit_uniform
from edgefilter.functions.text import raw_words
from edgefilter.session import materialize

WINDOW, MIN_COUNT, SHIFT = 3, 50, 1.0
#: Columns beyond those asked for, which speed convergence up.
SPARE, STEPS = 8, 14
#: Words of which a task counts the pairs before it passes them on.
CHUNK = 1 << 21


def _plain(text: Column) -> Column:
    """Text in which ``_tokens`` finds the words of ``raw_words``: beyond Latin-1, those words joined by a space."""
    return F.when(text.rlike(r"[^\x{0}-\x{FF}]"), F.array_join(raw_words(text), " ")).otherwise(text)


_WORD, _LOWER = np.ones(256, bool), np.arange(256, dtype=np.uint8)
_WORD[:128] = [chr(i).isalnum() or chr(i) == "_" for i in range(128)]
_LOWER[65:91] += 32
#: By the second byte: letters and numbers among U+0080 to U+00BF and U+00C0 to U+00FF, and the latter's small letters.
_WORD_C2 = np.isin(np.arange(256), [0xAA, 0xB2, 0xB3, 0xB5, 0xB9, 0xBA, 0xBC, 0xBD, 0xBE])
_WORD_C3 = ~np.isin(np.arange(256), [0x97, 0xB7])
_LOWER_C3 = np.arange(256, dtype=np.uint8)
_LOWER_C3[0x80:0x9F] += 32 * _WORD_C3[0x80:0x9F].astype(np.uint8)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``_plain`` texts, end to end, and how many each text has."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    word, data = _WORD[raw], _LOWER[raw]
    for lead, is_word, lower in ((0xC2, _WORD_C2, None), (0xC3, _WORD_C3, _LOWER_C3)):
        at = np.flatnonzero(raw == lead)
        word[at] = word[at + 1] = is_word[raw[at + 1]]
        if lower is not None:
            data[at + 1] = lower[raw[at + 1]]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = ends[:-1][np.diff(ends) > 0]
    first[edge] = word[edge]
    place = np.flatnonzero(first)
    begin = np.append(np.flatnonzero(first[word]), np.count_nonzero(word)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(place), pa.py_buffer(begin), pa.py_buffer(data[word]))
    return words, np.diff(np.searchsorted(place, ends))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DictionaryArray, np.ndarray]]:
    """Some ``CHUNK`` words at a time, of whole texts: the words, and how many each text has."""
    held: list[tuple[pa.Array, np.ndarray]] = []
    size = 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            held.append(_tokens(batch.column(0).slice(start, 256)))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield pa.concat_arrays([w for w, _ in held]).dictionary_encode(), np.concatenate([n for _, n in held])
                held, size = [], 0
    if size:
        yield pa.concat_arrays([w for w, _ in held]).dictionary_encode(), np.concatenate([n for _, n in held])


def _ids(words: pa.Array, seed: int) -> np.ndarray:
    return hash_array(words.to_numpy(zero_copy_only=False), hash_key=f"{seed:016d}", categorize=False).view(np.int64)


def _word_counts(seed: int):
    """(id, w, f): the words of texts, counted chunk by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _chunks(batches):
            f = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            yield pa.RecordBatch.from_arrays([pa.array(_ids(words.dictionary, seed)), words.dictionary, pa.array(f, pa.int64())],
                                             ["id", "w", "f"])
    return run


def _lists(key: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """The different values of the sorted ``key``, and the lists of ``other`` and ``n`` of each."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    ends = pa.array(np.append(first, len(key)).astype(np.int32))
    return key[first], pa.ListArray.from_arrays(ends, pa.array(other)), pa.ListArray.from_arrays(ends, pa.array(n))


def _near_counts(window: int, seed: int):
    """(a, b, n): with the lists ``b`` and ``n``, how often words are at most ``window`` places apart, chunk by chunk.

    A pair of words lies in the list of the smaller id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, lengths in _chunks(batches):
            ids = _ids(words.dictionary, seed)
            order = np.argsort(ids)
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            ids, at = ids[order], rank[words.indices.to_numpy()]
            row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            cell = np.concatenate([(np.minimum(at[:-d], at[d:]) * len(ids) + np.maximum(at[:-d], at[d:]))[row[:-d] == row[d:]]
                                   for d in range(1, window + 1)])
            cell.sort()
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
            n = np.diff(np.append(first, len(cell)))
            a, b = np.divmod(cell[first], max(len(ids), 1))
            key, others, counts = _lists(a, ids[b], n)
            out = pa.RecordBatch.from_arrays([pa.array(ids[key]), others, counts], ["a", "b", "n"])
            for start in range(0, len(out), 4096):
                yield out.slice(start, 4096)
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, b, n, same) from lists that come sorted by a, a word's name among them: counts added up, unnamed words left out."""
    names: dict[int, str] = {}
    a, b, n = (np.zeros(0, np.int64) for _ in range(3))

    def settle(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)])
        return a[first], b[first], np.add.reduceat(n[order], first) if len(first) else n

    def out(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, at = np.unique(a, return_inverse=True)
        words = pa.array([names.get(k) for k in key.tolist()], pa.string())
        keep = np.flatnonzero(np.array([k in names for k in key.tolist()], bool)[at])
        for start in range(0, len(keep), 1 << 16):
            part = keep[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(at[part])), pa.array(b[part]), pa.array(n[part]),
                                              pa.array(a[part] == b[part])], ["w", "b", "n", "same"])

    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        key = batch.column("a").to_numpy()
        named = np.flatnonzero(batch.column("w").is_valid().to_numpy(zero_copy_only=False))
        names |= zip(key[named].tolist(), batch.column("w").take(pa.array(named)).to_pylist(), strict=True)
        lists = batch.column("b")
        held.append((np.repeat(key, lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(),
                     batch.column("n").flatten().to_numpy()))
        size += len(held[-1][0])
        if size >= CHUNK:
            a, b, n = settle(*(np.concatenate(x) for x in zip((a, b, n), *held, strict=True)))
            held, size = [], 0
            done = np.searchsorted(a, key[-1])          # the last word may go on
            yield from out(a[:done], b[:done], n[:done])
            a, b, n = a[done:], b[done:], n[done:]
            names = {key[-1]: names[key[-1]]} if key[-1] in names else {}
    if held or len(a):
        yield from out(*settle(*(np.concatenate(x) for x in zip((a, b, n), *held, strict=True))))


def _vocabulary(texts: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """(id, w) of the words met ``min_count`` times or more, and the seed by which no two words share an id."""
    seed = 0
    while True:
        words = materialize(texts.mapInArrow(_word_counts(seed), "id long, w string, f long").groupBy("id", "w").agg(
            F.sum("f").alias("f")), "words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return materialize(words.where(F.col("f") >= min_count).select("id", "w"), "vocabulary"), seed
        seed += 1


def pair_counts(docs: DataFrame, text_col: str, window: int = WINDOW, min_count: int = MIN_COUNT,
                half: bool = False) -> DataFrame:
    """(w, c, n): how often c stands within ``window`` words of w, for words met ``min_count`` times or more.

    The counts are symmetric; with ``half`` a pair of words is one row, in either order, not two.
    """
    texts = docs.where(F.col(text_col).isNotNull()).select(_plain(F.col(text_col)).alias("x"))
    known, seed = _vocabulary(texts, min_count)
    lists = texts.mapInArrow(_near_counts(window, seed), "a long, b array<long>, n array<long>")
    none = F.expr("cast(array() as array<long>)")
    both = lists.withColumn("w", F.lit(None).cast("string")).unionByName(
        known.select(F.col("id").alias("a"), "w", none.alias("b"), none.alias("n")))
    added = both.repartition("a").sortWithinPartitions("a").mapInArrow(_added, "w string, b long, n long, same boolean")
    pairs = added.join(known.select(F.col("id").alias("b"), F.col("w").alias("c")).hint("shuffle_hash"), "b")
    # a word beside itself is met from both sides
    pairs = pairs.select("w", "c", F.when(F.col("same"), 2 * F.col("n")).otherwise(F.col("n")).alias("n"))
    return pairs if half else _both_ways(pairs, "n")


def _both_ways(pairs: DataFrame, *values: str) -> DataFrame:
    """Every row, and once more with w and c changed over if they differ."""
    there = F.struct("w", "c")
    back = F.struct(F.col("c").alias("w"), F.col("w").alias("c"))
    ways = F.when(F.col("w") == F.col("c"), F.array(there)).otherwise(F.array(there, back))
    return pairs.select(F.explode(ways).alias("p"), *values).select("p.w", "p.c", *values)


def shifted_ppmi(pairs: DataFrame, shift: float = SHIFT, half: bool = False) -> DataFrame:
    """(w, c, n, ppmi) of the pairs whose pointwise mutual information is above ln(``shift``); both ways for ``half`` pairs."""
    pairs = materialize(pairs, "pairs")
    sums = pairs.select("w", "n")
    if half:
        sums = sums.union(pairs.where("w <> c").select("c", "n"))
    margins = materialize(sums.groupBy("w").agg(F.sum("n").alias("m")), "margins")
    total = margins.agg(F.sum("m")).first()[0] or 0
    ppmi = F.log(F.col("n") * F.lit(float(total)) / (F.col("m") * F.col("mc").cast("double"))) - F.log(F.lit(float(shift)))
    other = margins.select(F.col("w").alias("c"), F.col("m").alias("mc"))
    out = pairs.join(margins.hint("shuffle_hash"), "w").join(other.hint("shuffle_hash"), "c").select(
        "w", "c", "n", ppmi.alias("ppmi")).where("ppmi > 0")
    return _both_ways(out, "n", "ppmi") if half else out


def _gram(table: DataFrame, k: int) -> np.ndarray:
    """Products of all pairs of columns, summed over the table."""
    cells = [F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i + 1)]
    row = table.agg(*cells).first()
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(i + 1):
            out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
    return out


def _turned(table: DataFrame, m: np.ndarray, name: str) -> DataFrame:
    """(w, columns ``name``0..): the table's columns times ``m``."""
    return table.select("w", *[sum((F.col(f"y{i}") * float(m[i, j]) for i in range(1, m.shape[0])),
                                   F.col("y0") * float(m[0, j])).alias(f"{name}{j}") for j in range(m.shape[1])])


def factorise(matrix: DataFrame, k: int, steps: int = STEPS, spare: int = SPARE) -> tuple[np.ndarray, DataFrame]:
    """The ``k`` largest singular values of the symmetric matrix (w, c, ppmi), and (w, vec): U sqrt(S)."""
    width = k + spare
    matrix = materialize(matrix.select("w", "c", F.col("ppmi").alias("v")), "matrix")
    basis = matrix.select("w").distinct().select("w", *[
        (unit_uniform(F.concat("w", F.lit(f"/{j // 4}")), j % 4) - 0.5).alias(f"q{j}") for j in range(width)])

    def times(q: DataFrame) -> DataFrame:
        joined = matrix.join(q.withColumnRenamed("w", "c"), "c")
        return materialize(joined.groupBy("w").agg(*[F.sum(F.col("v") * F.col(f"q{j}")).alias(f"y{j}")
                                                     for j in range(width)]), "product")

    for _ in range(steps):
        y = times(basis)
        values, turn = np.linalg.eigh(_gram(y, width))
        # directions that have died out are dropped to zero, as in a matrix of lower rank
        alive = values > max(values.max(initial=0.0), 1e-300) * 1e-14
        basis = _turned(y, turn * np.where(alive, 1 / np.sqrt(np.where(alive, values, 1.0)), 0.0), "q")
    y = times(basis)
    values, turn = np.linalg.eigh(_gram(y, width))
    order = np.argsort(-values)[:k]
    sigma = np.sqrt(np.maximum(values[order], 0.0))
    scale = np.where(sigma > 0, 1 / np.sqrt(np.where(sigma > 0, sigma, 1.0)), 0.0)     # Y V / S * sqrt(S)
    vectors = _turned(y, turn[:, order] * scale, "u")
    return sigma, vectors.select("w", F.array(*[f"u{j}" for j in range(len(order))]).alias("vec"))


def word_vectors(docs: DataFrame, text_col: str, k: int = 16, window: int = WINDOW, min_count: int = MIN_COUNT,
                 shift: float = SHIFT) -> tuple[np.ndarray, DataFrame]:
    """Singular values and (w, vec) of the words of ``docs``."""
    return factorise(shifted_ppmi(pair_counts(docs, text_col, window, min_count), shift), k)
