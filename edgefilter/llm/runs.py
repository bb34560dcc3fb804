"""Periodic runs of words by an online sparse diagonal programme.

A run is a stretch of words with smallest period q (words q apart are equal) and
at least max(6, 4 q) words, that can't be extended. On the table of a text
against itself a run is a stretch of matches on the diagonal of lag q. Word by
word, the earlier occurrences of a word lengthen the diagonals of their lags; a
diagonal that isn't lengthened has ended and is emitted at once if long enough.

What keeps it sparse is the choice of earlier occurrences. Lags from b to 1.5 b
are looked at with the last g = 3 b words of context: the word's nearest earlier
occurrence after the same context counts, if its lag is in the band. Of a run
with smallest period q (b <= q, 2 q <= g <= 3 q), every context of g words has
smallest period q as well, so that nearest occurrence is exactly q back; and a
nearest occurrence at such a lag means a stretch of smallest period q. So a
diagonal opens once for each run, at g matches, multiples of a period never
open, and a word lengthens a number of diagonals logarithmic in the text, also
in a text of one word. Contexts are equal if their ranks are: ranks of words,
then of pairs of ranks, of longer and longer contexts, kept for those only that
occur again (exact, no hash).

Blocks of about a megabyte of text are worked on at once (numpy); the (document,
word) codes keep documents apart. A longer text is a block of its own, at some ten bytes of memory a byte.

Defined cases: null text is empty; a text without words has no run and an empty
collapsed text; equal rows are reported each; null ids stay; other columns are
ignored, so their names can't clash; an empty table gives no rows. Words are
runs of bytes other than 0x20 and 0x09 to 0x0D, compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import blocks, raw_bytes, register, table

LEAST_WORDS, LEAST_POWER = 6, 4
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` (binary) one after the other, and each text's first word (one more than texts)."""
    data, ends = raw_bytes(texts)
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    full = np.diff(ends) > 0                 # no word spans two texts
    opens[ends[:-1][full]] = inside[ends[:-1][full]]
    closes[ends[1:][full] - 1] = inside[ends[1:][full] - 1]
    starts = np.flatnonzero(opens)
    first = np.searchsorted(starts, ends)
    bounds = np.append(0, np.cumsum(np.flatnonzero(closes) + 1 - starts))
    size = int(bounds[-1])
    kind, offset = (pa.binary(), np.int32) if size < 2**31 else (pa.large_binary(), np.int64)
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(bounds.astype(offset)),
                                                      pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return words, first


class Contexts:
    """Ranks of the contexts (the last ``size`` words) that end at each word and occur more than once."""

    def __init__(self, codes: np.ndarray):
        self.size = 1
        self.rank = np.zeros(len(codes), np.int64)          # 0: the context occurs once
        self.at = np.arange(len(codes))
        self._keep(codes)

    def _keep(self, keys: np.ndarray) -> None:
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        again = n > 1
        dense = np.cumsum(again)
        stays = again[inverse]
        self.rank[self.at] = 0
        self.at, rank = self.at[stays], dense[inverse[stays]]
        self.rank[self.at] = rank

    def grow(self, size: int) -> None:
        """Contexts of ``size`` words, at most twice as many as before."""
        more = size - self.size
        earlier = np.where(self.at >= more, self.rank[self.at - more], 0)
        both = earlier > 0
        self.rank[self.at[~both]] = 0
        self.at, earlier = self.at[both], earlier[both]
        top = int(earlier.max(initial=0)) + 1
        self._keep(self.rank[self.at] * top + earlier)
        self.size = size

    def nearest(self) -> np.ndarray:
        """For each word of ``at``: how far back its nearest earlier occurrence in this context is (0: none)."""
        order = np.argsort(self.rank[self.at], kind="stable")
        place, rank = self.at[order], self.rank[self.at[order]]
        lag = np.zeros(len(place), np.int64)
        same = rank[1:] == rank[:-1]
        lag[1:][same] = (place[1:] - place[:-1])[same]
        out = np.empty_like(lag)
        out[order] = lag
        return out


def matches(codes: np.ndarray, longest: int) -> np.ndarray:
    """(word, lag, context) in order of words: the earlier occurrences that count, of texts of up to ``longest`` words."""
    found = [np.zeros((0, 3), np.int64)]
    contexts, lag = Contexts(codes), 1
    while LEAST_POWER * lag <= longest and len(contexts.at):
        beyond, size = lag + lag // 2 + 1, 3 * lag
        while contexts.size < size:
            contexts.grow(min(2 * contexts.size, size))
        back = contexts.nearest()
        ours = (back >= lag) & (back < beyond)
        found.append(np.column_stack([contexts.at[ours], back[ours], np.full(ours.sum(), size)]))
        lag = beyond
    out = np.concatenate(found)
    return out[np.argsort(out[:, 0], kind="stable")]


def diagonals(events: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every diagonal as it ends, from :func:`matches`."""
    active: dict[int, int] = {}          # lag -> matches up to the word before
    grown: dict[int, int] = {}           # ... up to this word
    word = -2
    for at, lag, context in events.tolist():
        if at != word:
            for q in active.keys() - grown.keys():
                yield word - q - active[q], active[q] + q, q
            active, grown = grown, {}
            if at != word + 1:
                for q, n in active.items():
                    yield word + 1 - q - n, n + q, q
                active = {}
            word = at
        grown[lag] = active[lag] + 1 if lag in active else context
    for q in active.keys() - grown.keys():
        yield word - q - active[q], active[q] + q, q
    for q, n in grown.items():
        yield word + 1 - q - n, n + q, q


def find_runs(codes: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    return sorted(r for r in diagonals(matches(codes, longest)) if r[1] >= max(LEAST_WORDS, LEAST_POWER * r[2]))


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the column ``text`` by the words' number, the runs and the collapsed text."""
    names = None
    for batch in batches:
        at = batch.schema.get_field_index("text")
        names = [*batch.schema.names[:at], "n_words", "runs", "collapsed"]
        for begin, stop in blocks(batch, "text"):
            part = batch.slice(begin, stop - begin)
            words, first = split_words(part.column(at))
            count = np.diff(first)
            index = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(part)), count)
            runs = find_runs(doc * (int(index.max(initial=0)) + 1) + index, int(count.max(initial=0)))
            stays = np.ones(len(index), bool)
            owner = doc[[r[0] for r in runs]] if runs else np.zeros(0, np.int64)
            if runs:
                start, length, period = np.array(runs).T
                edge = np.zeros(len(index) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                stays = np.cumsum(edge[:-1]) == 0
                told = pa.StructArray.from_arrays([pa.array(start - first[owner]), pa.array(length), pa.array(period)],
                                                  names=_RUN.names)
            else:
                told = pa.StructArray.from_arrays([pa.array([], pa.int64())] * 3, names=_RUN.names)
            bounds = np.searchsorted(owner, np.arange(len(part) + 1))
            kept = words if stays.all() else words.filter(pa.array(stays))
            places = np.concatenate([[0], np.cumsum(stays)])[first]
            lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), kept)
            collapsed = pc.binary_join(lists, pa.scalar(b" ", words.type))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:at], pa.array(count.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), told), collapsed.cast(pa.binary())], names)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, in that order), collapsed.

    ``collapsed`` (binary, UTF-8) is the words joined by one space, without those
    that some run contains after its first period.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.BinaryType())])
    return given.mapInArrow(_work, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, exactly; of equal ones the first. Null if there is none."""
    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(_RUN), better)


def _repeat_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the query's contract: one document in ten repeats a part of itself from some word on."""
    for batch in batches:
        out = []
        for h, text in zip(batch.column("h").to_pylist(), batch.column("text"), strict=True):
            body = text.as_py() or b""
            if h is not None and h % 10 == 0 and (words := body.split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                body = b" ".join([*words[:a], *(words[a:a + p] * (n // p + 1))[:n - a]])
            out.append(body)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "text"])


@register("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    found = periodic_runs(docs.mapInArrow(_repeat_tails, "doc_id long, text binary"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = F.col("best")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
