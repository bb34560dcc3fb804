"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte is removed that lies in a ``LENGTH``-byte string which also starts
anywhere else, in the same document or another one.

1. Which suffixes can matter. Each window of ``LENGTH`` bytes is stood for by
   its anchor, the smallest (then leftmost) hash among its 128-byte grams.
   Equal windows have equal anchors at equal offsets, so a window whose
   anchor's hash is met at one place only is unique, and its suffix is left
   out of the array. The others go, cut into slices of the windows that share
   an anchor, to the suffix bucket of the anchor's hash.
2. Sorting, one block of buckets at a time. In a block of about a megabyte the
   positions of a difference cover modulo 32 are ranked by their next 352
   bytes (by doubling, which stays inside the cover). The suffixes of the
   buckets are sorted by their first 32 bytes; a tie is resolved by comparing
   cover ranks at the first offset at which both suffixes are in the cover,
   and the last 48 bytes. Neighbours that stay tied agree on 400 bytes. A task
   holds a block, its words and ranks, and no more.
3. Crowded buckets (over ``CROWD`` anchors) are first split as a trie would:
   all slices are held against one of them, along the anchor. What agrees is
   settled at once; a window that holds the first differing byte on either side
   can only equal one with that byte at that place, which is the key of its
   next, smaller bucket. Copies settle in one step, however many there are.

The documents are written once, bucketed, so that the joins don't move texts.

Defined cases: null text is empty; texts under ``LENGTH`` bytes are kept whole;
equal rows remove each other wholly if long enough; null ids are reported as
they are; empty tables give empty results; other columns are ignored, so their
names can't clash; a very long text is worked on whole, as a block of its own
(some 75 bytes of memory a byte).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.llm.common import blocks, bucketed, partitions, raw_bytes, register, table
from edgefilter.llm.rolling import Sums, sliding_min
from edgefilter.session import materialize

LENGTH = 400
GRAM = 128
PERIOD = 32
CROWD = 256
_SORT_BYTES = 1 << 20
_HEAD, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


# -- 1. anchors and slices ------------------------------------------------
def _anchored(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """For each run of windows with one anchor: row, first and last window, anchor place, anchor hash; and the bytes."""
    data, ends = raw_bytes(part.column("text"))
    g = Sums(data.astype(np.uint64)).grams(GRAM)
    least = sliding_min((g & _HEAD) | np.arange(len(g), dtype=np.uint64), LENGTH - GRAM + 1)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(row[:len(least)] == row[LENGTH - 1:LENGTH - 1 + len(least)])
    place = (least[at] & _LOW).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    return row[at[first]], at[first], at[last], place[first], g[place[first]] if len(first) else g[:0], data, ends


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, h, n): the anchors' hashes of a document, how often each."""
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            row, _, _, _, h, _, _ = _anchored(part)
            pair, n = np.unique(np.rec.fromarrays([row, h]), return_counts=True)
            yield pa.RecordBatch.from_arrays([part.column("rid").take(pa.array(pair["f0"])), pa.array(
                pair["f1"].view(np.int64)), pa.array(n.astype(np.int64))], ["rid", "h", "n"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rid, lo, anchor, body): the slices of a document whose anchors are among its listed ``hs``."""
    spread = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            row, first, last, place, h, data, ends = _anchored(part)
            lists = part.column("hs")
            own = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
            wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) + own.astype(np.uint64) * spread
            keep = np.isin(h + row.astype(np.uint64) * spread, wanted)
            row, first, last, place, h = (x[keep] for x in (row, first, last, place, h))
            raw = data.tobytes()
            bodies = [raw[a:b + LENGTH] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), part.column("rid").take(pa.array(row)), pa.array(first - ends[row]),
                 pa.array((place - first).astype(np.int32)), pa.array(bodies, pa.binary())],
                ["key", "rid", "lo", "anchor", "body"])


# -- 2. sorting a block of buckets ----------------------------------------
def difference_cover(period: int) -> list[int]:
    """A set of residues in which every difference modulo ``period`` occurs (greedy)."""
    cover = [0]
    missing = set(range(1, period))
    while missing:
        best = max((c for c in range(1, period) if c not in cover),
                   key=lambda c: (len({(c - x) % period for x in cover} & missing)
                                  + len({(x - c) % period for x in cover} & missing), -c))
        missing -= {(best - x) % period for x in cover} | {(x - best) % period for x in cover}
        cover.append(best)
    return sorted(cover)


COVER = np.array(difference_cover(PERIOD))
#: For two residues, the first offset that takes both into the cover.
SHIFT = np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in set(COVER.tolist())
                        and (b + d) % PERIOD in set(COVER.tolist())) for b in range(PERIOD)] for a in range(PERIOD)])


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by ``keys`` (first the most significant) and each item's dense rank from 1 on."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) + 1
    return order, rank


class CoverRanks:
    """Ranks of the cover's positions of a text by their next 352 bytes, and its 8-byte words."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        padded = np.zeros(n + LENGTH + 2 * PERIOD, np.uint64)
        padded[:n] = text
        self.words = np.zeros(n + LENGTH + PERIOD, np.uint64)
        for k in range(8):
            self.words |= padded[k:k + len(self.words)] << np.uint64(56 - 8 * k)
        at = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
        rank = np.zeros(n + LENGTH + PERIOD, np.int64)
        rank[at] = _dense(*(self.words[at + 8 * k] for k in range(PERIOD // 8)))[1]
        size = PERIOD
        while size < 256:
            rank[at] = _dense(rank[at], rank[at + size])[1]
            size *= 2
        rank[at] = _dense(rank[at], rank[at + 96])[1]           # 352 = 96 + 256
        self.rank = rank

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for the suffixes at ``a`` and ``b``, which agree on 32 bytes, by their first 400."""
        shift = SHIFT[a % PERIOD, b % PERIOD]
        out = np.sign(self.rank[a + shift] - self.rank[b + shift])
        for k in range(352, LENGTH, 8):
            tied = np.flatnonzero(out == 0)
            x, y = self.words[a[tied] + k], self.words[b[tied] + k]
            out[tied] = (x > y).astype(np.int64) - (x < y)
        return out


def repeated_starts(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Which of ``starts`` have the same next 400 bytes as another start of their bucket."""
    ranks = CoverRanks(text)
    order, tie = _dense(bucket, *(ranks.words[starts + 8 * k] for k in range(PERIOD // 8)))
    found = np.zeros(len(starts), bool)
    item, group = order, tie[order]
    while len(item):
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(begin, len(item)))
        live = np.repeat(size > 1, size)
        pivot = np.repeat(item[begin + size // 2], size)[live]
        item, group = item[live], group[live]
        side = ranks.compare(starts[item], starts[pivot])
        same = side == 0
        twins = np.bincount(group[same], minlength=int(group.max()) + 1 if len(group) else 0)
        found[item[same]] = twins[group[same]] > 1
        item, group, side = item[~same], group[~same], side[~same]
        again, rank = _dense(group, side)
        item, group = item[again], rank[again]
    return found


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, a, b): byte ranges settled as repeated, from slices that come sorted by key."""
    names = ["rid", "a", "b"]

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        """``rows`` are (key, rid, lo, body) of whole buckets."""
        members: dict[tuple, list[tuple[int, int]]] = {}
        kinds: dict[int, int] = {}
        for key, rid, lo, body in rows:
            if (key, body) not in members:
                members[key, body] = []
                kinds[key] = kinds.get(key, 0) + 1
            members[key, body].append((rid, lo))
        out: list[tuple[int, int, int]] = []
        several = []
        for (key, body), places in members.items():
            if len(places) > 1:
                out += [(rid, lo, lo + len(body)) for rid, lo in places]
            if kinds[key] > 1:
                several.append((key, body, places))
        if several:
            size = np.array([len(body) for _, body, _ in several])
            base = np.concatenate([[0], np.cumsum(size)[:-1]])
            count = size - LENGTH + 1
            owner = np.repeat(np.arange(len(several)), count)
            starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + base[owner]
            _, bucket = _dense(np.array([key for key, _, _ in several]))
            hit = repeated_starts(np.frombuffer(b"".join(body for _, body, _ in several), np.uint8), starts,
                                  bucket[owner])
            where, own = starts[hit], owner[hit]
            if len(where):
                cut = np.append(True, (np.diff(where) != 1) | (np.diff(own) != 0))
                last = np.append(np.flatnonzero(cut)[1:], len(where)) - 1
                for i, p, q in zip(own[cut].tolist(), where[cut].tolist(), where[last].tolist(), strict=True):
                    out += [(rid, lo + p - int(base[i]), lo + q - int(base[i]) + LENGTH) for rid, lo in several[i][2]]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names)

    held: list[tuple] = []
    held_bytes = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "rid", "lo", "body")), strict=True):
            if held and held_bytes >= _SORT_BYTES and row[0] != held[-1][0]:
                yield settle(held)
                held, held_bytes = [], 0
            held.append(row)
            held_bytes += len(row[3])
    if held:
        yield settle(held)


# -- 3. crowded buckets ---------------------------------------------------
def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(x), len(y))
    other = np.flatnonzero(x[:n] != y[:n])
    return int(other[0]) if len(other) else n


def _against_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Holds slices against their bucket's chosen one (``one``, ``one_anchor``, ``one_rid``, ``one_lo``).

    Rows with a null body are settled ranges (rid, lo = a, anchor = length); the
    others are slices of the windows that hold a differing byte; ``side``,
    ``reach`` and ``byte`` tell where and which.
    """
    names = ["key", "rid", "lo", "anchor", "body", "side", "reach", "byte"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
    for batch in batches:
        out, settled = [], set()
        for key, rid, lo, at, body, one, one_at, one_rid, one_lo in zip(*(batch.column(c).to_pylist() for c in (
                "key", "rid", "lo", "anchor", "body", "one", "one_anchor", "one_rid", "one_lo")), strict=True):
            x, y = np.frombuffer(body, np.uint8), np.frombuffer(one, np.uint8)
            left = _agree(x[:at][::-1], y[:one_at][::-1])
            right = _agree(x[at:], y[one_at:])
            if left + right >= LENGTH:
                settled.add((rid, lo + at - left, left + right))
                settled.add((one_rid, one_lo + one_at - left, left + right))
            top = len(body) - LENGTH
            if left < at:
                end = min(top, at - left - 1) + LENGTH
                out.append((key, rid, lo, at, body[:end], 0, left, body[at - left - 1]))
            if at + right < len(body):
                begin = max(0, at + right - LENGTH + 1)
                out.append((key, rid, lo + begin, at - begin, body[begin:], 1, right, body[at + right]))
        out += [(None, rid, a, n, None, None, None, None) for rid, a, n in settled]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


def _split_crowded(slices: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Settled ranges, and slices in buckets of at most ``CROWD``, of ``slices`` in crowded buckets."""
    ranges, calm = [], []
    rows = materialize(slices.withColumn("sid", F.monotonically_increasing_id()), "crowded")
    while not rows.isEmpty():
        ones = rows.groupBy("key").agg(F.min("sid").alias("sid"))
        one = materialize(rows.join(ones.select("sid"), "sid", "left_semi").select(
            "key", F.col("sid").alias("one_sid"), F.col("body").alias("one"), F.col("anchor").alias("one_anchor"),
            F.col("rid").alias("one_rid"), F.col("lo").alias("one_lo")), "chosen")
        held = materialize(rows.join(one, "key").where("sid <> one_sid").drop("sid", "one_sid").mapInArrow(
            _against_one, "key long, rid long, lo long, anchor int, body binary, side int, reach int, byte int"), "held")
        ranges.append(held.where("body is null").select("rid", F.col("lo").alias("a"),
                                                        (F.col("lo") + F.col("anchor")).alias("b")))
        rest = held.where("body is not null").select(
            F.xxhash64("key", "side", "reach", "byte").alias("key"), "rid", "lo", "anchor", "body")
        sizes = materialize(rest.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        calm.append(rest.join(sizes.where(F.col("n") <= CROWD).select("key"), "key", "left_semi"))
        rows = materialize(rest.join(sizes.where(F.col("n") > CROWD).select("key"), "key", "left_semi").withColumn(
            "sid", F.monotonically_increasing_id()), "crowded")
    return ranges, calm


# -- the operator ---------------------------------------------------------
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, spans, kept = [], [], [], []
        for text, at, to in zip(batch.column("text"), batch.column("starts").to_pylist(),
                                batch.column("stops").to_pylist(), strict=True):
            body = text.as_py() or b""
            merged: list[list[int]] = []
            for a, b in sorted(zip(at or (), to or (), strict=True)):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            n.append(len(body))
            gone.append(sum(b - a for a, b in merged))
            spans.append(len(merged))
            stays = zip([0, *(b for _, b in merged)], [*(a for a, _ in merged), len(body)], strict=True)
            kept.append(b"".join(body[a:b] for a, b in stays) if merged else body)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, spans)),
                                          pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans",
                                                                         "kept"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        sha = [hashlib.sha256(k.as_py()).hexdigest() for k in batch.column("kept")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sha, pa.string())],
                                         [*batch.schema.names[:4], "kept_sha256"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          digests: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; with ``digests`` the SHA-256 of what is kept."""
    spark = docs.sparkSession
    docs = bucketed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                                F.col(text_col).cast("binary").alias("text")), "rid")
    texts = docs.select("rid", "text")
    anchors = materialize(texts.mapInArrow(_anchors, "rid long, h long, n long"), "anchors")
    shared = materialize(anchors.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "shared")

    def slices(kind: str) -> DataFrame:
        lists = anchors.select("rid", "h").join(shared.where(kind).select("h"), "h").groupBy("rid").agg(
            F.collect_list("h").alias("hs"))
        return texts.join(lists, "rid").mapInArrow(_slices, "key long, rid long, lo long, anchor int, body binary")

    ranges, calm = _split_crowded(slices(f"n > {CROWD}")) if not shared.where(f"n > {CROWD}").isEmpty() else ([], [])
    for part in [slices(f"n <= {CROWD}"), *calm]:
        ranges.append(part.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(
            _sorted_blocks, "rid long, a long, b long"))
    found = ranges[0]
    for more in ranges[1:]:
        found = found.union(more)
    gone = found.groupBy("rid").agg(F.collect_set(F.struct("a", "b")).alias("x")).select(
        "rid", F.col("x.a").alias("starts"), F.col("x.b").alias("stops"))
    out = docs.join(gone, "rid", "left").select("doc_id", "text", "starts", "stops")
    if digests:
        return out.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


@register("op8_suffixes")
def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), digests=True)
