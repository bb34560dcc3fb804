"""Packing of token sequences by minimum bin slack.

Every document is its ids and one end id. What is longer than a sequence gives
whole sequences of its own; the rest, shorter than a sequence, goes to the pool
of the task that reads it. From the pool a window is filled so: the longest
piece first, then a bitset of reachable sums is grown length by length (each
with its count, split in powers of two) until the space that is left is reached
or no length remains; the largest sum that fits is traced back to counts of
lengths. If some slack stays, one more piece is cut there, so every window is
full and each id is in exactly one piece.

A pool holds a bounded number of tokens and has less than one sequence left when
its task ends. These rests (under 2048 tokens a task) are pooled again, those of
``FAN_IN`` tasks in one, and so on; nothing else is shuffled. The last rest, under
one sequence in all, is dealt to sequences whose lengths are powers of two, which
need no padding. A sequence lies in one task, and a task that is run again from
the same file split makes the same sequences.

Defined cases: a null or empty text is its end id alone; repeated rows and
repeated or null ids are packed each (pieces of one row share ``doc_id``); very
long texts are encoded in runs of about a megabyte, cut at white space, with no
more than one sequence of ids waiting; other columns are ignored, so their names
can't clash; an empty table gives no rows. Ties between pieces of one length:
the one met first.
"""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.bpe import Codec, default_path
from edgefilter.llm.common import blocks, register, table
from edgefilter.session import materialize

CAPACITY = 2048
END_ID = 1
#: Tokens a pool holds before windows are filled from it.
POOL_TOKENS = 1 << 22
FAN_IN = 64
_RUN_BYTES = 1 << 20
_ROWS = 1 << 14
_ID = np.dtype("<u4")


# -- ids ------------------------------------------------------------------
#: Words that a task's table holds, some 200 bytes each; a full table is emptied.
TABLE_ENTRIES = 800_000
_WHITE = b" \t\n\r\x0b\x0c"
#: Bytes of a word up to which words are merged many at a time.
_SHORT = 24
_NONE = np.int32(2**31 - 1)


class PackedCodec(Codec):
    """The tokenizer's ids as bytes, four an id; the new words of a block are merged together.

    A word is a row of symbol ids. In every round each row that has a pair to
    merge merges its pair of lowest rank, the leftmost of equal ones.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.table: dict[str, bytes] = {}
        n = len(self.ids)
        merges = sorted((self.ids[a] * n + self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items())
        self.pair, self.rank = np.array([m[0] for m in merges]), np.array([m[1] for m in merges], np.int32)
        self.joined = np.zeros(len(merges), np.int32)
        self.joined[self.rank] = [m[2] for m in merges]
        self.first = np.array([self.ids[self.symbols[b]] for b in range(256)], np.int32)
        self.last = np.array([self.ids[self.symbols[b] + self.end] for b in range(256)], np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols (-1: none there)."""
        key = left.astype(np.int64) * len(self.ids) + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.rank[at], _NONE)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of at most ``_SHORT`` bytes."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        width = int(size.max()) + 1
        sym = np.full((n, width), -1, np.int32)
        cell = np.arange(width) < size[:, None]
        sym[cell] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.frombuffer(bytes(w[-1] for w in words), np.uint8)
        sym[np.arange(n), size - 1] = self.last[ends]
        ranks = np.full((n, width), _NONE)
        ranks[:, :-1] = self._ranks(sym[:, :-1], sym[:, 1:])
        done = np.empty((n, width), np.int32)
        live, cols = np.arange(n), np.arange(width)
        while len(live):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(live)), at]
            go = least < _NONE
            done[live[~go]] = sym[~go]
            live, at, least, row = live[go], at[go], least[go], np.arange(int(go.sum()))
            after = at[:, None]
            ranks = np.take_along_axis(ranks[go], np.minimum(cols + (cols >= after), width - 1), axis=1)
            sym = np.take_along_axis(sym[go], np.minimum(cols + (cols > after), width - 1), axis=1)
            sym[row, at] = self.joined[least]
            ranks[row, at] = self._ranks(sym[row, at], sym[row, np.minimum(at + 1, width - 1)])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._ranks(sym[left, at[left] - 1], sym[left, at[left]])
        kept = done >= 0
        raw = done[kept].astype(_ID).tobytes()
        stops = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _learn(self, words: set[str]) -> None:
        if len(self.table) + len(words) > TABLE_ENTRIES:
            self.table.clear()
        spelled = [(w, w.encode()) for w in words]
        short = [x for x in spelled if len(x[1]) <= _SHORT]
        if short:
            names, raw = zip(*short, strict=True)
            self.table.update(zip(names, self.merged(raw), strict=True))
        self.table.update((w, np.array(self._plain_ids(w), _ID).tobytes()) for w, x in spelled if len(x) > _SHORT)

    def _odd(self, text: bytes) -> bytes:
        """Ids of a text with letters beyond Latin-1 or special tokens, piece by piece."""
        return np.array([i for p in text.split() for w in self._piece_ids(p) for i in w.split(" ")], np.int64).astype(_ID).tobytes()

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text of a block."""
        out: list[bytes | list[str]] = []
        for text in texts:
            chars = text.decode("utf-8", "replace")
            plain = self.plain(chars) and not any(s in chars for s in self.special)
            out.append(self.plain_words(chars.lower()) if plain else self._odd(text))
        words = [x for x in out if isinstance(x, list)]
        fresh = set().union(*words) - self.table.keys()
        if fresh:
            if len(self.table) + len(fresh) > TABLE_ENTRIES:        # the table is emptied: all words are new
                fresh = set().union(*words)
            self._learn(fresh)
        get = self.table.__getitem__
        return [b"".join(map(get, x)) if isinstance(x, list) else x for x in out]

    def runs(self, text: bytes) -> Iterator[bytes]:
        """The ids of a whole text, a run of about a megabyte at a time; no token spans white space."""
        start = 0
        while start < len(text):
            stop = min(len(text), start + _RUN_BYTES)
            while stop < len(text) and text[stop] not in _WHITE:
                stop += 1
            yield self.packed([text[start:stop]])[0]
            start = stop


_codecs: dict[str, PackedCodec] = {}


def packed_codec(path: str) -> PackedCodec:
    """The codec of a file, built once in each Python worker."""
    if path not in _codecs:
        _codecs[path] = PackedCodec(path)
    return _codecs[path]


# -- the fullest window ---------------------------------------------------
def closest(counts: list[tuple[int, int]], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``room`` of a multiset of lengths, and how often each length is in it.

    ``counts`` are (length, how many there are). Bit s of ``seen`` says that the
    lengths so far can sum to s.
    """
    seen, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, n in counts:
        n, times = min(n, room // length), 1
        while n > 0:
            times = min(times, n)
            steps.append((length, times, seen))
            seen |= (seen << (length * times)) & mask
            n -= times
            times *= 2
        if seen >> room:
            break
    at = total = seen.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + times
            at -= length * times
    return total, chosen


class Piece(NamedTuple):
    doc_id: object
    start: int
    ids: bytes
    doc_tokens: int


class Pool:
    """The pieces that wait in a task, by length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_length: dict[int, deque[Piece]] = {}
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        length = len(piece.ids) // 4
        self.by_length.setdefault(length, deque()).append(piece)
        self.tokens += length

    def _take(self, length: int) -> Piece:
        row = self.by_length[length]
        piece = row.popleft()
        if not row:
            del self.by_length[length]
        self.tokens -= length
        return piece

    def window(self, room: int) -> list[Piece]:
        """A full window of ``room`` tokens; the pool holds that many at least."""
        lengths = sorted(self.by_length, reverse=True)
        first = next((x for x in lengths if x <= room), None)
        out = []
        if first is not None:
            out.append(self._take(first))
            room -= first
            total, chosen = closest([(x, len(self.by_length[x])) for x in lengths
                                     if x <= room and x in self.by_length], room)
            out += [self._take(x) for x, n in chosen.items() for _ in range(n)]
            room -= total
        if room:            # whatever is left is longer than the slack: it would have fitted otherwise
            doc_id, start, ids, n = self._take(max(self.by_length))
            out.append(Piece(doc_id, start, ids[:4 * room], n))
            self.add(Piece(doc_id, start + room, ids[4 * room:], n))
        return out

    def rest(self) -> Iterator[Piece]:
        for length in sorted(self.by_length, reverse=True):
            yield from self.by_length[length]


class _Out:
    """Rows of a task: pieces in sequences, and those that wait for the next round (null sequence)."""

    def __init__(self, schema: pa.Schema, level: int, part: int, digests: bool):
        self.schema, self.part, self.digests = schema, part, digests
        self.next_id = (level << 56) | (part << 32)
        self.rows: list[tuple] = []

    def sequence(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc_id, start, ids, n in pieces:
            length = len(ids) // 4
            told = (None, zlib.crc32(ids)) if self.digests else (ids, None)
            self.rows.append((doc_id, start, length, n, self.next_id, offset, *told, self.part))
            offset += length
        self.next_id += 1

    def waiting(self, pieces: Iterator[Piece]) -> None:
        self.rows += [(doc_id, start, len(ids) // 4, n, None, None, ids, None, self.part)
                      for doc_id, start, ids, n in pieces]

    def flush(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in self.rows], f.type)
                                          for k, f in enumerate(self.schema)], schema=self.schema)
        self.rows = []
        return out


# -- the operator ---------------------------------------------------------
def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _fill(pool: Pool, out: _Out, down_to: int) -> Iterator[pa.RecordBatch]:
    while pool.tokens >= max(down_to, pool.capacity):
        out.sequence(pool.window(pool.capacity))
        if len(out.rows) >= _ROWS:
            yield out.flush()


def _end(pool: Pool, out: _Out, last: bool) -> Iterator[pa.RecordBatch]:
    """What remains of a task: full windows, and a rest for the next round or in powers of two."""
    yield from _fill(pool, out, 0)
    if last:
        while pool.tokens:
            out.sequence(pool.window(1 << (pool.tokens.bit_length() - 1)))
    else:
        out.waiting(pool.rest())
    yield out.flush()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, digests: bool = False) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` is a piece's ids as little-endian unsigned 32-bit integers; with
    ``digests`` their CRC-32 (``ids_crc32``) stands in their place. ``capacity``
    is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    path = path or default_path()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                        F.spark_partition_id().cast("long").alias("part"))
    schema = T.StructType([given.schema["doc_id"], *map(_long, ("start", "length", "doc_tokens", "sequence_id", "offset")),
                           T.StructField("ids", T.BinaryType()), _long("ids_crc32"), _long("part")])
    end = np.array([end_id], _ID).tobytes()
    size = 4 * capacity

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        c, pool, out = packed_codec(path), Pool(capacity), None
        for batch in batches:
            if out is None and batch.num_rows:
                out = _Out(to_arrow_schema(schema), 0, batch.column("part")[0].as_py(), digests)
            for doc_id, runs in _encoded(c, batch):
                held, start, whole = b"", 0, []
                for run in chain(runs, (end,)):
                    held += run
                    at = 0
                    while len(held) - at >= size:
                        whole.append((start, zlib.crc32(held[at:at + size]) if digests else held[at:at + size]))
                        at, start = at + size, start + capacity
                    held = held[at:]
                n = start + len(held) // 4
                for begin, told in whole:
                    out.rows.append((doc_id, begin, capacity, n, out.next_id, 0, *((None, told) if digests else (told, None)),
                                     out.part))
                    out.next_id += 1
                if held:
                    pool.add(Piece(doc_id, start, held, n))
                if pool.tokens >= POOL_TOKENS:
                    yield from _fill(pool, out, POOL_TOKENS // 2)
                if len(out.rows) >= _ROWS:
                    yield out.flush()
        if out is not None:
            yield from _end(pool, out, False)

    def next_round(level: int, last: bool) -> Callable:
        def run(key: tuple, rows: pa.Table) -> pa.Table:
            from pyspark.sql.pandas.types import to_arrow_schema
            pool = Pool(capacity)
            out = _Out(to_arrow_schema(schema), level, key[0].as_py(), digests)
            order = rows.sort_by([("part", "ascending"), ("length", "descending")])
            for doc_id, start, ids, n in zip(*(order.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")),
                                             strict=True):
                pool.add(Piece(doc_id, start, ids, n))
            return pa.Table.from_batches(list(_end(pool, out, last)), out.schema)
        return run

    done = materialize(given.mapInArrow(first_round, schema), "packed")
    parts = (done.agg(F.max("part")).first()[0] or 0) + 1
    rounds, level = [done], 0
    while True:
        level, parts = level + 1, math.ceil(parts / FAN_IN)
        waiting = rounds[-1].where("sequence_id is null").withColumn("grp", F.floor(F.col("part") / FAN_IN))
        rounds.append(materialize(waiting.groupBy("grp").applyInArrow(next_round(level, parts == 1), schema),
                                  "packed"))
        if parts == 1:
            break
    out = rounds[0]
    for more in rounds[1:]:
        out = out.union(more)
    return out.where("sequence_id is not null").select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32" if digests else "ids")


def _encoded(c: PackedCodec, batch: pa.RecordBatch) -> Iterator[tuple[object, Iterable[bytes]]]:
    """Each row's id and its ids in runs; a block of short texts is encoded together."""
    ids = batch.column("doc_id").to_pylist()
    for start, stop in blocks(batch, "text"):
        texts = [x.as_py() or b"" for x in batch.column("text").slice(start, stop - start)]
        if len(texts) == 1:
            yield ids[start], c.runs(texts[0])
        else:
            yield from zip(ids[start:stop], ((x,) for x in c.packed(texts)), strict=True)


@register("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), digests=True)
