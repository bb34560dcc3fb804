"""Removal of repeated passages by sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words. Every word is removed that lies in a
window whose words also start in a document with a smaller id.

1. Candidates. Each window is stood for by the smallest hash among its 10-word
   grams, so equal windows share it; neighbouring windows mostly do too, which
   leaves about one value for twenty words. Values seen in one document only
   rule their windows out.
2. Confirmed passages. The windows that are left are counted by the hash of
   all their words; of each recurring one the first document (smallest id) and
   place are kept. The owners' texts give the passages, in pieces of 256
   windows, and each other document is linked to the pieces it shares a window
   with. Hot windows collapse in the map-side counts, and a document takes one
   link for a piece, so work stays in proportion to the text.
3. Automata. For every block of documents the linked pieces are compiled into
   one automaton of 10-word phrases, 40 words apart, so every window of a piece
   holds one. The block's documents stream through it; each hit is extended
   word by word along the piece, which verifies it exactly, and whatever run
   reaches 50 words goes.

The documents are written once, bucketed, so none of the joins moves texts.

Defined cases: null text has no words; a null id counts as larger than every
id, and null-id documents don't remove from each other, nor do rows with one
and the same id; texts under 50 words are never cut; empty tables give empty
results; other columns are ignored, so their names can't clash; a very long text
is worked on whole, as a block of its own (some hundred bytes of memory a byte);
null-id rows with one text share a row key.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.llm.common import blocks, bucketed, offsets, raw_bytes, register, table
from edgefilter.llm.rolling import Sums, sliding_min, words
from edgefilter.session import materialize

WINDOW = 50
GRAM = 10
PIECE = 256
_LAST = (1 << 63) - 1          # stands for the id of a document without one


def _windows(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of the valid windows of a block: row, first word, smallest gram hash; and the word-hash sums, words before rows."""
    data, ends = raw_bytes(part.column("text"))
    starts, stops, before = words(data, ends)
    sums = Sums(Sums(data.astype(np.uint64)).spans(starts, stops))
    least = sliding_min(sums.grams(GRAM), WINDOW - GRAM + 1)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(before))
    at = np.flatnonzero(owner[:len(least)] == owner[WINDOW - 1:WINDOW - 1 + len(least)])
    return owner[at], at, least[at], sums, before


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, id, h): the gram hashes that stand for a document's windows."""
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            row, _, least, _, _ = _windows(part)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1])
            row, least = row[new], least[new]
            yield pa.RecordBatch.from_arrays([part.column("rid").take(pa.array(row)), part.column("id").take(
                pa.array(row)), pa.array(least.view(np.int64))], ["rid", "id", "h"])


def _listed(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every item of a list column."""
    col = part.column(name)
    n = np.diff(offsets_of_lists(col))
    return np.repeat(np.arange(len(col)), n), col.flatten().to_numpy(zero_copy_only=False)


def offsets_of_lists(col: pa.Array) -> np.ndarray:
    sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, rid, id, pos) of the windows whose gram hash is among the document's recurring ones."""
    spread = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            row, at, least, sums, before = _windows(part)
            own, h = _listed(part, "hs")
            keep = np.isin(least + row.astype(np.uint64) * spread, h.view(np.uint64) + own.astype(np.uint64) * spread)
            row, at = row[keep], at[keep]
            w = sums.spans(at, at + WINDOW)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.view(np.int64)), part.column("rid").take(take), part.column("id").take(take),
                 pa.array((at - before[row]).astype(np.int32))], ["w", "rid", "id", "pos"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(owner, block, piece): the words of the owned windows of each block of 256."""
    for batch in batches:
        rows = []
        for rid, text, blks, firsts, lasts in zip(*(batch.column(c).to_pylist() for c in (
                "rid", "text", "blks", "firsts", "lasts")), strict=True):
            w = text.split()
            rows += [(rid, b, b" ".join(w[p:q + WINDOW])) for b, p, q in zip(blks, firsts, lasts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(
            [r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["owner", "blk", "piece"])


class Shard:
    """One automaton over the phrases of a set of pieces."""

    def __init__(self, pieces: set[bytes]):
        self.words = {p: p.split() for p in pieces}
        places: dict[str, dict[bytes, list[int]]] = defaultdict(dict)
        step = WINDOW - GRAM
        for piece, w in self.words.items():
            for i in range(0, len(w) - GRAM + 1, step):
                phrase = (b" " + b" ".join(w[i:i + GRAM]) + b" ").decode("latin-1")
                places[phrase].setdefault(piece, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for phrase, where in places.items():
            self.automaton.add_word(phrase, (len(phrase), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def covered(self, doc: list[bytes], linked: set[bytes]) -> np.ndarray:
        """Flags of the words of ``doc`` in a run of 50 or more words that also stands in a linked piece."""
        gone = np.zeros(len(doc), bool)
        if self.empty or len(doc) < WINDOW:
            return gone
        text = (b" " + b" ".join(doc) + b" ").decode("latin-1")
        at = np.cumsum([0, *(len(w) + 1 for w in doc)])        # the blank before each word
        reached: dict[tuple[bytes, int], int] = {}             # end of the last run by piece and shift
        for end, (size, where) in self.automaton.iter(text):
            i = int(np.searchsorted(at, end - size + 1))
            for piece in (where.keys() & linked if len(where) > 1 else where):
                if piece not in linked:
                    continue
                other = self.words[piece]
                for j in where[piece]:
                    if i < reached.get((piece, i - j), 0) or gone[max(0, i - j):i - j + len(other)].all():
                        continue
                    a, b = i, i + GRAM
                    while a > 0 and j - (i - a) > 0 and doc[a - 1] == other[j - (i - a) - 1]:
                        a -= 1
                    while b < len(doc) and j + (b - i) < len(other) and doc[b] == other[j + (b - i)]:
                        b += 1
                    reached[piece, i - j] = b
                    if b - a >= WINDOW:
                        gone[a:b] = True
        return gone


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's kept words: streams every block through the automaton of its linked pieces."""
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            linked = [set(p or ()) for p in part.column("pieces").to_pylist()]
            shard = Shard(set().union(*linked))
            kept, n_words, n_removed = [], [], []
            for text, own in zip(part.column("text"), linked, strict=True):
                doc = (text.as_py() or b"").split()
                gone = shard.covered(doc, own) if own else None
                n_words.append(len(doc))
                n_removed.append(int(gone.sum()) if own else 0)
                kept.append(b" ".join(w for w, g in zip(doc, gone, strict=True) if not g) if own else b" ".join(doc))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _removed(batches):
        sha = [hashlib.sha256(k.as_py()).hexdigest() for k in batch.column("kept")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha, pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of each document that no earlier passage covers.

    ``kept`` is the kept words joined by one space (binary UTF-8); with
    ``digests`` its SHA-256 stands in its place.
    """
    ids, text = F.col(id_col).cast("long"), F.col(text_col).cast("binary")
    docs = bucketed(docs.select(ids.alias("doc_id"), F.coalesce(ids, F.xxhash64(text)).alias("rid"),
                                F.coalesce(ids, F.lit(_LAST)).alias("id"), text.alias("text")), "rid")
    # 1. gram hashes met in two documents or more
    anchors = materialize(docs.select("rid", "id", "text").mapInArrow(_anchors, "rid long, id long, h long"), "anchors")
    shared = materialize(anchors.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                         .where("lo < hi").select("h"), "shared")
    lists = anchors.select("rid", "h").join(shared, "h").groupBy("rid").agg(F.collect_set("h").alias("hs"))
    # 2. recurring windows with their first document, pieces and links
    found = materialize(docs.select("rid", "id", "text").join(lists, "rid").mapInArrow(
        _candidates, "w long, rid long, id long, pos int"), "windows")
    first = materialize(found.groupBy("w").agg(F.min("id").alias("owner"), F.max("id").alias("hi"),
                                               F.min_by("pos", "id").alias("pos")).where("owner < hi")
                        .select("w", "owner", F.col("pos"), F.shiftright("pos", 8).alias("blk")), "passages")
    owned = first.groupBy("owner", "blk").agg(F.min("pos").alias("p"), F.max("pos").alias("q")).groupBy(
        F.col("owner").alias("rid")).agg(F.collect_list(F.struct("blk", "p", "q")).alias("x")).select(
        "rid", F.col("x.blk").alias("blks"), F.col("x.p").alias("firsts"), F.col("x.q").alias("lasts"))
    pieces = materialize(docs.where("doc_id is not null").select("rid", "text").join(owned, "rid").mapInArrow(
        _pieces, "owner long, blk int, piece binary"), "pieces")
    links = found.join(first.select("w", "owner", "blk"), "w").where("owner < id").select(
        "rid", "owner", "blk").distinct()
    linked = materialize(links, "links").join(pieces, ["owner", "blk"]).groupBy("rid").agg(
        F.collect_set("piece").alias("pieces"))
    # 3. every document past its block's automaton
    out = docs.select("rid", "doc_id", "text").join(linked, "rid", "left")
    if digests:
        return out.mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return out.mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept binary")


@register("op3_passages")
def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digests=True)
