"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are sets of five-word shingles (A-Z lower-cased); an item of fewer words is
one shingle, its whole sequence. A test item is found in a document that holds at
least ``CONTAINMENT`` of the item's shingles as neighbouring words, however long the
document is.

1. Items are partitioned by the number of their shingles, in powers of two.
   The partition's upper bound ``u`` sets the length of its items' bottom-k
   MinHash sketches, k = floor((1 - t) u) + SPARE: an item of s shingles that is
   contained to the share t lacks at most floor((1 - t) s) of them, so its
   document holds at least k - floor((1 - t) s) > 0 sketch values. No item is
   missed, and larger items are asked for more of their values. Of these spare
   values an item leaves out those that many items share (templates), as long
   as one hit remains certain. Items of equal text are searched once.
2. One pass over the documents hashes all shingles (of five words, and of each
   smaller number of words that an item has) and keeps those in a bit
   set of the sketch values. Its size is fixed, so it can be broadcast for any
   benchmark; false hits only cost a row each. The hits are joined with the
   sketches and counted by document and item; documents too short to hold the
   share of an item are no candidates of it.
3. Candidates are verified on the shingles themselves.

Defined cases: null or blank texts have no shingle, contain nothing and are not
found; items and documents that share an id are searched one by one and reported
with the best of them; repeated rows are reported once; null ids are reported
as null; empty tables give empty results; ``decontaminate`` keeps all columns, whatever
their names. Very long texts are hashed and verified a quarter of a megabyte at a time, with four words
of overlap, so memory does not grow with them (a single word is held whole). An item of
one very common word is found, as asked, in every document that has it; ``least_words``
leaves items of fewer words out of the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgefilter.llm.common import NARROW_ROW, blocks, by_rows, fresh, raw_bytes, register, release, table
from edgefilter.llm.rolling import Sums, pieces, words
from edgefilter.session import materialize

SHINGLE = 5
CONTAINMENT = 0.8
#: Sketch values beyond the least number that finds every item.
SPARE = 3
#: The bit set of sketch values has 2^FILTER_BITS bits (2 MB).
FILTER_BITS = 24
#: A sketch value of more items than this is left out where an item can spare it.
SHARED = 16
#: Text hashed at a time; with up to four further shingle sizes the numbers a byte are many.
PART_BYTES = (1 << 18) - 1
_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(w: list[bytes], k: int) -> Iterator[bytes]:
    """All sequences of ``k`` neighbouring words, repeats included."""
    return (b" ".join(w[i:i + k]) for i in range(len(w) - k + 1))


def shingles(text: bytes | None) -> set[bytes]:
    """The distinct shingles of an item."""
    w = (text or b"").lower().split()
    return set(grams(w, min(SHINGLE, len(w)))) if w else set()


def shingle_hashes(data: np.ndarray, ends: np.ndarray, short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of texts that lie end to end, in order of row and hash.

    ``short`` are numbers of words below ``SHINGLE`` whose sequences are wanted too.
    """
    data = _LOWER[data]
    starts, stops, before = words(data, ends)
    sums = Sums(Sums(data.astype(np.uint64)).spans(starts, stops))
    n = np.diff(before)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(starts))
    first = before[:-1][row]
    size = np.minimum(n[row], SHINGLE)
    at = at[at + size <= before[1:][row]]
    at = at[(n[row[at]] >= SHINGLE) | (at == first[at])]
    found = [(row[at], sums.spans(at, at + size[at]))]
    for k in short:
        at = np.flatnonzero(np.arange(len(starts)) + k <= before[1:][row])
        found.append((row[at], sums.spans(at, at + k)))
    row, h = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            row, h = shingle_hashes(*raw_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("iid").take(pa.array(row)), pa.array(h.view(np.int64))],
                                             ["iid", "h"])


def sketches(items: DataFrame, t: float = CONTAINMENT) -> DataFrame:
    """(iid, h, size, need): bottom-k values of each item of ``items`` (iid, text); ``need`` of them must be met."""
    hashes = items.mapInArrow(_hashes, "iid long, h long")
    own = Window.partitionBy("iid")
    ranked = hashes.withColumn("size", F.count("*").over(own)).withColumn("r", F.row_number().over(own.orderBy("h")))
    upper = F.pow(F.lit(2), F.ceil(F.log2("size")))
    # the small addend keeps e.g. (1 - 0.8) * 5 from rounding below 1
    lacking = lambda n: F.floor((1 - t) * n + 1e-9)
    k = F.least(F.col("size"), lacking(upper) + SPARE)
    chosen = ranked.withColumn("k", k).where("r <= k").withColumn("need", F.col("k") - lacking(F.col("size")))
    shared = chosen.groupBy("h").agg(F.count("*").alias("n_items")).where(F.col("n_items") > SHARED)
    commonest = F.row_number().over(own.orderBy(F.col("n_items").desc(), "h"))
    spared = F.coalesce(F.col("c") < F.col("need"), F.lit(False))
    return (chosen.join(shared, "h", "left").withColumn("c", F.when(F.col("n_items").isNotNull(), commonest))
            .withColumn("spared", spared)
            .withColumn("need", F.col("need") - F.sum(F.col("spared").cast("int")).over(own))
            .where(~F.col("spared")).select("iid", "h", "size", "need"))


def filter_bits(sketch: DataFrame) -> np.ndarray:
    """The sketch values modulo 2^FILTER_BITS as flags; bounded by that number whatever the items."""
    slot = F.pmod("h", F.lit(1 << FILTER_BITS)) + 1
    rows = sketch.select(slot.alias("s")).groupBy(F.expr("bitmap_bucket_number(s)").alias("b")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("bits")).collect()
    flags = np.zeros(1 << FILTER_BITS, np.uint8)
    for r in rows:
        chunk = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        at = (r["b"] - 1) * len(chunk)
        flags[at:at + len(chunk)] = chunk[:len(flags) - at]
    return np.packbits(flags, bitorder="little")


def n_held(text: bytes | None, wanted: dict[int, set[bytes]]) -> set[bytes]:
    """The shingles of ``wanted`` (by their number of words) that a text holds."""
    held: set[bytes] = set()
    for piece in pieces(text or b"", SHINGLE - 1, PART_BYTES):
        w = piece.lower().split()
        for k, sought in wanted.items():
            held.update(g for g in grams(w, k) if g in sought)
    return held


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for rid, other, doc_id, text, listed in zip(*(batch.column(c) for c in ("rid", "rid2", "doc_id", "text", "items")),
                                                    strict=True):
            items = {i["iid"]: shingles(i["item"]) for i in listed.as_py()}
            wanted: dict[int, set[bytes]] = {}
            for own in items.values():
                for g in own:
                    wanted.setdefault(g.count(b" ") + 1, set()).add(g)
            held = n_held(text.as_py(), wanted)
            out += [(rid.as_py(), other.as_py(), doc_id.as_py(), iid, len(own & held), len(own)) for iid, own in items.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(6)],
                                         ["rid", "rid2", "doc_id", "iid", "n_shared", "n_shingles"])


def row_key(id_col: str, text_col: str, part: int = 0) -> F.Column:
    """Equal for equal rows; verdicts depend on the text alone, so rows that share it share the verdict.

    One part finds candidates, where a chance collision costs a check; a verdict goes by both, 128 bits.
    """
    return F.xxhash64(F.col(id_col), F.col(text_col)) if part == 0 else F.xxhash64(
        F.lit(part), F.md5(F.col(text_col).cast("binary")), F.col(id_col))


def search(docs: DataFrame, items: DataFrame, t: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", least_words: int = 1) -> DataFrame:
    """(rid, rid2, doc_id, item_id, n_shared, n_shingles) of every document row that contains an item to the share ``t``."""
    spark = docs.sparkSession
    listed = materialize(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text"),
                                      F.size(F.regexp_extract_all(F.col(item_text).cast("string"), F.lit(_WORD), F.lit(0))).alias("n_words"))
                         .where(F.col("n_words") >= max(1, least_words)).withColumn("iid", F.xxhash64("text")).distinct(), "items")
    items = listed.select("iid", "text").dropDuplicates(["iid"])
    short = tuple(r.n_words for r in listed.where(F.col("n_words") < SHINGLE).select("n_words").distinct().collect())
    sketch = materialize(sketches(items.select("iid", "text"), t), "sketches")
    bits = spark.sparkContext.broadcast(filter_bits(sketch))
    texts = docs.select(row_key(id_col, text_col).alias("rid"), F.col(text_col).cast("binary").alias("text"))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = bits.value
        release()
        for batch in batches:
            for start, stop in blocks(batch, "text", PART_BYTES):
                part = batch.slice(start, stop - start)
                data, ends = raw_bytes(part.column("text"))
                size = np.zeros(len(part), np.int64)
                met = []
                # one long text goes in pieces; its size is then the sum of theirs, which is no less
                for d, e in ([(data, ends)] if len(data) <= PART_BYTES else (
                        (np.frombuffer(x, np.uint8), np.array([0, len(x)])) for x in pieces(data.tobytes(), SHINGLE - 1, PART_BYTES))):
                    row, h = shingle_hashes(d, e, short)
                    slot = (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                    hit = (flags[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                    size += np.bincount(row, minlength=len(part))
                    met.append((row[hit], h[hit]))
                row, h = (np.concatenate(x) for x in zip(*met, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("rid").take(pa.array(row)), pa.array(
                    h.view(np.int64)), pa.array(size[row].astype(np.int64))], ["rid", "h", "doc_size"])
        release()

    met = texts.select("rid", "text").mapInArrow(hits, "rid long, h long, doc_size long").join(by_rows(sketch), "h").where(
        F.col("doc_size") >= t * F.col("size") - 1e-9)
    found = materialize(met.groupBy("rid", "iid").agg(F.countDistinct("h").alias("n"), F.first("need").alias("need"))
                        .where("n >= need").select("rid", "iid"), "candidates")
    # every candidate has its item, so the left join is never built on the side of the documents
    lists = found.join(by_rows(items, NARROW_ROW + F.octet_length("text")), "iid", "left").groupBy("rid").agg(
        F.collect_list(F.struct("iid", F.col("text").alias("item"))).alias("items"))
    near = docs.select(row_key(id_col, text_col).alias("rid"), row_key(id_col, text_col, 1).alias("rid2"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).join(
        by_rows(materialize(found.select("rid").distinct(), "candidate_rows")), "rid", "left_semi")
    checked = near.join(lists, "rid").mapInArrow(
        _verify, "rid long, rid2 long, doc_id long, iid long, n_shared long, n_shingles long").where(
        F.col("n_shared") >= t * F.col("n_shingles") - 1e-9)
    return checked.join(by_rows(listed.select("iid", "item_id")), "iid").select(
        "rid", "rid2", "doc_id", "item_id", "n_shared", "n_shingles")


def contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment), once for each pair that meets the share."""
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shared", "n_shingles"))
    return search(docs, items, **how).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.n_shared", "b.n_shingles", "b.containment")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs``, all columns, without the rows that contain an item."""
    keys = [fresh(docs, "rid"), fresh(docs, "rid2")]
    bad = materialize(search(docs, items, id_col=id_col, text_col=text_col, **how).select(
        F.col("rid").alias(keys[0]), F.col("rid2").alias(keys[1])).distinct(), "contaminated")
    keyed = docs.withColumn(keys[0], row_key(id_col, text_col)).withColumn(keys[1], row_key(id_col, text_col, 1))
    return keyed.join(by_rows(bad), keys, "left_anti").select(*docs.columns)


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = f"""with d_words as (select doc_id, {_WORDS} w from documents),
b_words as (select item_id, {_WORDS} w from benchmark),
lengths as (select distinct least(5, len(w)) k from b_words where len(w) > 0),
d as (select distinct doc_id, array_to_string(w[i:i + k - 1], ' ') s
  from (select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) i from d_words, lengths where len(w) >= k)),
b as (select distinct item_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') s
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) i from b_words where len(w) > 0)),
sizes as (select item_id, count(*) n from b group by item_id),
both_ as (select doc_id, item_id, count(*) c from d join b using (s) group by doc_id, item_id)
select doc_id, item_id, c::bigint n_shared, n::bigint n_shingles, c / n containment
from both_ join sizes using (item_id) where c >= 0.8 * n"""


@register("op1_decontamination", SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
