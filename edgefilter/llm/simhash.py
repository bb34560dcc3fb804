"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into only two halves: of three differing bits one
half holds at most one. Every half is indexed as it is and once for every bit
with that bit wiped (a one-wildcard variant), so fingerprints within reach
meet in an equality join and are verified by ``bit_count(a ^ b)``.

A crowded bucket (many distinct fingerprints under one variant) is not paired
directly: its members are indexed again by the variants of the two 16-bit
parts of the other half, and once more by 8-bit parts. A bucket of the last
level leaves 11 bits free, which bounds it by 2,048 members at any input size.
Equal fingerprints are one member throughout, so copies never pair up.

Defined cases: a null text is an empty one, fingerprint zero; a null doc_id
takes part in linking but is never a component's id unless all are null;
repeated rows each come out; an empty table gives an empty result; other
columns are ignored by ``simhash_components`` and kept by ``simhash_dedup``,
whatever their names; very long texts are hashed whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import NARROW_ROW, by_rows, fresh, register, table
from edgefilter.llm.components import components
from edgefilter.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
CROWDED = 128
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text: a bit is set where over half of the shingle hashes have it."""
    words = text.lower().split()            # bytes: only A-Z are lowered, only \\x09-\\x0D and \\x20 split
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        stop = min(n, start + _CHUNK)
        grams = zip(*(words[start + j:stop + j] for j in range(k)), strict=True)
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in map(b" ".join, grams)], np.dtype(">u8"))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint",
                      shingle_words: int = SHINGLE_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text_col`` as a new column."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py() or b"", shingle_words) for t in texts], np.uint64)
            cols = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps.view(np.int64), pa.int64())],
                                             [*(f.name for f in kept), name])

    return docs.mapInArrow(run, schema)


def _key(i: Column, v: Column) -> Column:
    """Bucket of a part's value with bit ``i`` wiped (as it is for -1)."""
    wiped = F.when(i < 0, v).otherwise(v.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    return F.xxhash64("key", "part", i, wiped)


def _index(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame | None]:
    """Index rows (key, side, fp, shift, r0, r1) of the two parts of ``width`` bits from ``shift`` up; crowded keys.

    ``side`` is 2 under the part as it is, else the wiped bit; ``shift`` is then
    the place of the part that remains, ``r0`` and ``r1`` the sides of earlier levels.
    """
    parts = F.array(*(F.struct(F.lit(j).alias("part"), (F.col("shift") + j * width).alias("low"),
                               (F.col("shift") + (1 - j) * width).alias("rest")) for j in (0, 1)))
    cut = rows.withColumn("p", F.explode(parts)).select(
        "key", "fp", "r0", "r1", F.col("p.part").alias("part"), F.col("p.rest").alias("shift"),
        F.expr(f"shiftrightunsigned(fp, p.low) & {(1 << width) - 1}L").alias("v"))
    values = cut.groupBy("key", "part", "v").agg(F.count("*").alias("n"))
    big = materialize(values.where(F.col("n") > CROWDED), "big_values")
    every = F.sequence(F.lit(-1), F.lit(width - 1))
    crowded = None
    if big.isEmpty():
        cut = cut.withColumn("i", F.explode(every))
    else:
        # a big value is wiped only where the neighbouring value exists at all
        near = by_rows(big, width * NARROW_ROW).withColumn(
            "i", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).withColumn("w", F.expr("v ^ shiftleft(1L, i)"))
        near = materialize(near.join(values.select("key", "part", F.col("v").alias("w"), F.col("n").alias("m")),
                                     ["key", "part", "w"]), "big_neighbours")
        crowded = materialize(
            big.select(_key(F.lit(-1), F.col("v")).alias("key")).union(
                near.where(F.col("n") * F.col("m") > CROWDED ** 2).select(_key(F.col("i"), F.col("v")).alias("key")))
            .distinct(), "crowded")
        allowed = near.groupBy("key", "part", "v").agg(F.collect_list("i").alias("some"))
        allowed = materialize(big.join(allowed, ["key", "part", "v"], "left").select(
            "key", "part", "v", F.concat(F.array(F.lit(-1)), F.coalesce("some", F.array().cast("array<int>")))
            .alias("some")), "big_wiped")
        cut = cut.join(by_rows(allowed, 4 * NARROW_ROW), ["key", "part", "v"], "left").withColumn(
            "i", F.explode(F.coalesce("some", every)))
    side = F.when(F.col("i") < 0, 2).otherwise(F.expr("cast(shiftrightunsigned(v, greatest(i, 0)) & 1 as int)"))
    index = cut.select(_key(F.col("i"), F.col("v")).alias("key"), side.alias("side"), "fp", "shift", "r0", "r1")
    return index, crowded


def _pairs(index: DataFrame) -> DataFrame:
    """Verified links inside the buckets; equal parts pair among themselves, wiped bits with their opposites."""
    a = index.where("side <> 1").select("key", F.col("side").alias("sa"), F.col("fp").alias("a"),
                                        F.col("r0").alias("p0"), F.col("r1").alias("p1"))
    b = index.where("side <> 0").select("key", F.col("side").alias("sb"), F.col("fp").alias("b"),
                                        F.col("r0").alias("q0"), F.col("r1").alias("q1"))
    opposite = "(({0} = 2 and {1} = 2) or {0} + {1} = 1)"
    # the rows that an explode made of a fingerprint (66) are in no estimate, so b could be broadcast as if small
    return a.join(b.hint("merge"), "key").where(
        f"bit_count(a ^ b) <= {MAX_BITS} and ((sa = 0 and sb = 1) or (sa = 2 and sb = 2 and a < b))"
        f" and {opposite.format('p0', 'q0')} and {opposite.format('p1', 'q1')}").select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints of ``fps`` (one column ``fp``) within three bits."""
    two = F.lit(2)
    rows = fps.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("shift"), two.alias("r0"),
                      two.alias("r1"))
    found = []
    for level, width in enumerate((32, 16, 8)):
        index, crowded = _index(rows, width)
        if crowded is None or level == 2:
            found.append(_pairs(index))
            break
        crowded = by_rows(crowded)
        found.append(_pairs(index.join(crowded, "key", "left_anti")))
        rows = materialize(index.join(crowded, "key", "left_semi")
                           .withColumn(f"r{level}", F.col("side")).drop("side"), "crowded_members")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def group_roots(fps: DataFrame, id_col: str) -> DataFrame:
    """(fp, component_id, least) of every distinct ``fp``: smallest id that its component reaches.

    ``least`` is the smallest fingerprint of the component, its key.
    """
    nodes = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "nodes")
    roots = materialize(components(links(nodes.select("fp"))), "roots")
    placed = nodes.join(by_rows(roots), nodes["fp"] == roots["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("least"))
    # written before the join back, so that a component of very many members is split by AQE
    least = materialize(placed.groupBy("least").agg(F.min("rep").alias("component_id")), "least")
    return materialize(placed.join(by_rows(least), "least", "left").select("fp", "component_id", "least"), "groups")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fps = materialize(with_fingerprints(rows, "text", "fp", shingle_words, keep_text=False), "fingerprints")
    groups = group_roots(fps, "doc_id")
    # every fingerprint has its group; a left join is never built on the side of the documents
    return fps.join(by_rows(groups), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, of equal ids one row.

    All columns are kept. Rows are told apart by a number given before they are
    written, so equal rows and null ids leave exactly one row a component too.
    """
    fp, rid = fresh(docs, "fp"), fresh(docs, "row_number")
    rows = materialize(with_fingerprints(docs.withColumn(rid, F.monotonically_increasing_id()), text_col, fp,
                                         shingle_words), "fingerprinted")
    ids = rows.select(F.col(fp).alias("fp"), F.col(rid).alias("rid"), F.col(id_col).alias("id"))
    groups = group_roots(ids, "id")
    first = F.min(F.struct(F.col("id").isNull(), "id", "rid"))
    best = ids.groupBy("fp").agg(first.alias("f")).join(by_rows(groups.select("fp", "least")), "fp")
    kept = materialize(best.groupBy("least").agg(F.min("f").alias("f")).select(F.col("f.rid").alias("rid")), "kept")
    dropped = materialize(ids.select("rid").join(by_rows(kept), "rid", "left_anti"), "dropped")
    return rows.join(by_rows(dropped), rows[rid] == dropped["rid"], "left_anti").select(*docs.columns)


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
