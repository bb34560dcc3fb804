import sys

import pytest

import corpus_pipeline as P

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_decontaminate import brute as brute_contaminated  # noqa: E402
from test_simhash import brute as brute_components  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")
HEX = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"


def test_stages_equal_plain_versions(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    odd = [(9001, None), (9002, "12 34 !!"), (9003, f'the house of the cat token = "{HEX}" and the dog'),
           (9004, items[0][1] + " and more of the same"), (9004, items[0][1] + " and more of the same"),
           (None, "a text that has no id at all"), (None, "a text that has no id at all")]
    extra = spark.createDataFrame(odd, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'s' source", "length(text) n_chars")
    documents = docs.unionByName(extra.select([extra[c].cast(docs.schema[c].dataType) for c in docs.columns]))
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in P.run(spark, str(tmp_path)).collect()), key=str)

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    kept, seen = [], set()
    for (i, t), (_, _, least) in sorted(zip(rows, brute_components(rows)), key=str):
        if i == least and (least, "x" if i is not None else t) not in seen:
            seen.add((least, "x" if i is not None else t))
            kept.append((i, t))
    kept = [d for d in kept if not brute_contaminated([d], items)]
    library = tokenizers.Tokenizer.from_file(P.bpe.default_path())
    want = []
    import re
    for i, t in kept:
        clean = re.sub(r'(?<=token = ")[0-9a-f]{40}(?=")', "[SECRET]", t)
        ids = library.encode(clean, add_special_tokens=False).ids
        want.append((i, len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    assert not any(HEX in g[3] for g in got) and 9004 not in [g[0] for g in got]



def test_empty_input(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_language_stage_fills_a_null_lang(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null and lang is not null")
    gone = docs.selectExpr(*[f"cast(null as string) {c}" if c == "lang" else c for c in docs.columns])
    mixed = docs.where("doc_id % 4 <> 1").unionByName(gone.where("doc_id % 4 = 1"))
    true = {r.doc_id: r.lang for r in docs.collect()}
    out = P.language(spark, mixed, "")
    assert out.columns == docs.columns
    got = {r.doc_id: r.lang for r in out.collect()}
    assert set(got) == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    filled = [i for i in got if i % 4 == 1]
    assert filled and None not in got.values() and all(got[i] == true[i] for i in got if i % 4 != 1)
    assert sum(got[i] == true[i] for i in filled) >= 0.9 * len(filled)
    # nothing to learn from: no language is made up, and no text dropped
    bare = P.language(spark, gone, "").collect()
    assert {r.doc_id for r in bare} == set(got) and all(r.lang is None for r in bare)
