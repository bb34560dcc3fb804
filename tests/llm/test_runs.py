import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

from edgefilter.llm import runs
from edgefilter.llm.common import table

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def plain_runs(words):
    """All runs, by trying every period and every stretch of matches."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i:i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def codes(words):
    names = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.array([names[w] for w in words], np.int64)


def test_runs_equal_brute_force():
    rng = random.Random(11)
    cases = [[], list("aaaaa"), list("aaaaaa"), list("abababab"), list("abcabcabcabcab"), list("a" * 40 + "b" + "a" * 41),
             list("aaab" * 9 + "aaaaaaa"), list("abaab" * 20 + "ab" * 20)]
    for _ in range(400):
        words = []
        while len(words) < rng.randint(1, 120):
            part = [rng.choice("ab" if rng.random() < .6 else "abcdef") for _ in range(rng.randint(1, 12))]
            words += part * rng.choice([1, 1, 2, 4, 5, 9])
        cases.append(words)
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    cases += [list(fib[-1]), list("ab" * 9) * 3 + list("abb" * 9)]
    for words in cases:
        assert runs.find_runs(codes(words), len(words)) == plain_runs(words), "".join(words)


def test_work_stays_sparse():
    n = 50_000
    one = np.zeros(n, np.int64)
    assert len(runs.matches(one, n)) < n and runs.find_runs(one, n) == [(0, n, 1)]
    turn = np.arange(n) % 3000
    assert len(runs.matches(turn, n)) < n and runs.find_runs(turn, n) == [(0, n, 3000)]


def test_words_of_several_texts():
    texts = [b"a b", b"", None, b"  ", b"c\x0bd\x85 e\xa0\n", b"f", b"g "]
    words, first = runs.split_words(pa.array(texts, pa.binary()))
    assert words.to_pylist() == [w for t in texts for w in WORD.findall(t or b"")]
    assert np.diff(first).tolist() == [len(WORD.findall(t or b"")) for t in texts]
    words, first = runs.split_words(pa.array([], pa.binary()))
    assert len(words) == 0 and first.tolist() == [0]


def want(doc_id, text):
    words = WORD.findall((text or "").encode())
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {tuple(r) for r in runs.op13_runs(spark, sf).collect()}
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert got == {want(*r) for r in docs if len((r[1] or "").split()) < 3000} | {
        r for r in got if r[0] in {d for d, t in docs if len((t or "").split()) >= 3000}}
    assert sum(r[1] > 0 for r in got) >= len(docs) / 20


def test_edge_rows(spark):
    twice = "x y " * 5 + "end"
    odd = spark.createDataFrame([(1, None, 0), (None, "", 1), (2, " \n ", 2), (3, twice, 3), (3, twice, 4)],
                                "doc_id long, text string, runs long")
    rows = runs.periodic_runs(odd).collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in rows),
                 key=lambda r: (r[0] is None, r[0] or 0))
    assert got == [(1, 0, [], b""), (2, 0, [], b""), (3, 11, [(0, 10, 2)], b"x y end"), (3, 11, [(0, 10, 2)], b"x y end"),
                   (None, 0, [], b"")]
    assert runs.periodic_runs(odd.where("false")).collect() == []


def test_very_long_text(spark):
    text = "a b c d e f g h " * 60_000 + "z"
    r = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, 480_000, 8)] and bytes(r.collapsed) == b"a b c d e f g h z"
