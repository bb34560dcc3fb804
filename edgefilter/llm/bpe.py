"""BPE encoding and decoding with forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can never be
joined by a merge, so it marks a certain cut. White space is such a place in
this vocabulary (no token holds any), so a text is first cut there; a piece
that was not met before is normalised and split as the tokenizer file says,
cut again wherever a byte pair is in no token, and every fragment is merged on
its own. The ids are the fragments' ids one after the other. Pieces and words
repeat, so each task keeps bounded tables of those it has met.

Decoding takes the ids back through the vocabulary; the file names no decoder,
so the tokens are joined by one space with their word-end marks.

Defined cases: a null or empty text has no token (ids and decoded text empty);
repeated rows are encoded each; null ids stay; other columns stay or are ignored,
and the results' names give way to theirs; a very long text is encoded whole, as a
block of its own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgefilter.llm.common import blocks, fresh, register, release, table

#: Entries of a task's table of pieces (and of words); a full table is emptied.
TABLE_ENTRIES = 300_000
#: Pieces and words above this length are merged each time they are met.
LONG = 256


class _Table(dict):
    """Text -> its ids in decimal joined by one space, worked out when first met; bounded."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key):
        out = " ".join(map(str, self.work(key)))
        if len(key) <= LONG:
            if len(self) >= TABLE_ENTRIES:
                self.clear()
            self[key] = out
        return out


class Codec:
    """Encoder and decoder of one tokenizer file of the `tokenizers` format (BPE with a word-end mark)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {str(i): t for t, i in [*self.ids.items(), *self.special.items()]}
        # the file's own normaliser and pattern: their Unicode tables decide what a letter is
        rules = Tokenizer.from_file(path)
        self.normalise = rules.normalizer.normalize_str
        self.split = rules.pre_tokenizer.pre_tokenize_str
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        inside = set()
        for token in self.ids:
            body = token.removesuffix(self.end)
            inside.update(zip(body, body[1:], strict=False))
        self.inside = inside
        self.words = _Table(self._plain_ids)
        self.symbol_words = _Table(self._word_ids)
        self.pieces = _Table(self._piece_ids)
        # Texts of ASCII and Latin-1 letters only: their normal form is their lower case, so the pattern can run
        # over the whole text at once. Anything else goes piece by piece through the file's own rules.
        self.plain = re.compile("[ \\t-\\r!-~À-ÖØ-öø-ÿ]*").fullmatch
        self.plain_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \\t-\\ra-z0-9ß-öø-ÿ]+").findall
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.symbols = {b: chr(b) for b in printable} | {
            b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(printable)))}

    # -- encoding ---------------------------------------------------------
    def _piece_ids(self, piece: bytes) -> list[str]:
        """Ids of a run of bytes without white space, as strings, word by word."""
        out: list[str] = []
        for part, token in self._specials(piece.decode("utf-8", "replace")):
            if token is not None:
                out.append(str(token))
            elif part:
                out += [self.symbol_words[w] for w, _ in self.split(self.normalise(part))]
        return out

    def _plain_ids(self, word: str) -> list[int]:
        return self._word_ids(word if word.isascii() else "".join(map(self.symbols.__getitem__, word.encode())))

    def _specials(self, piece: str) -> Iterator[tuple[str, int | None]]:
        """The piece cut at special tokens, first place first."""
        while True:
            at, name = min(((p, s) for s in self.special if (p := piece.find(s)) >= 0), default=(-1, ""))
            if at < 0:
                yield piece, None
                return
            yield piece[:at], None
            yield "", self.special[name]
            piece = piece[at + len(name):]

    def _word_ids(self, word: str) -> list[int]:
        """Ids of one word (in byte symbols), fragment by fragment."""
        out, start = [], 0
        for i, pair in enumerate(zip(word, word[1:], strict=False), 1):
            if pair not in self.inside:
                out += self._fragment_ids(word[start:i], False)
                start = i
        return out + self._fragment_ids(word[start:], True)

    def _fragment_ids(self, text: str, ends: bool) -> list[int]:
        if len(text) > 24:
            return self._merge(text, ends)
        sym = list(text)
        if ends:
            sym[-1] += self.end
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(p, none) for p in zip(sym, sym[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            sym[i] += sym.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((sym[i - 1], sym[i]), none)
            if i < len(ranks):
                ranks[i] = rank((sym[i], sym[i + 1]), none)
        return [self.ids[s] for s in sym]

    def _merge(self, text: str, ends: bool) -> list[int]:
        """Merges of lowest rank first, leftmost first, over a linked list with a heap of candidate pairs."""
        sym: list[str | None] = list(text)
        if ends:
            sym[-1] += self.end
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1)
                if (r := self.ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if sym[i] is not None else n
            if j >= n or sym[i] != left or sym[j] != right:
                continue            # an older entry; the pair has changed since
            sym[i], sym[j] = left + right, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                m = after[k] if k >= 0 else n
                if m < n and (r := self.ranks.get((sym[k], sym[m]))) is not None:
                    heapq.heappush(heap, (r, k, sym[k], sym[m]))
        return [self.ids[s] for s in sym if s is not None]

    def encode(self, text: bytes) -> str:
        """Decimal ids of a whole UTF-8 text joined by one space."""
        chars = text.decode("utf-8", "replace")
        if self.plain(chars) and not any(s in chars for s in self.special):
            return " ".join(map(self.words.__getitem__, self.plain_words(chars.lower())))
        return " ".join(filter(None, map(self.pieces.__getitem__, text.split())))

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: str) -> str:
        return " ".join(map(self.tokens.__getitem__, ids.split(" "))) if ids else ""


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, built once in each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, names: tuple[str, str] = ("ids", "decoded"),
           digests: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col`` (decimal, joined by spaces), their number and the decoded text.

    ``keep`` lists the columns to carry (all by default). With ``digests`` the
    SHA-256 of ids and decoded text stand in place of the texts themselves, and
    no long column leaves Python.
    """
    path = path or default_path()
    keep = docs.columns if keep is None else keep
    kept = [docs.schema[c] for c in keep]
    carried = docs.select(*keep)
    out_names = [fresh(carried, n) for n in ("n_tokens", *(f"{n}_sha256" if digests else n for n in names))]
    schema = T.StructType([*kept, T.StructField(out_names[0], T.LongType()),
                           *(T.StructField(n, T.StringType()) for n in out_names[1:])])
    text = fresh(docs, "text_bytes")
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        c = codec(path)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start, stop in blocks(batch, text):
                part = batch.slice(start, stop - start)
                counts, firsts, seconds = [], [], []
                for value in part.column(at):
                    ids = c.encode(value.as_py() or b"")
                    back = c.decode(ids)
                    counts.append(ids.count(" ") + 1 if ids else 0)
                    firsts.append(hashlib.sha256(ids.encode()).hexdigest() if digests else ids)
                    seconds.append(hashlib.sha256(back.encode()).hexdigest() if digests else back)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(counts, pa.int64()), pa.array(firsts, pa.string()),
                     pa.array(seconds, pa.string())], [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


@register("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True, keep=["doc_id"])
