"""Vectorised word spans, span hashes and sliding minima over blocks of UTF-8 bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15 | 1
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NEWLINES = np.arange(256) == 0x0A
#: Powers that a worker keeps in any case: a block's.
_KEPT = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of them (kept for later calls)."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n or len(have[0]) > max(_KEPT, 2 * n):      # a long text's table is not kept
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            out.append(np.cumprod(p))
        have = _powers[0] = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing step that spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sums:
    """Prefix sums from which the hash of any span of ``values`` follows at once."""

    def __init__(self, values: np.ndarray):
        up, self.down = _power_tables(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * up[:len(values)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts] + (stops - starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all spans of ``k`` values, by their first place."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n] + np.uint64(k))


def words(data: np.ndarray, ends: np.ndarray, gaps: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-plus-one byte of every word of texts that lie end to end, and the words before each text's end.

    A word is a run of bytes that ``gaps`` doesn't flag, by default other than space and \\x09-\\x0D; it never crosses texts.
    """
    inside = ~gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, stops, np.searchsorted(starts, ends)


def pieces(text: bytes, overlap: int, max_bytes: int) -> Iterator[bytes]:
    """A text cut between words into parts of about ``max_bytes``; each repeats the last ``overlap`` words of the one before.

    So every sequence of ``overlap`` + 1 words lies in one part. A part is longer only if its words are.
    """
    start, size = 0, max_bytes
    while start + size < len(text):
        gap = _GAP.search(text, start + size)
        stop = gap.start() if gap else len(text)
        parts = text[start:stop].rsplit(None, overlap)
        if stop == len(text):
            break
        if len(parts) <= overlap or not parts[0].strip():      # too few words to go on with
            size = stop - start + max_bytes
            continue
        yield text[start:stop]
        start, size = start + len(parts[0]), max_bytes
    yield text[start:]


def _sliding(x: np.ndarray, width: int, fold) -> np.ndarray:
    span, out = 1, x
    while span * 2 <= width:
        out = fold(out[:-span], out[span:])
        span *= 2
    return fold(out[:len(x) - width + 1], out[width - span:]) if span < width else out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by their first place (nothing if there are fewer)."""
    return _sliding(x, width, np.minimum) if len(x) >= width else x[:0]


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    return _sliding(x, width, np.maximum) if len(x) >= width else x[:0]
