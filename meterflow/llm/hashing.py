"""Words of a batch of texts as 64-bit hashes, for a whole Arrow batch at a time.

A word is a maximal run of characters other than the ASCII white space
``\\x20 \\x09-\\x0D``. Its hash is a polynomial over its UTF-8 bytes modulo 2^64
with random byte values, followed by a mixing step; the same bytes always give the
same hash, in every batch and task. Work is done in slices of about ``SLICE``
bytes cut between words, so memory does not depend on the length of a text beyond
the result.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
#: The same for folded words: runs of ASCII letters and digits and of bytes beyond ASCII, A-Z as a-z.
_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _FOLDED[0x61:0x7B]
_FOLDED[_APART] = 0
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE + 4096), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in a new array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more at the end); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def give_back() -> None:
    """Return freed memory to the system, so that idle Python workers stay small."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, at least one row each."""
    _, at = utf8(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield low, min(high, len(texts))
        low = high


def words(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start, end) of every word of every text; start and end are byte offsets in ``utf8(texts)``.

    Folded words leave out ASCII punctuation and the case of ASCII letters.
    """
    apart, byte = (_APART, _FOLDED) if fold else (_SPACE, _BYTE)
    raw, at = utf8(texts)
    found = [], [], []
    low = 0
    while low < len(raw):
        high = min(len(raw), low + SLICE)
        # up to the next space or text end, so that no word is cut
        while high < len(raw) and not apart[raw[high]] and at[np.searchsorted(at, high)] != high:
            stop = min(int(at[np.searchsorted(at, high, "right")]), high + 4096)
            gaps = np.flatnonzero(apart[raw[high:stop]])
            high = high + int(gaps[0]) if len(gaps) else stop
        part = raw[low:high]
        inside = ~apart[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        edges = at[np.searchsorted(at, low) : np.searchsorted(at, high)] - low
        edges = edges[edges < len(part)]
        begins[edges] = inside[edges]
        edges = edges[edges > 0]
        stops[edges - 1] = inside[edges - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(stops)
        sums = np.cumsum(byte[part] * _power(_BASE, len(part))[: len(part)])
        before = np.where(first > 0, sums[first - 1], np.uint64(0))
        found[0].append(mix((sums[last] - before) * _power(_INVERSE, len(part))[first]))
        found[1].append(first + low)
        found[2].append(last + 1 + low)
        low = high
    if not found[0]:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    hashes, starts, ends = map(np.concatenate, found)
    return hashes, np.searchsorted(at, starts, "right") - 1, starts, ends


def windows(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every run of ``n`` words within one row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total *= np.uint64(_BASE)
        total += hashes[k : k + count]
    index = np.flatnonzero(rows[:count] == rows[n - 1 :])
    return mix(total[index]), index
