"""Hashed word shingles of whole texts, vectorised over the bytes of an Arrow batch.

A word is ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a shingle is
five words in a row; a text with fewer words is one shingle. Words and
shingles are 64-bit hashes, so equal texts of words always agree and two
different shingles agree with a chance of about 5e-20.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import kept_by

SIZE = 5
PIECE_BYTES = 1 << 18  # bytes hashed at once; a longer text is hashed alone, in full

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def _bytes_table() -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=U) * U(_BASE))
    t[65:91] = t[97:123]
    t[[0x20, *range(0x09, 0x0E)]] = U(0)
    return t


_TABLE = _bytes_table()
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = [int(mix(np.array([i + 1], U))[0]) | 1 for i in range(SIZE)]


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    powers = kept_by("shingles")
    if n > powers.get("n", 0):
        with np.errstate(over="ignore"):
            for k, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                p = np.full(n, U(base))
                p[0] = 1
                powers[k] = np.multiply.accumulate(p)
        powers["n"] = n
    return powers["up"], powers["down"]


def _hashed(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, repeats included, in order."""
    n = len(data)
    if not n:
        yield from (np.empty(0, U) for _ in range(len(offsets) - 1))
        return
    up, down = _powers_of(n)
    blank = _BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | edge[:n]))
    if not len(starts):
        yield from (np.empty(0, U) for _ in range(len(offsets) - 1))
        return
    w = mix(np.add.reduceat(_TABLE[data] * up[:n], starts) * down[starts])
    first = np.searchsorted(starts, offsets)
    grams = sum((w[i:len(w) - SIZE + 1 + i] * U(_PLACES[i]) for i in range(SIZE)), U(0)) if len(w) >= SIZE else np.empty(0, U)
    grams = mix(grams)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SIZE:
            yield grams[a:b - SIZE + 1]
        elif b > a:
            yield mix(np.array([sum(int(w[a + i]) * _PLACES[i] for i in range(b - a)) + (b - a) & (1 << 64) - 1], U))
        else:
            yield np.empty(0, U)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty for null and wordless texts."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1
        j = min(max(j, i + 1), len(texts))
        for grams in _hashed(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]):
            yield np.unique(grams)
        i = j


def identity(grams: np.ndarray) -> int:
    """One even signed 64-bit number for a whole set; equal sets agree. The last bit is free for a mark."""
    x = mix(np.array([int(mix(grams ^ U(0xA5A5A5A55A5A5A5A)).sum()) + len(grams) & (1 << 64) - 1], U))
    return int(x.view(np.int64)[0]) & ~1
