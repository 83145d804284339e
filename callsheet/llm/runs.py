"""Periodic runs of words: recompression grammar, longest-common-extension queries, harmonic-grid candidates.

A run is a stretch of words with smallest period q, at least ``MIN_POWERS``
periods and ``MIN_LENGTH`` words long, that neither neighbour extends. Where
word i equals word i + q for a whole stretch of (MIN_POWERS - 1) * q places,
one of them is a multiple of (MIN_POWERS - 1) * q: so for each q only those
places (a harmonic number of them in all) are candidates. What stands there and
q further is extended exactly in both directions.

Extensions come from a run-length grammar of the words by recompression. Block
compression replaces each maximal block of one symbol by a symbol for (symbol,
length); pair compression splits the symbols in two halves by a hash and
replaces each left symbol with a right one after it. Both depend on what is
replaced alone, so equal stretches are replaced alike up to their ends. Two
places are compared by climbing levels while both stand at the starts of equal
symbols, stepping over at most one replaced piece a level, and coming down
where the symbols differ: a bounded number of steps a level. Extensions to the
left use the same levels read backwards.

Texts are worked in batches: all words of a batch are one sequence with a mark
of its own around each text, which no symbol crosses. All steps are array
operations over the batch. A batch holds ``BATCH_WORDS`` words, or one longer text.

Defined results: null and empty texts have no words and no runs; a null doc_id
deals no repetition; repeated rows are worked one by one; an empty table gives
no rows; extra columns are ignored. Memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, ship

MIN_LENGTH = 6
MIN_POWERS = 4
BATCH_WORDS = 400_000
_CHUNK = 1 << 20  # candidates looked at together


@dataclass
class Level:
    """A sequence of symbols and how the next level's symbols cover it."""

    symbols: np.ndarray
    first: np.ndarray | None = None  # of each symbol of the next level: its first piece here, with an end mark
    above: np.ndarray | None = None  # of each symbol here: its number in the next level
    blocks: bool = False  # pieces of a symbol of the next level are all equal

    def cover(self, starts: np.ndarray, blocks: bool) -> None:
        n = len(self.symbols)
        self.first = np.append(np.flatnonzero(starts), n).astype(np.int32)
        self.above = np.cumsum(starts, dtype=np.int32) - 1
        self.blocks = blocks

    def backwards(self) -> Level:
        if self.first is None:
            return Level(self.symbols[::-1])
        n = len(self.symbols)
        return Level(self.symbols[::-1], (n - self.first[::-1]).astype(np.int32),
                     (len(self.first) - 2 - self.above[::-1]).astype(np.int32), self.blocks)


def _half(symbols: np.ndarray, level: int) -> np.ndarray:
    """Which of two halves a symbol is in: a bit of a hash of its number and the level."""
    x = (symbols.astype(np.uint64) + np.uint64(level << 32)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(bool)


def grammar(symbols: np.ndarray, mark: np.ndarray) -> list[Level]:
    """The levels over a sequence; ``mark`` tells the symbols around the texts, each there once.

    Ends when nearly all texts are one symbol.
    """
    alone = int(mark.sum() + (mark[:-1] & ~mark[1:]).sum())
    now, marked, named = symbols.astype(np.int64), mark, int(symbols.max(initial=0)) + 1
    levels = [Level(now)]
    while len(now) > alone + alone // 16:
        if len(levels) % 2:  # blocks of one symbol
            starts = np.append(True, now[1:] != now[:-1])
            levels[-1].cover(starts, True)
            at = levels[-1].first
            size = np.diff(at).astype(np.int64)
            after = now[at[:-1]].copy()
            several = np.flatnonzero(size > 1)
            if len(several):
                _, name = np.unique(after[several] * (int(size.max()) + 1) + size[several], return_inverse=True)
                after[several] = named + name
                named += int(name.max()) + 1
        else:  # a symbol of one half and the next of the other
            left = _half(now, len(levels))
            joins = np.append(left[:-1] & ~left[1:] & ~marked[:-1] & ~marked[1:], False)
            starts = np.append(True, ~joins[:-1])
            levels[-1].cover(starts, False)
            at = levels[-1].first[:-1]
            after = now[at].copy()
            pairs = np.flatnonzero(joins[at])
            if len(pairs):
                _, name = np.unique(now[at[pairs]] * named + now[at[pairs] + 1], return_inverse=True)
                after[pairs] = named + name
                named += int(name.max()) + 1
        marked, now = marked[levels[-1].first[:-1]], after
        levels.append(Level(now))
    return levels


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of places, how many symbols from there on are equal (both lie in one text, or at its marks)."""
    i, j = i.astype(np.int32), j.astype(np.int32)
    start, out_at = i.copy(), np.arange(len(i))
    turned: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # at each level, who found a difference there
    for level in levels:
        s = level.symbols
        same = s[i] == s[j]
        if level.above is None:
            while same.any():  # the last level has few symbols a text
                i, j = i + same, j + same
                same = s[i] == s[j]
            turned.append((out_at, i, j))
            break
        over_i, over_j = level.above[i], level.above[j]
        inner = same & ((level.first[over_i] < i) | (level.first[over_j] < j))
        if inner.any():
            # not both at the start of a piece: over what is left of it
            step = np.where(inner, np.minimum(level.first[over_i + 1] - i, level.first[over_j + 1] - j), 0).astype(np.int32)
            i, j = i + step, j + step
            over_i, over_j = level.above[i], level.above[j]
            same &= ~inner | (level.first[over_i] == i) & (level.first[over_j] == j)
        turned.append((out_at[~same], i[~same], j[~same]))
        out_at, i, j = out_at[same], over_i[same], over_j[same]
        if not len(i):
            break
    out = np.zeros(len(start), np.int32)
    at, i, j = turned.pop()
    for depth in range(len(turned) - 1, -1, -1):
        level = levels[depth]
        s, over_i, over_j = level.symbols, i, j
        i, j = level.first[i], level.first[j]
        same = s[i] == s[j]
        if same.any():
            step = np.minimum(level.first[over_i + 1] - i, level.first[over_j + 1] - j) if level.blocks else 1
            step = np.where(same, step, 0).astype(np.int32)
            i, j = i + step, j + step
        more = turned[depth]
        at, i, j = (np.concatenate(x) for x in zip((at, i, j), more, strict=True))
    out[at] = i - start[at]
    return out


def _grid(begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all candidates, about ``_CHUNK`` at a time: each text's periods, each period's multiples."""
    step = MIN_POWERS - 1
    longest = size // MIN_POWERS  # the largest period of a text
    periods = int(longest.sum())
    ends = np.cumsum(longest)
    for low in range(0, periods, _CHUNK // 4):
        number = np.arange(low, min(low + _CHUNK // 4, periods))
        text = np.searchsorted(ends, number, "right")
        period = number - (ends[text] - longest[text]) + 1
        places = (size[text] - period - 1) // (step * period) + 1
        cut = np.flatnonzero(np.diff(np.cumsum(places) // _CHUNK, prepend=0))
        for part in np.split(np.arange(len(number)), cut):
            if not len(part):
                continue
            n = places[part]
            row = np.repeat(part, n)
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            yield text[row], begin[text[row]] + place * (step * period[row]), period[row]


def find_runs(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start, length and period of all runs, by text, start and period.

    ``words`` are the numbers of all texts' words, text after text, and
    ``size`` how many each text has.
    """
    texts = len(size)
    after = np.cumsum(size + 1)  # each text's mark; the sequence starts with one more
    begin = after - size
    mark = np.zeros(len(words) + texts + 1, bool)
    mark[0] = mark[after] = True
    symbols = np.empty(len(mark), np.int64)
    symbols[~mark] = words
    symbols[mark] = int(words.max(initial=0)) + 1 + np.arange(texts + 1)
    found = []
    for text, place, period in _grid(begin, size):
        equal = symbols[place] == symbols[place + period]
        found.append((text[equal].astype(np.int32), place[equal].astype(np.int32), period[equal].astype(np.int32)))
    text, place, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int32),) * 3
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    levels = grammar(symbols, mark)
    right = _extended(levels, place, place + period)
    # backwards, the word before a place is that many from the end
    left = _extended([x.backwards() for x in levels], len(symbols) - place, len(symbols) - place - period)
    start, length = place - left, left + right + period
    good = length >= np.maximum(MIN_LENGTH, MIN_POWERS * period)
    text, start, length, period = text[good], start[good], length[good], period[good]
    # a stretch is met from several places, and with multiples of its smallest period
    order = np.lexsort((period, length, start))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[:len(start)]
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return text[order], start[order] - begin[text[order]], length[order], period[order]


def _extended(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.concatenate([common_extension(levels, i[k:k + _CHUNK], j[k:k + _CHUNK]) for k in range(0, len(i), _CHUNK)])


def dealt_repeats(doc_id: int | None, words: list) -> list:
    """The words, with a periodic tail where crc32 of the id deals one."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * -(-(n - a) // p))[:n - a]


def _described(doc_id: int | None, words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    runs = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = words
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(listed).hexdigest(), b" ".join(kept), runs)


def described(rows: list[tuple[int | None, list[bytes]]]) -> Iterator[tuple]:
    """Of each (doc_id, words): id, number of runs, the longest run, the hash of all, the kept words, the runs."""
    size = np.array([len(w) for _, w in rows], np.int64)
    names = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(w for _, w in rows)))}
    numbers = np.fromiter(map(names.__getitem__, chain.from_iterable(w for _, w in rows)), np.int64, int(size.sum()))
    text, start, length, period = find_runs(numbers, size)
    bounds = np.searchsorted(text, np.arange(len(rows) + 1))
    for k, (doc_id, words) in enumerate(rows):
        a, b = bounds[k], bounds[k + 1]
        yield _described(doc_id, words, start[a:b], length[a:b], period[a:b])


def _batches(parts: Iterator[pa.RecordBatch], deal: bool) -> Iterator[list]:
    rows, held = [], 0
    for b in parts:
        for doc_id, text in zip(b.column(0), b.column(1), strict=True):
            doc_id, words = doc_id.as_py(), (text.as_py() or "").encode().split()
            rows.append((doc_id, dealt_repeats(doc_id, words) if deal else words))
            held += len(words)
            if held >= BATCH_WORDS:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FULL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
        "collapsed_sha256 string")


def collapsed(docs: DataFrame, deal: bool = False) -> DataFrame:
    """doc_id, the runs (start, length, period) and the text with each run cut to its first period."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("text", pa.string())])

    def run(parts):
        for rows in _batches(parts, deal):
            got = [(r[0], [dict(zip(("start", "length", "period"), x, strict=True)) for x in r[-1]], r[-2].decode()) for r in described(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), schema.types, strict=True)], schema=schema)

    return documents(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string")


def run_digests(docs: DataFrame, deal: bool = False) -> DataFrame:
    """One row per document: its runs' number, the longest, and hashes of all runs and of the collapsed text."""
    ship(docs.sparkSession)
    schema = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in (x.split()[0] for x in FULL.split(", "))])

    def run(parts):
        for rows in _batches(parts, deal):
            got = [(*r[:7], hashlib.sha256(r[7]).hexdigest()) for r in described(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), schema.types, strict=True)], schema=schema)

    return documents(docs, "doc_id", "text").mapInArrow(run, FULL)
