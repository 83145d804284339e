"""Toxicity: cumulative-link ordinal regression over sparse word and stem features.

Labels only say toxic or not; ordered severity grades come from the labelled
rows themselves: grade 0 is not toxic, and a toxic text is graded 1, 2 or 3 by
how often it uses words or stems that are mostly found in the other toxic rows.
One weight per feature is shared by all thresholds:
P(grade > k) = sigmoid(w.x - t_k), with t_0 < t_1 < t_2. The output is the
expected grade, the sum of these chances.

Features are all words and their stems (first 4, 5 and 6 letters), hashed, with
value 1 + log(count) times the strength of the feature's tie to the label: its
log odds, shrunk towards the base rate by ``PRIOR_ROWS`` rows. None is left out;
a ridge holds the weights down, so nothing switches on or off with the number
of labelled rows. Both labels weigh the same in the fit. The thresholds are
then moved so that P(grade > 0) = 0.5 lies where ``FOLDS``-fold held-out scores
separate the labels best (F1); a fold whose other folds lack a label has none.

The model is fitted on at most ``MAX_TRAINING`` labelled rows, those with the
lowest hash of their id; of rows that repeat an id the text of lowest hash trains.
Every text is scored whole.

Defined results: null and empty texts score like a text without known words;
null labels and labels without a document are no training rows; with no
labelled rows, or labels of one kind only, nothing is toxic; repeated
rows are scored one by one; extra columns stay, but ``expected_severity``,
``severity`` and ``toxic`` are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_batches, documents, kept_by, one_text_each, ship
from .shingles import U, mix

MAX_TRAINING = 8000
STEMS = (4, 5, 6)  # first letters of a word that are a feature
KIND_BITS = 19  # hash places of each kind of feature (stems by length, whole words)
KINDS = len(STEMS) + 1
PLACES = KINDS << KIND_BITS
BLOCK = 1 << 19  # features that a pass of the fit holds at a time
PRIOR_ROWS = 2.0  # rows of the base rate that a feature's share of toxic rows is shrunk by
GRADE_STEPS = (3, 6)  # uses of toxic words from which a toxic text is grade 2, 3
GRADES = 3
RIDGE = 0.1
FOLDS = 5

_LETTER_PLACES = [int(mix(np.array([i + 11], U))[0]) | 1 for i in range(max(STEMS))]


def _is_letter(codes: np.ndarray) -> np.ndarray:
    tables = kept_by("toxicity")
    if "letters" not in tables:
        tables["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return tables["letters"][codes]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of the lower-cased text's features; a word is a run of letters."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _is_letter(codes)
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1 - start
    code = mix((codes + 1).astype(U))
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    word = np.add.reduceat(mix(code[letter] + place.astype(U) * U(0x9E3779B97F4A7C15)), first)
    found, stem = [], np.zeros(len(start), U)
    for k in range(max(STEMS)):
        more = size > k
        start, size, stem = start[more], size[more], stem[more]
        stem = stem + code[start + k] * U(_LETTER_PLACES[k])
        if k + 1 in STEMS:
            found.append(mix(stem + U(k)))
    found.append(mix(word + U(99)))
    return np.unique(np.concatenate([(h >> U(64 - KIND_BITS)).astype(np.int64) + (kind << KIND_BITS)
                                     for kind, h in enumerate(found)]), return_counts=True)


@dataclass
class OrdinalModel:
    """``weights`` by feature number (none: no text has a known feature)."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES, 20.0))

    def chances(self, texts: pd.Series) -> np.ndarray:
        """P(grade > k) by row and k."""
        z = np.zeros(len(texts))
        for i, text in enumerate(texts if len(self.weights) else ()):
            at, count = features(text)
            z[i] = self.weights[at] @ (1 + np.log(count))
        return _sigmoid(z[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    # a library's product starts threads, whose waiting costs more than vectors of this size
    return float((a * b).sum())


def _lowest(loss: Callable, p: np.ndarray, steps: int, kept: int = 8) -> np.ndarray:
    """Where the convex-like loss (value and slope of p) is lowest: L-BFGS with a halved step."""
    value, slope = loss(p)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, along = slope.copy(), []
        for s, y in reversed(moves):
            along.append(_dot(s, q) / _dot(s, y))
            q -= along[-1] * y
        q *= _dot(*moves[-1]) / _dot(moves[-1][1], moves[-1][1]) if moves else 1 / max(np.sqrt(_dot(slope, slope)), 1e-12)
        for (s, y), a in zip(moves, reversed(along), strict=True):
            q += s * (a - _dot(y, q) / _dot(s, y))
        step, down = 1.0, _dot(slope, q)
        while (got := loss(p - step * q))[0] > value - 1e-4 * step * down and step > 1e-6:
            step /= 2
        if got[0] >= value:
            break
        s, y = -step * q, got[1] - slope
        if _dot(s, y) > 1e-14:
            moves = [*moves[1 - kept:], (s, y)]
        p, gain, (value, slope) = p + s, value - got[0], got
        if gain < 1e-6 * value:
            break
    return p


def _gaps(p: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(p, -30, 30))


@dataclass
class Sample:
    """Training rows: the features of all, row after row, in four bytes and the count's few.

    All passes go over blocks of whole rows, about ``BLOCK`` features at a
    time, so memory beyond the rows themselves is a block and a few vectors
    of one number per feature.
    """

    lens: np.ndarray
    col: np.ndarray  # places in ``used``
    count: np.ndarray
    toxic: np.ndarray
    used: np.ndarray  # the feature numbers that occur

    def __post_init__(self) -> None:
        self.logs = 1 + np.log(np.maximum(np.arange(int(self.count.max(initial=0)) + 1), 1)) if self.count.max(initial=0) < 1 << 20 else None

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """rows, and of each of their features the row (from 0), its column and its value."""
        ends = np.cumsum(self.lens)
        row = 0
        while row < len(self.lens):
            first = int(ends[row] - self.lens[row])
            after = max(row + 1, int(np.searchsorted(ends, first + BLOCK, "right")))
            at = slice(first, int(ends[after - 1]))
            count = self.count[at]
            yield (slice(row, after), np.repeat(np.arange(after - row), self.lens[row:after]), self.col[at],
                   self.logs[count] if self.logs is not None else 1 + np.log(count))
            row = after

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Of each row, with a weight for each column."""
        z = np.zeros(len(self.lens))
        for rows, own, col, value in self.blocks():
            z[rows] = np.bincount(own, value * weights[col], rows.stop - rows.start)
        return z

    def strength(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each column the tie to the label in the kept rows; of each row its grade by them."""
        n, k = np.zeros(len(self.used)), np.zeros(len(self.used))
        for rows, own, col, _ in self.blocks():
            n += np.bincount(col, keep[rows][own], len(n))
            k += np.bincount(col, (keep & (self.toxic == 1))[rows][own], len(n))
        base = self.toxic[keep].mean()
        share = (k + PRIOR_ROWS * base) / (n + PRIOR_ROWS)
        # of each toxic row: uses of features whose other rows are mostly toxic, by the kind that has most
        tied = (k - 1 + PRIOR_ROWS * base) / (np.maximum(n, 1) - 1 + PRIOR_ROWS) > 0.5
        kind = self.used >> KIND_BITS
        uses = np.zeros(len(self.lens))
        done = 0
        for rows, own, col, value in self.blocks():
            count = self.count[done:done + len(col)]
            done += len(col)
            among = tied[col]
            uses[rows] = np.bincount(own[among] * KINDS + kind[col[among]], count[among], (rows.stop - rows.start) * KINDS).reshape(-1, KINDS).max(1)
        grades = np.where(self.toxic == 0, 0, 1 + sum((uses >= s).astype(int) for s in GRADE_STEPS))
        return np.abs(np.log(share / (1 - share)) - np.log(base / (1 - base))), grades

    def fitted(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each column and thresholds, from the kept rows, which hold both labels."""
        strength, grades = self.strength(keep)
        w, thresholds = fit_ordinal(self, keep, grades, strength)
        return w * strength, thresholds


def fit_ordinal(sample: Sample, keep: np.ndarray, grades: np.ndarray, scale: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by maximum likelihood with a ridge; a feature's value is taken times ``scale``.

    The thresholds are a first one and positive gaps, kept as logarithms. Rows
    that aren't kept weigh nothing.
    """
    k, m = GRADES, len(scale)
    positive = (grades[keep] > 0).mean()
    share = keep * np.where(grades > 0, 0.5 / max(positive, 1e-9), 0.5 / max(1 - positive, 1e-9)) / keep.sum()
    above_ = np.clip([(share * (grades > j)).sum() / share.sum() for j in range(k)], 1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(-np.log(above_ / (1 - above_)) + 0.01 * np.arange(k))

    def loss(p):
        w, t = p[:m], p[m] + np.r_[0, np.cumsum(_gaps(p[m + 1:]))]
        scaled, total, gw, gt = w * scale, 0.0, np.zeros(m), np.zeros(k)
        for rows, own, col, value in sample.blocks():
            n, grade, part = rows.stop - rows.start, grades[rows], share[rows]
            z = np.bincount(own, value * scaled[col], n)
            above = np.c_[np.ones(n), _sigmoid(z[:, None] - t), np.zeros(n)]  # P(grade > -1), ..., P(grade > k)
            row = np.arange(n)
            chance = np.maximum(above[row, grade] - above[row, grade + 1], 1e-12)
            slope = above * (1 - above)
            up, down = part * slope[row, grade] / chance, part * slope[row, grade + 1] / chance
            gt += [np.where(grade == j + 1, up, 0).sum() - np.where(grade == j, down, 0).sum() for j in range(k)]
            gw += np.bincount(col, value * (down - up)[own], m)
            total -= (part * np.log(chance)).sum()
        gaps = [gt[j + 1:].sum() * _gaps(p[m + 1 + j]) for j in range(k - 1)]
        return total + RIDGE / 2 * _dot(w, w), np.r_[gw * scale + RIDGE * w, gt.sum(), gaps]

    p = _lowest(loss, np.r_[np.zeros(m), start[0], np.log(np.maximum(np.diff(start), 0.05))], steps)
    return p[:m], p[m] + np.r_[0, np.cumsum(_gaps(p[m + 1:]))]


def fit(sample: Sample) -> OrdinalModel:
    """The model of all rows, with its first threshold at the best cut of held-out scores.

    A fold's rows have held-out scores where the other folds hold both labels.
    """
    toxic = sample.toxic == 1
    if not toxic.any() or toxic.all():
        return OrdinalModel()
    fold = np.zeros(len(toxic), np.int64)
    for kind in (toxic, ~toxic):
        fold[kind] = np.arange(kind.sum()) % FOLDS
    z = np.full(len(toxic), np.nan)
    for f in range(FOLDS):
        keep = fold != f
        if toxic[keep].any() and not toxic[keep].all():
            w, t = sample.fitted(keep)
            z[~keep] = sample.scores(w)[~keep] - t[0]
    w, thresholds = sample.fitted(np.ones(len(toxic), bool))
    weights = np.zeros(PLACES, np.float32)
    weights[sample.used] = w
    scored = ~np.isnan(z)
    return OrdinalModel(weights, thresholds + best_cut(z[scored], toxic[scored]))


def best_cut(z: np.ndarray, toxic: np.ndarray) -> float:
    """The cut of highest F1, midway between two scores; 0 where no row to be found has a score."""
    if not toxic.any():
        return 0.0
    order = np.argsort(-z, kind="stable")
    z, found = z[order], np.cumsum(toxic[order])
    ends = np.flatnonzero(np.r_[z[1:] < z[:-1], True])
    best = ends[np.argmax(found[ends] / (ends + 1 + toxic.sum()))]
    return float(z[best] + z[min(best + 1, len(z) - 1)]) / 2


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> OrdinalModel:
    """The model from a bounded sample of labelled rows."""
    ship(docs.sparkSession)
    cut_batches(docs.sparkSession)
    sample = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training)
    texts = one_text_each(documents(docs, "doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id"), "toxic")

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: pack(*features(t)))

    # the order of the rows decides their folds, so it is fixed; an id is there once
    rows = texts.select("doc_id", "toxic", packed("text").alias("x")).toArrow().sort_by("doc_id")
    sample = unpacked([memoryview(x.as_buffer()) for x in rows.column("x")], rows.column("toxic").to_numpy().astype(np.int64))
    del rows
    return fit(sample)


def pack(at: np.ndarray, count: np.ndarray) -> bytes:
    """Feature numbers in four bytes, counts in one; a count of 255 and more follows at the end."""
    many = count[count >= 255].astype(np.uint32)
    return b"".join((np.array([len(at)], np.uint32).tobytes(), at.astype(np.uint32).tobytes(),
                     np.minimum(count, 255).astype(np.uint8).tobytes(), many.tobytes()))


def unpacked(rows: list[bytes | memoryview], toxic: np.ndarray) -> Sample:
    """The sample of packed rows: columns are the places of the features that occur, in their order."""
    lens = np.array([int.from_bytes(x[:4], "little") for x in rows], np.int64)
    ends = np.cumsum(lens)
    col = np.empty(int(lens.sum()), np.int32)
    count = np.empty(len(col), np.uint8)
    many = []
    for x, n, end in zip(rows, lens.tolist(), ends.tolist(), strict=True):
        col[end - n:end] = np.frombuffer(x, np.uint32, n, 4)
        count[end - n:end] = np.frombuffer(x, np.uint8, n, 4 + 4 * n)
        many.append(np.frombuffer(x, np.uint32, offset=4 + 5 * n))
    large = np.concatenate(many) if many else np.empty(0, np.uint32)
    if len(large):
        at = np.flatnonzero(count == 255)
        count = count.astype(np.uint32)
        count[at] = large
    place = np.zeros(PLACES, np.int32)
    place[col] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used))
    for k in range(0, len(col), BLOCK):
        col[k:k + BLOCK] = place[col[k:k + BLOCK]]
    return Sample(lens, col, count, toxic, used)


def with_severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The documents with expected_severity (0 to 3), severity (likeliest grade) and toxic (P(grade > 0) >= 0.5)."""
    ship(docs.sparkSession)

    @F.pandas_udf("expected double, grade int, toxic boolean")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            above = model.chances(texts)
            edges = np.c_[np.ones(len(texts)), above, np.zeros(len(texts))]
            yield pd.DataFrame({"expected": above.sum(1), "grade": (edges[:, :-1] - edges[:, 1:]).argmax(1).astype(np.int32),
                                "toxic": above[:, 0] >= 0.5})

    scored = docs.withColumn("_severity", score(F.col("text").cast("string")))
    return scored.withColumns({"expected_severity": F.col("_severity.expected"), "severity": F.col("_severity.grade"),
                               "toxic": F.col("_severity.toxic")}).drop("_severity")
