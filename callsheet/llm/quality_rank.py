"""Quality classifier: Bradley-Terry scores from preference pairs.

A labelled good text is preferred to a labelled bad one. The chance of the
preference is sigmoid(s(a) - s(b)), and the linear score s is learned by
logistic loss on the pairs' feature differences. Features are shares and
shapes of the whole text (never its id, language, source or label), each
split into quantile steps so that the score can bend.

The cut between good and bad is a quantile of the training scores; the quantile
is the one with the best balanced accuracy on the training rows. Scores are
moved by a logistic curve so that the cut lies at ``CUT``.

The model is fitted on at most ``MAX_TRAINING`` labelled rows, those with the
lowest hash of their id; of rows that repeat an id the text of lowest hash trains.
Every text is scored whole.

Defined results: null and empty texts have the features of an empty text;
labels that are null or have no document train nothing; with labels of one kind
only every score is 0.5; repeated rows are scored one by one; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, one_text_each, ship

MAX_TRAINING = 8000
PAIRS_PER_ROW = 20
STEPS = 10  # quantile steps of a feature
CUT = 0.3
RIDGE = 1e-4

_UPPER = bytes(range(65, 91))
_LETTERS = bytes((*range(65, 91), *range(97, 123), *range(128, 256)))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>@^~_={}[]\\"
_STOPS = b".,;:!?"
FEATURES = ("chars", "words", "mean_word", "upper", "digits", "symbols", "stops", "exclaimed", "bars", "distinct",
            "top_word", "repeat_pairs", "repeat_lines", "mean_line", "ends_in_symbol", "bare_word", "sentence", "short_words")


def features(text: str | None) -> list[float]:
    """The numbers that describe one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), max(len(raw), 1)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    per_word = 1 / max(n, 1)
    letters = sum(c for w, c in counts.items() if w.isalpha() or w.translate(None, _LETTERS) == b"")
    symbol_ends = sum(c for w, c in counts.items() if w[-1:] in (b"#", b"*", b"$", b"%", b"&", b"|", b">", b"!"))
    return [
        np.log1p(len(raw)), np.log1p(n), len(raw) * per_word, share(_UPPER), share(_DIGITS), share(_SYMBOLS), share(_STOPS),
        share(b"!"), share(b"|"), np.log1p(len(counts)) / max(np.log1p(n), 1e-9) if n else 0.0,
        max(counts.values(), default=0) * per_word,
        sum(c for c in pairs.values() if c > 1) / max(n - 1, 1), 1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(raw) / max(len(lines), 1)), symbol_ends * per_word, letters * per_word, raw.count(b".") * per_word,
        sum(c for w, c in counts.items() if len(w) <= 2) * per_word]


@dataclass
class RankModel:
    edges: list[np.ndarray]  # of each feature's steps
    weights: np.ndarray
    cut: float

    def steps(self, x: np.ndarray) -> np.ndarray:
        """Indicator of each feature's step."""
        out = np.zeros((len(x), sum(len(e) + 1 for e in self.edges)), np.float32)
        at = 0
        for j, e in enumerate(self.edges):
            out[np.arange(len(x)), at + np.searchsorted(e, x[:, j], "right")] = 1
            at += len(e) + 1
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.steps(x) @ self.weights - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, rounds: int = 300) -> RankModel:
    """Weights from preference pairs; each good row is paired with random bad ones and each bad row with good ones."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, STEPS + 1)[1:-1])) for j in range(x.shape[1])]
    model = RankModel(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0)
    s = model.steps(x)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(0)
    a = np.r_[np.repeat(up, pairs_per_row // 4 or 1), rng.choice(up, pairs_per_row * len(down))]
    b = np.r_[rng.choice(down, len(up) * (pairs_per_row // 4 or 1)), np.repeat(down, pairs_per_row)]
    m, v = np.zeros_like(model.weights), np.zeros_like(model.weights)
    w = model.weights
    for step in range(1, rounds + 1):
        z = s @ w
        loss = -1 / (1 + np.exp(np.clip(z[a] - z[b], -30, 30)))  # slope of the logistic loss on the difference
        row = np.bincount(a, loss, len(x)) - np.bincount(b, loss, len(x))
        g = row @ s / len(a) + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    model.weights = w
    z = s @ w
    levels = np.unique(np.quantile(z, np.linspace(0.002, 0.998, 499)))
    balanced = [((z[good] >= t).mean() + (z[~good] < t).mean()) for t in levels]
    best = np.flatnonzero(np.array(balanced) >= max(balanced) - 1e-12)
    low, high = levels[best[0]], levels[best[-1]]
    below = z[z < low]
    # midway between the scores beside the best quantile
    model.cut = float((low + (below.max() if len(below) else low)) / 2 if low == high else (low + high) / 2)
    return model


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> RankModel | None:
    """The model from a bounded sample of the labelled rows that are not held out."""
    ship(docs.sparkSession)
    sample = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training)
    rows = one_text_each(documents(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id"), "quality").select("doc_id", "quality", "text")

    def run(batches):
        for b in batches:
            x = _matrix(b.column("text").to_pylist())
            columns = [b.column("doc_id"), b.column("quality"), pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "x"])

    # pairs are drawn by the rows' places, so their order is fixed; ids are there once
    got = sorted(rows.mapInArrow(run, "doc_id bigint, quality int, x array<double>").collect(), key=lambda r: r["doc_id"])
    good = np.array([r["quality"] == 1 for r in got], dtype=bool)
    if not good.any() or good.all():
        return None
    return fit_ranking(np.array([r["x"] for r in got]), good)


def scored(docs: DataFrame, model: RankModel | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(_matrix(texts)) if model else np.full(len(texts), 0.5))

    return documents(docs, "doc_id", "text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")) \
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def is_held_out(doc_id: int) -> bool:
    """The same rule for one id, as tests use it."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
