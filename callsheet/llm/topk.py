"""Exact top-k inner products by a bit-sliced index.

Vectors become integers, floor(scale * x). A block of candidates is indexed by
bit slices: attribute j, less its minimum and shifted to SLICES bits, gives one
bitmap over the block's rows for each bit. A query's coarse score is a sum of
slices with small integer weights, added as bitmaps with full adders (a
negative weight adds the complement). The k-th highest coarse score is found
from the most significant slice downward. What quantising may change in a
score is bounded exactly, so every row whose coarse score lies within that
bound of the k-th is resolved by its exact integer product; ties go to the
smaller id. The result is exact for any data; only the number of rows resolved
depends on it.

Queries are a stated set. Blocks of candidates meet blocks of queries, each
meeting in one task that builds its index once and answers all its queries. So
a row is shuffled once per BLOCK_QUERIES queries and a query once per
BLOCK_ROWS rows. Each meeting keeps k rows and a ranked window keeps k of all.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows without an id, take no part; a row with the query's id
is its own; of queries with the same id the smallest vector asks; vectors of
other lengths than the query's score over the components both have; integer
components and scores beyond the range of a long count as its nearest end; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship

SCALE = 256
SLICES = 6  # bits of an attribute
WEIGHT_BITS = 5  # bits of a query weight
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 16_384
MOST_PARTS = 20_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1

U = np.uint64


class BitSlices:
    """The index of one block of integer vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.n, self.d = vectors.shape
        self.low = vectors.min(0)
        span = vectors.max(0) - self.low
        self.shift = np.array([max(0, int(s).bit_length() - SLICES) for s in span])
        units = (vectors - self.low) >> self.shift
        self.words = -(-self.n // 64)
        self.valid = self._bits(np.ones(self.n, bool))
        self.slices = [[self._bits((units[:, j] >> b) & 1) for b in range(int(units[:, j].max()).bit_length())]
                       for j in range(self.d)]

    def _bits(self, column: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 64, np.uint8)
        out[:self.n] = column
        return np.packbits(out, bitorder="little").view(U)

    def coarse(self, query: np.ndarray) -> tuple[list[np.ndarray], int, int]:
        """Slices of the coarse score, its unit, and by how much rows of equal coarse score can differ."""
        weight = [abs(int(q)) << int(s) for q, s in zip(query, self.shift, strict=True)]
        unit = max(1, -(-max(weight, default=0) // ((1 << WEIGHT_BITS) - 1)))
        columns: list[list[np.ndarray]] = []
        slack = 0
        for j, w in enumerate(weight):
            bits = self.slices[j]
            small = (w + unit // 2) // unit
            top = (1 << len(bits)) - 1
            # what the weight's rounding and the bits below the shift may add, between least and most
            slack += abs(w - small * unit) * top + abs(int(query[j])) * ((1 << int(self.shift[j])) - 1)
            for b, bitmap in enumerate(bits):
                if query[j] < 0 and small:
                    bitmap = bitmap ^ self.valid
                for k in range(small.bit_length()):
                    if small >> k & 1:
                        while len(columns) <= b + k:
                            columns.append([])
                        columns[b + k].append(bitmap)
        return _added(columns, self.words), unit, slack

    def top(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that can be among the k highest: a superset, usually little larger."""
        if self.n <= k:
            return np.arange(self.n)
        slices, unit, slack = self.coarse(query)
        sure, open_, value = np.zeros(self.words, U), self.valid.copy(), 0
        for i in range(len(slices) - 1, -1, -1):  # the k-th highest coarse score, bit by bit
            higher = open_ & slices[i]
            if int(np.bitwise_count(sure).sum() + np.bitwise_count(higher).sum()) >= k:
                open_, value = higher, value | 1 << i
            else:
                sure, open_ = sure | higher, open_ & ~slices[i]
        least = max(0, value - -(-slack // unit) - 1)
        above, equal = np.zeros(self.words, U), self.valid.copy()
        for i in range(max(len(slices), least.bit_length()) - 1, -1, -1):
            s = slices[i] if i < len(slices) else np.zeros(self.words, U)
            if least >> i & 1:
                equal = equal & s
            else:
                above, equal = above | (equal & s), equal & ~s
        return np.flatnonzero(np.unpackbits((above | equal).view(np.uint8), bitorder="little")[:self.n])


def _added(columns: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """One slice per place: full adders take three bitmaps of a place to a sum and a carry."""
    out, place = [], 0
    columns = [list(c) for c in columns]
    while place < len(columns):
        c = columns[place]
        carries: list[np.ndarray] = []
        while len(c) > 2:
            x, y, z = c.pop(), c.pop(), c.pop()
            half = x ^ y
            c.insert(0, half ^ z)
            carries.append((x & y) | (half & z))
        if len(c) == 2:
            x, y = c
            c = [x ^ y]
            carries.append(x & y)
        out.append(c[0] if c else np.zeros(words, U))
        if carries:
            if place + 1 == len(columns):
                columns.append([])
            columns[place + 1].extend(carries)
        place += 1
    return out


def _beyond(x: np.ndarray, limit: int) -> np.ndarray:
    return (x > limit) | (x < -limit)


def block_top(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query_id, vec_id, score) of each query's k best in the block.

    Products of components up to ``limit`` fit a long. Rows with larger ones stay out of the index and are resolved
    for every query, in unbounded integers; a query with larger ones resolves all rows so.
    """
    limit = math.isqrt((1 << 62) // max(1, vectors.shape[1]))
    large = _beyond(vectors, limit).any(1)
    indexed, others = np.flatnonzero(~large), np.flatnonzero(large)
    index = BitSlices(vectors[indexed]) if len(indexed) else None
    for qid, q in zip(query_ids, queries, strict=True):
        if _beyond(q, limit).any():
            rows, fits = np.arange(len(ids)), False
        else:
            found = indexed[index.top(q, k + int((ids[indexed] == qid).sum()))] if index else indexed
            rows, fits = np.concatenate([found, others]), not len(others)
        rows = rows[ids[rows] != qid]
        if fits:
            scores = vectors[rows] @ q
        else:
            exact = (sum(int(x) * int(y) for x, y in zip(vectors[i], q, strict=True)) for i in rows)
            scores = np.array([min(max(s, LEAST), MOST) for s in exact], np.int64)
        best = sorted(range(len(rows)), key=lambda i: (-int(scores[i]), ids[rows[i]]))[:k] if not fits \
            else np.lexsort((ids[rows], -scores))[:k]
        yield from ((int(qid), int(ids[rows[i]]), int(scores[i])) for i in best)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the floored integer components of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & good) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("v"))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a group's rows, short vectors filled with zeros."""
    v = table.column("v").combine_chunks()
    lengths = v.value_lengths().to_numpy(zero_copy_only=False)
    wide = int(lengths.max(initial=0))
    full = np.zeros((len(lengths), wide), np.int64)
    full[np.arange(wide)[None, :] < lengths[:, None]] = v.flatten().to_numpy()
    return table.column("vec_id").to_numpy(), full


def _dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """The rows with the number of their block; rows that repeat an id and a vector are spread like any others."""
    return rows.withColumn("c", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))


def nearest(vectors: DataFrame, is_query, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of every query row."""
    ship(vectors.sparkSession)
    whole = integers(vectors, scale)
    asked = whole.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows, asks = whole.count(), asked.count()
    blocks, sets = max(1, -(-rows // BLOCK_ROWS)), max(1, -(-asks // BLOCK_QUERIES))
    parts = min(4 * blocks * sets, MOST_PARTS)

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    def side(dealt: DataFrame):
        met = dealt.select((F.col("c") * sets + F.col("q")).alias("meeting"), "vec_id", "v")
        return met.repartition(parts, "meeting").groupBy("meeting")

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list = []
        if rows.num_rows and queries.num_rows:
            (ids, v), (q_ids, q) = _matrix(rows), _matrix(queries)
            d = min(v.shape[1], q.shape[1])
            found = list(block_top(ids, np.ascontiguousarray(v[:, :d]), q_ids, q[:, :d], k))
        return pa.table({n: pa.array([x[i] for x in found], pa.int64()) for i, n in enumerate(("query_id", "vec_id", "score"))})

    candidates = side(_dealt(whole, blocks).withColumn("q", each(sets)))
    queries = side(asked.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(sets))).withColumn("c", each(blocks)))
    found = candidates.cogroup(queries).applyInArrow(meet, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
