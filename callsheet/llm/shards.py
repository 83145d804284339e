"""Sharding: k-d tree partitioning of documents into shards of near equal bytes.

A node of the tree holds a number of shards. It is cut along its widest
metadata dimension, at the weighted median (or at the share of bytes that its
left shards take, when their number is odd), until a leaf holds one shard. All
nodes of a level are cut at once: sums of bytes over equal key ranges narrow
each cut down in a few aggregations, whose results hold at most
shards x BINS rows. DataFrame functions only.

A dimension's value is scaled to 20 bits; 40 bits that break ties follow,
first from the text's checksum, then from the row, so that any two rows can
be parted (a hot source or a large group of copies does not unbalance the
shards). Equal texts of equal metadata are neighbours in that order; a cut may
still part them, and equal texts of other metadata lie anywhere.

Defined results: null text has size OVERHEAD and checksum 0; null metadata
counts as the lowest value; repeated rows are rows of their own; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, documents

SHARDS = 40
OVERHEAD = 16
BINS = 1024
TOLERANCE = 0.0005  # of a shard's bytes: how near to its target a cut must come
SLOT_ROWS = 512  # rows numbered together
CELLS = 1 << 20
TIES = 1 << 40

DIMENSIONS = ("size", "source", "lang", "doc_id")


@dataclass
class Node:
    """An open node of one level: its shards and, once found, where it is cut."""

    first: int
    count: int
    dim: int = 0
    lo: int = 0
    hi: int = 0
    below: int = 0
    target: float = 0.0
    near: float = 0.0
    cut: int | None = None


def metadata(docs: DataFrame) -> DataFrame:
    """Row number, size, checksum and the raw value of each dimension."""
    base = documents(docs, "doc_id", "text", "source", "lang")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + OVERHEAD
    return base.select(
        "doc_id", size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        F.log2(size.cast("double")).alias("d_size"),
        F.coalesce(F.crc32(F.col("source").cast("binary")), F.lit(0)).cast("double").alias("d_source"),
        F.coalesce(F.crc32(F.col("lang").cast("binary")), F.lit(0)).cast("double").alias("d_lang"),
        F.coalesce(F.col("doc_id"), F.lit(0)).cast("double").alias("d_doc_id"),
        F.monotonically_increasing_id().alias("row"))


def keyed(rows: DataFrame) -> DataFrame:
    """A long key for each dimension: the scaled value, then the tie bits."""
    span = rows.agg(*(f(f"d_{d}").alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    tie = F.shiftright(F.col("text_crc32"), 8) * (1 << 16) + F.pmod(F.xxhash64("row"), F.lit(1 << 16))
    keys = []
    for d in DIMENSIONS:
        lo, hi = span[f"lo_{d}"] or 0.0, span[f"hi_{d}"] or 0.0
        cell = F.floor((F.col(f"d_{d}") - lo) / (hi - lo) * (CELLS - 1)) if hi > lo else F.lit(0)
        keys.append(cell.cast("bigint") * TIES + tie)
    return rows.select("doc_id", "size", "text_crc32", "row", F.array(*keys).alias("keys"), F.lit(0).alias("node"))


def _state(rows: DataFrame, nodes: list[Node], *columns: str) -> DataFrame:
    """The nodes' state as a table; there are fewer nodes than shards, so it can be broadcast.

    From Arrow it is a local relation; from a list of rows, executors would run Python to read it.
    """
    state = pa.Table.from_pylist([
        {"node": n.first, "dim": n.dim, "lo": n.lo, "hi": n.hi, "width": -(-(n.hi - n.lo + 1) // BINS), "cut": n.cut,
         "half": n.count // 2} for n in nodes])
    table = rows.sparkSession.createDataFrame(state, "node int, dim int, lo bigint, hi bigint, width bigint, cut bigint, half int")
    return F.broadcast(table.select("node", "dim", *columns))


def _found(rows: DataFrame, nodes: list[Node]) -> None:
    """Sets the cuts of one level; the driver sees sums by node and key range only."""
    spans = {r["node"]: r for r in rows.groupBy("node").agg(
        F.sum("size").alias("total"),
        *(f(F.col("keys")[j]).alias(f"{n}{j}") for j in range(len(DIMENSIONS)) for n, f in (("lo", F.min), ("hi", F.max)))).collect()}
    todo = []
    for n in nodes:
        if r := spans.get(n.first):
            n.dim = max(range(len(DIMENSIONS)), key=lambda j: r[f"hi{j}"] - r[f"lo{j}"])
            n.lo, n.hi = r[f"lo{n.dim}"], r[f"hi{n.dim}"]
            n.target, n.near = r["total"] * (n.count // 2) / n.count, TOLERANCE * r["total"] / n.count
            todo.append(n)
        else:
            n.cut = 0
    while todo:
        sums = rows.join(_state(rows, todo, "lo", "hi", "width"), "node").withColumn("key", F.expr("keys[dim]")) \
            .where("key between lo and hi").groupBy("node", F.expr("(key - lo) div width").alias("bin")) \
            .agg(F.sum("size").alias("bytes")).collect()
        rest = []
        for n in todo:
            width = -(-(n.hi - n.lo + 1) // BINS)
            below, size, b = n.below, 0, 0
            for b, size in sorted((r["bin"], r["bytes"]) for r in sums if r["node"] == n.first):  # noqa: B007
                if below + size > n.target:
                    break
                below += size
                size = 0
            edge = n.lo + b * width
            if size == 0:
                n.cut = edge + width
            elif width == 1 or size <= n.near or n.target - below <= n.near:
                n.cut = edge + width if below + size - n.target < n.target - below else edge
            else:
                n.lo, n.hi, n.below = edge, min(n.hi, edge + width - 1), below
                rest.append(n)
        todo = rest


def grown(scratch: Scratch, rows: DataFrame, shards: int) -> DataFrame:
    """The rows with ``node``, the number of the leaf that they fall into: one written table a level."""
    nodes = [Node(0, shards)]
    rows = scratch.keep(rows)
    while open_ := [n for n in nodes if n.count > 1]:
        _found(rows.where(F.col("node").isin([n.first for n in open_])), open_)
        split = rows.join(_state(rows, open_, "cut", "half"), "node", "left").withColumn(
            "node", F.when(F.expr("keys[dim] >= cut"), F.col("node") + F.col("half")).otherwise(F.col("node")))
        after = scratch.keep(split.drop("dim", "cut", "half"))
        scratch.free(rows)
        rows = after
        nodes = [Node(first, count) for n in nodes for first, count in (
            ((n.first, n.count // 2), (n.first + n.count // 2, n.count - n.count // 2)) if n.count > 1 else ((n.first, 1),))]
    return rows


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row."""
    scratch = Scratch(docs.sparkSession, "shards")
    rows = grown(scratch, keyed(scratch.keep(metadata(docs))), shards)
    groups = max(1, -(-rows.count() // (shards * SLOT_ROWS)))
    placed = rows.select("doc_id", "size", "text_crc32", "row", F.col("node").cast("int").alias("shard"),
                         F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("shard", "part").orderBy("row")
    numbered = placed.withColumn("at", F.row_number().over(order) - 1)
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("bigint").alias("slot"))
