"""N-gram Jaccard join: universe-partition pigeonhole over hashed shingle sets.

Two sets of sizes l <= s link when 100 * |intersection| >= 75 * |union|, so
their symmetric difference is at most (s + l) // 7. Sizes are cut into bands;
in a band whose largest size is ``hi`` every shingle hash falls into one of M
segments, and a pair with at most H differences agrees on at least one of any
H + 1 segments that one of the two sets fills.

* Index: a set writes the signature of each filled segment of its own band.
* Probe: a set of the next sizes up does so with the segments of the band below.
* Signatures meet in buckets, packed as numbers. A signature that up to
  ``PAIR_LIMIT`` sets share gives their pairs. One that more sets share is hot:
  its sets are compared with its smallest member only (a star).
* Cost-based allocation: after the first components are known, a hot
  signature whose sets are all in one component needs nothing more. The other
  hot ones are skipped. A set with at least H + 1 segments left is complete:
  each of its links has been compared or lies within a component. Only sets
  that are short of segments, because they are hot or empty, go on: among
  these alone every filled segment is indexed with its one-deletion
  neighbourhood, where a segment of two or more shingles counts twice.
* What is short even then (sets made of hot segments) is compared by rarest
  shingles: ordered by how many of these sets hold them, the first quarter of
  each set's shingles must meet a partner's. So no link is lost, whatever the
  frequencies are.

A set also has a sketch: how many of its shingles hash to each of about n / 4
places. The sketches' distance is at most the sets' symmetric difference, so
a pair whose sketches lie too far apart can't link and its sets are not
fetched. Every other candidate pair is verified exactly on the whole sets. Copies (equal
sets) are one node throughout, so a group of copies costs one row each.

What is found so far gives the components. ``n_links`` is counted after that:
all sets of a component are compared with each other, block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, documents, few
from .shingles import U, identity, mix, shingle_sets

SHARE, WHOLE = 75, 100  # SHARE / WHOLE is the similarity from which two sets link
PAIR_LIMIT = 8  # a signature of more sets is compared by a star, the rest by the rules above
BUCKET_ENTRIES = 250_000  # signatures that one bucket is planned to hold
LOCAL_RUN = 64  # copies of a signature that one task sends as such; more go out salted
BLOCK_SETS = 512  # sets and shingles that a block of a component is planned to hold, where links are counted
BLOCK_GRAMS = 500_000
TILE, COLUMNS = 128, 16_384  # sets and shingles of the matrices in which links are counted
TASK_ENTRIES = 600_000  # signatures gathered before a task writes them

META = "doc_id bigint, n int, node bigint, short boolean, sketch binary"
FOUND = "kind int, sig bigint, a bigint, na int, b bigint, nb int, band int, margin int"


def _bands(largest: int = 1 << 40) -> list[tuple[int, int]]:
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, lo * 3 // 2)
        out.append((lo, hi))
        lo = hi + 1
    return out


BANDS = _bands()
_TOPS = np.array([hi for _, hi in BANDS])


def band_of(n: int) -> int:
    return int(np.searchsorted(_TOPS, n))


def segments_of(band: int) -> int:
    """M: more than the H + 1 that any pair of the band needs, as some segments stay empty or are hot."""
    return (5 * (int(_TOPS[band]) // 3 + 1) + 3) // 4


def needed(n: int, band: int, probe: bool) -> int:
    """H + 1 for a set of n shingles: against larger sets (its own band), or against the band below."""
    other = int(_TOPS[band]) if probe else n * WHOLE // SHARE
    return (n + other) * (WHOLE - SHARE) // (WHOLE + SHARE) + 1


def roles(n: int) -> list[tuple[int, bool]]:
    """(band, whether it only probes) for a set of n shingles."""
    own = band_of(n)
    below = own > 0 and SHARE * n <= WHOLE * int(_TOPS[own - 1])
    return [(own, False), (own - 1, True)] if below else [(own, False)]


def _segment(grams: np.ndarray, band: int) -> np.ndarray:
    return ((mix(grams + U(band)) >> U(32)) % U(segments_of(band))).astype(np.int64)


def is_short(grams: np.ndarray) -> bool:
    """Whether in one of its roles the set fills fewer segments than it needs."""
    return any(np.count_nonzero(np.bincount(_segment(grams, band))) < needed(len(grams), band, probe)
               for band, probe in roles(len(grams)))


def _segmented(grams: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shingles' element hashes by segment, the filled segments, their sizes and their sums."""
    seg = _segment(grams, band)
    order = np.argsort(seg, kind="stable")
    seg = seg[order]
    at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    element = mix(grams[order] ^ U(0xC2B2AE3D27D4EB4F))
    return element, seg[at], np.diff(np.r_[at, len(seg)]), np.add.reduceat(element, at)


def _signed(total: np.ndarray, ids: np.ndarray, band: int, space: int) -> np.ndarray:
    return mix(mix(total + U(space)) + ids.astype(U) * U(0x9FB21C651E98DF25) + U(band * 2 + 1))


def exact_signatures(grams: np.ndarray, band: int, probe: bool) -> tuple[np.ndarray, int]:
    """Signatures of the filled segments, and how many there are beyond the need."""
    _, ids, _, total = _segmented(grams, band)
    return _signed(total, ids, band, 0), len(ids) - needed(len(grams), band, probe)


def neighbour_signatures(grams: np.ndarray, band: int, probe: bool) -> tuple[np.ndarray, int]:
    """Signatures of every filled segment and of each with one shingle left out; units beyond the need."""
    element, ids, sizes, total = _segmented(grams, band)
    wide = np.repeat(sizes >= 2, sizes)
    less = (np.repeat(total, sizes) - element)[wide]
    sigs = np.r_[_signed(total, ids, band, 1), _signed(less, np.repeat(ids, sizes)[wide], band, 1)]
    return np.unique(sigs), len(ids) + int((sizes >= 2).sum()) - needed(len(grams), band, probe)


def sketch(grams: np.ndarray) -> bytes:
    """Shingles by place, one byte each (255 and more count as 255); the places are a power of two."""
    places = 1 << max(2, (len(grams) // 4).bit_length() - 1)
    return np.minimum(np.bincount((grams >> U(40)).astype(np.int64) % places, minlength=places), 255).astype(np.uint8).tobytes()


def may_link(x: bytes, y: bytes, na: int, nb: int) -> bool:
    """Whether the sketches leave room for a link: their distance bounds the symmetric difference from below."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        if b.max() == 255:
            return True  # a full place can't be added to others
        b = b.reshape(-1, len(a)).sum(0)
        if a.max() == 255:
            b = np.minimum(b, 255)
    common = (na + nb - int(np.abs(a - b).sum())) // 2
    return WHOLE * common >= SHARE * (na + nb - common)


HEAD = np.dtype([("node", "<i8"), ("n", "<i4"), ("band", "<i2"), ("margin", "<i2")])


class _Packer:
    """Gathers (signature, node) entries of a task and writes them bucket by bucket.

    ``first`` and ``count`` give each band its own buckets, so a set's entries
    go to few of them. The last bit of a node marks a probe.
    """

    def __init__(self, first: np.ndarray, count: np.ndarray, salt: int):
        self.first, self.buckets, self.salt = first, count, salt
        self.clear()

    def clear(self):
        self.sigs, self.heads, self.count = [], [], 0

    def add(self, sigs: np.ndarray, node: int, n: int, band: int, probe: bool, margin: int):
        self.sigs.append(sigs)
        self.heads.append((node | probe, n, band, max(-30_000, min(30_000, margin))))
        self.count += len(sigs)

    def full(self) -> bool:
        return self.count >= TASK_ENTRIES or len(self.heads) >= 65_000

    def batch(self) -> pa.RecordBatch | None:
        if not self.count:
            return None
        sigs = np.concatenate(self.sigs)
        owner = np.repeat(np.arange(len(self.heads), dtype=np.uint16), [len(x) for x in self.sigs])
        heads = np.array(self.heads, dtype=HEAD)
        self.clear()
        order = np.argsort(sigs)
        sigs, owner = sigs[order], owner[order]
        start = np.flatnonzero(np.r_[True, sigs[1:] != sigs[:-1]])
        runs = np.diff(np.r_[start, len(sigs)])
        band = heads["band"][owner]
        home = self.first[band] + (sigs % self.buckets[band].astype(U)).astype(np.int64)
        bucket = home.copy()
        # a signature that is hot in this task alone: its first members are enough to be seen as hot in its
        # bucket, the others go to salted buckets
        hot = np.repeat(runs > LOCAL_RUN, runs)
        if hot.any():
            rank = np.arange(len(sigs)) - np.repeat(start, runs)
            away = hot & (rank > LOCAL_RUN)
            salted = sigs[away] + U(self.salt) + (rank[away] // LOCAL_RUN).astype(U)
            bucket[away] = -1 - (salted % U(int(self.buckets.sum()))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sigs, owner, bucket = sigs[order], owner[order], bucket[order]
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        out = [], []
        for a, b in zip(cut, np.r_[cut[1:], len(sigs)], strict=True):
            used, local = np.unique(owner[a:b], return_inverse=True)
            out[0].append(int(bucket[a]))
            out[1].append(b"".join((np.array([len(used), b - a], np.int64).tobytes(), heads[used].tobytes(),
                                    sigs[a:b].tobytes(), local.astype(np.uint16).tobytes())))
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary())], ["bucket", "entries"])


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All signatures and the head of each one's node beside it."""
    sigs, heads = [], []
    for x in blobs:
        k, n = np.frombuffer(x, np.int64, 2)
        at = 16 + HEAD.itemsize * k
        sigs.append(np.frombuffer(x, U, n, at))
        heads.append(np.frombuffer(x, HEAD, k, 16)[np.frombuffer(x, np.uint16, n, at + 8 * n)])
    return np.concatenate(sigs), np.concatenate(heads)


def _fits(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return WHOLE * np.minimum(na, nb) >= SHARE * np.maximum(na, nb)


def _matched(table: pa.Table) -> pa.Table:
    """Of one bucket: pairs (kind 0) of rare signatures, members (kind 1) of hot ones."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    cols: list[list[np.ndarray]] = [[] for _ in names]

    def put(kind, sig, a, na, b, nb, band, margin):
        for c, x in zip(cols, (kind, sig, a, na, b, nb, band, margin), strict=True):
            c.append(np.broadcast_to(x, a.shape))

    sigs, heads = _unpacked([x.as_py() for x in table.column("entries")])
    salted = table.column("bucket")[0].as_py() < 0
    order = np.lexsort((heads["node"], sigs))
    sigs, heads = sigs[order], heads[order]
    new = np.r_[True, (sigs[1:] != sigs[:-1]) | (heads["node"][1:] != heads["node"][:-1])]
    sigs, heads = sigs[new], heads[new]
    probe, node, size = heads["node"] & 1, heads["node"] & ~1, heads["n"]
    start = np.flatnonzero(np.r_[True, sigs[1:] != sigs[:-1]])
    runs = np.diff(np.r_[start, len(sigs)])
    hot = np.repeat(runs > (0 if salted else PAIR_LIMIT), runs)
    if hot.any():
        put(1, sigs[hot].view(np.int64), node[hot], size[hot], -1, -1, heads["band"][hot] * 2 + probe[hot], heads["margin"][hot])
    if not salted:
        pairs = []
        for k in range(2, PAIR_LIMIT + 1):  # all runs of one length at once
            s = start[runs == k]
            for i in range(k if len(s) else 0):
                for j in range(i + 1, k):
                    pairs.append(np.stack([s + i, s + j], 1))
        if pairs:
            x, y = np.concatenate(pairs).T
            ok = (node[x] != node[y]) & _fits(size[x], size[y]) & ((probe[x] & probe[y]) == 0)
            x, y = x[ok], y[ok]
            if len(x):
                x, y = np.where(node[x] < node[y], x, y), np.where(node[x] < node[y], y, x)
                _, once = np.unique(np.stack([node[x], node[y]], 1), axis=0, return_index=True)
                x, y = x[once], y[once]
                put(0, 0, node[x], size[x], node[y], size[y], 0, 0)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    arrays = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)).cast(k) for c, k in zip(cols, kinds, strict=True)]
    return pa.Table.from_arrays(arrays, names)


def _meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, node, short, sketches = [], [], [], []
        for grams in shingle_sets(b.column("text")):
            n.append(len(grams))
            node.append(identity(grams) if len(grams) else None)
            short.append(bool(len(grams)) and is_short(grams))
            sketches.append(sketch(grams) if len(grams) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int32()), pa.array(node, pa.int64()), pa.array(short, pa.bool_()),
             pa.array(sketches, pa.binary())], ["doc_id", "n", "node", "short", "sketch"])


def _exact_index(first: np.ndarray, count: np.ndarray):
    def run(batches):
        from pyspark import TaskContext

        pack, seen = _Packer(first, count, TaskContext.get().partitionId() * 7919), set()
        for b in batches:
            for grams in shingle_sets(b.column("text")):
                if not len(grams) or (node := identity(grams)) in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()  # only saves work: repeats are dropped in the buckets too
                    if pack.count:
                        yield pack.batch()
                seen.add(node)
                for band, probe in roles(len(grams)):
                    sigs, margin = exact_signatures(grams, band, probe)
                    pack.add(sigs, node, len(grams), band, probe, margin)
                if pack.full():
                    yield pack.batch()
        if last := pack.batch():
            yield last
    return run


def _neighbour_index(first: np.ndarray, count: np.ndarray):
    """Packs the sets of ``sets`` rows by one-deletion neighbourhoods."""
    def run(batches):
        from pyspark import TaskContext

        pack = _Packer(first, count, TaskContext.get().partitionId() * 7919)
        for b in batches:
            for node, blob in zip(b.column("node").to_pylist(), b.column("grams").to_pylist(), strict=True):
                grams = np.frombuffer(blob, U)
                for band, probe in roles(len(grams)):
                    sigs, margin = neighbour_signatures(grams, band, probe)
                    pack.add(sigs, node, len(grams), band, probe, margin)
                if pack.full():
                    yield pack.batch()
        if last := pack.batch():
            yield last
    return run


def _sets(batches):
    for b in batches:
        node, blob = [], []
        for grams in shingle_sets(b.column("text")):
            node.append(identity(grams) if len(grams) else None)
            blob.append(grams.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(blob, pa.binary())], ["node", "grams"])


def _sifted(batches):
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("x", "y", "na", "nb")]
        keep = [may_link(*row) for row in zip(*cols, strict=True)]
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(batches):
    """The pairs whose whole sets reach the similarity."""
    for b in batches:
        keep = []
        for x, y in zip(b.column("x"), b.column("y"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            keep.append(WHOLE * common >= SHARE * (len(x) + len(y) - common))
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b; no pair twice): comp is the smallest node reachable.

    Alternates large-star and small-star rounds; each round is grouped minima
    and joins on the node, written out, until the edges are stars: every node
    has one smaller neighbour at most, which has none. No link or component
    passes through the driver.
    """
    def open_(e):
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")) \
            .unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in")))
        return not ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in")) \
            .where(F.col("out") + F.col("in") > 1).where("out > 0").isEmpty()

    edges, made = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), None
    while open_(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # as many rows as edges, repeats included
        stars = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        small = stars.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
        edges = scratch.keep(small.distinct())
        if made is not None:
            scratch.free(made)
        made = edges
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def merged(scratch: Scratch, comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``comp`` after more links: only links between two components are followed."""
    def labels(end):
        return comp.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))

    across = links.join(labels("a"), "a", "left").join(labels("b"), "b", "left") \
        .select(F.coalesce("comp_a", "a").alias("x"), F.coalesce("comp_b", "b").alias("y")).where("x <> y")
    across = scratch.keep(across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if across.isEmpty():
        return comp
    roots = scratch.keep(components(scratch, across))
    renamed = comp.join(roots.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp", "left") \
        .select("node", F.coalesce("root", "comp").alias("comp"))
    return scratch.keep(renamed.unionByName(roots.join(comp, "node", "left_anti")))


def similar_texts(docs: DataFrame, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), n_links (of its set, other sets).

    Defined results: null, empty and wordless texts have no shingles, no link
    and their own doc_id as component; equal sets are linked; rows with a
    repeated or null doc_id keep a row each (a null doc_id never names a
    component unless it is alone); an empty table gives an empty result;
    extra columns are ignored. Without ``count_links`` n_links is null.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    base = documents(docs, "doc_id", "text")
    meta = scratch.keep(base.mapInArrow(_meta, META))
    nodes = scratch.keep(meta.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("short").alias("short")))
    tops = F.array(*(F.lit(int(t)) for t in _TOPS))
    sums = {r[0]: r[1] for r in nodes.groupBy(F.size(F.filter(tops, lambda t: t < F.col("n")))).agg(F.sum("n")).collect()}
    entries = np.array([sums.get(k, 0) / 2 + sums.get(k + 1, 0) / 3 for k in range(len(BANDS))])
    count = 1 + (entries // BUCKET_ENTRIES).astype(np.int64)
    first = np.cumsum(count) - count

    def met(packed: DataFrame) -> DataFrame:
        return scratch.keep(packed.groupBy("bucket").applyInArrow(_matched, FOUND))

    def stars(found: DataFrame) -> DataFrame:
        hot = found.where("kind = 1")
        lead = hot.groupBy("sig").agg(F.min(F.struct(F.col("band") % 2, "a", "na")).alias("lead")) \
            .select("sig", F.col("lead.a").alias("la"), F.col("lead.na").alias("nl"))
        return hot.join(lead, "sig").where("a <> la").select("a", "na", F.col("la").alias("b"), F.col("nl").alias("nb"))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.where(f"{WHOLE} * least(na, nb) >= {SHARE} * greatest(na, nb)") \
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def candidates(found: DataFrame) -> DataFrame:
        return scratch.keep(ordered(found.where("kind = 0").select("a", "na", "b", "nb").unionByName(stars(found))))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()

    def sifted(pairs: DataFrame) -> DataFrame:
        wanted = scratch.keep(nodes.join(ends(pairs), "node", "left_semi").select("node", "doc_id"))
        known = meta.where("node is not null")
        sketches = known.join(few(wanted), ["node", "doc_id"], "left_semi").unionByName(known.where("doc_id is null"))
        side = [sketches.select(F.col("node").alias(i), F.col("n").alias(f"n{i}"), F.col("sketch").alias(k))
                for i, k in (("a", "x"), ("b", "y"))]
        both = pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "x", "y", "na", "nb")
        return scratch.keep(both.mapInArrow(_sifted, "a bigint, b bigint").distinct())

    def whole_sets(wanted: DataFrame) -> DataFrame:
        """node and shingles of the wanted nodes, from one text of each; texts are only shuffled for many nodes."""
        ids = scratch.keep(nodes.join(wanted, "node", "left_semi").where("doc_id is not null").select("doc_id"))
        texts = base.join(few(ids), "doc_id", "left_semi").unionByName(base.where("doc_id is null")).select("text")
        return scratch.keep(texts.mapInArrow(_sets, "node bigint, grams binary")
                            .where("node is not null").dropDuplicates(["node"]))

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
        return scratch.keep(left.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
                            .select("a", "b", "x", "y").mapInArrow(_linked, "a bigint, b bigint"))

    found = met(base.select("text").mapInArrow(_exact_index(first, count), "bucket int, entries binary"))
    pairs = sifted(candidates(found))
    sets = whole_sets(ends(pairs))

    def labelled(members: DataFrame, comp: DataFrame) -> DataFrame:
        return members.join(comp.withColumnRenamed("node", "a"), "a", "left").withColumn("comp", F.coalesce("comp", "a"))

    def still_short(found: DataFrame, comp: DataFrame, units: int) -> DataFrame:
        """Nodes left with less than they need once open hot signatures, worth so many units, are skipped."""
        hot = labelled(found.where("kind = 1"), comp)
        open_ = hot.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("sig")
        return hot.join(open_, "sig", "left_semi").groupBy("a", "band").agg(
            F.countDistinct("sig").alias("skipped"), F.max("margin").alias("margin")) \
            .where(F.col("skipped") * units > F.col("margin")).select(F.col("a").alias("node"))

    links = verified(pairs, sets)
    comp = scratch.keep(components(scratch, links))

    # sets short of exact segments meet again by one-deletion neighbourhoods
    short = nodes.where("short").select("node").unionByName(still_short(found, comp, 1)).distinct()
    short_sets = whole_sets(short)
    again = met(short_sets.mapInArrow(_neighbour_index(first, count), "bucket int, entries binary"))
    pairs2 = scratch.keep(candidates(again).join(pairs, ["a", "b"], "left_anti"))
    links2 = verified(pairs2, short_sets)
    comp = merged(scratch, comp, links2)

    # what is short even then is compared by its rarest shingles, pairs of different components only
    bare = _short_of_units(short_sets).unionByName(still_short(again, comp, 2)).distinct()
    rest = scratch.keep(short_sets.join(bare, "node", "left_semi"))
    if not rest.isEmpty():
        pairs3 = scratch.keep(ordered(_by_rarest(scratch, rest, comp))
                              .join(pairs, ["a", "b"], "left_anti").join(pairs2, ["a", "b"], "left_anti"))
        links3 = verified(pairs3, rest)
        comp = merged(scratch, comp, links3)

    scratch.free(found, again, sets, short_sets, rest)
    placed = nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    place = placed.join(lowest, "comp").select("node", "component_id")
    if count_links:
        place = place.join(_degrees(scratch, nodes, comp, whole_sets), "node", "left")
    place = scratch.keep(place)
    return meta.join(place, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("n_links", F.lit(0)) if count_links else F.lit(None)).cast("long").alias("n_links"))


def _meetings(table: pa.Table) -> pa.Table:
    """(node, n_links) of the links between the two blocks of each meeting, or within its one block."""
    comp, x, y, side = (table.column(c).to_numpy() for c in ("comp", "x", "y", "side"))
    node, grams = table.column("node").to_numpy(), [np.frombuffer(g.as_buffer(), U) for g in table.column("grams").combine_chunks()]
    order = np.lexsort((node, side, y, x, comp))
    key = np.stack([comp, x, y], 1)[order]
    cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
    out = []
    for i, j in zip(cut, np.r_[cut[1:], len(order)], strict=True):
        rows = order[i:j]
        left, right = rows[side[rows] == 0], rows[side[rows] == 1]
        within = x[rows[0]] == y[rows[0]]
        right = left if within else right
        n = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        for p in range(0, len(left), TILE):
            for q in range(p if within else 0, len(right), TILE):
                links = _tile([grams[k] for k in left[p:p + TILE]], [grams[k] for k in right[q:q + TILE]])
                if within and p == q:
                    np.fill_diagonal(links, False)
                    n[0][p:p + TILE] += links.sum(1)
                else:
                    n[0][p:p + TILE] += links.sum(1)
                    n[1][q:q + TILE] += links.sum(0)
        out += [(node[left], n[0]), (node[right], n[1])]
    return pa.table({"node": pa.array(np.concatenate([o[0] for o in out])), "n_links": pa.array(np.concatenate([o[1] for o in out]))})


def _tile(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``a`` link to which of ``b``: common shingles counted by products of 0/1 matrices."""
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    common = np.zeros((len(a), len(b)), np.float64)
    at = []
    for flat, sizes in ((flat_a, na), (flat_b, nb)):
        col = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        held = shared[col] == flat if len(shared) else np.zeros(len(flat), bool)
        at.append((np.repeat(np.arange(len(sizes)), sizes)[held], col[held]))
    for low in range(0, len(shared), COLUMNS):
        part = []
        for (row, col), sizes in zip(at, (na, nb), strict=True):
            m = np.zeros((len(sizes), min(COLUMNS, len(shared) - low)), np.float32)
            here = (col >= low) & (col < low + COLUMNS)
            m[row[here], col[here] - low] = 1
            part.append(m)
        common += part[0] @ part[1].T
    return WHOLE * common >= SHARE * (na[:, None] + nb[None, :] - common)


def _degrees(scratch: Scratch, nodes: DataFrame, comp: DataFrame, whole_sets) -> DataFrame:
    """node and n_links, exactly: both ends of a link are in one component, so its sets are all compared.

    A component of two is a link. A larger one is dealt into blocks by a salt,
    and each pair of blocks meets once, so every pair of sets is compared once
    and only sums by set come out of a meeting. Small components share groups.
    """
    members = nodes.select("node", "n").join(comp, "node")
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("grams")).where("sets > 1")
    sizes = scratch.keep(sizes.withColumn("blocks", F.greatest(
        F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")))
    pairs = members.join(sizes.where("sets = 2"), "comp").select("node", F.lit(1).cast("bigint").alias("n_links"))
    wanted = scratch.keep(members.join(sizes.where("sets > 2"), "comp").select("node", "comp", "blocks"))
    if wanted.isEmpty():
        return pairs
    total = sizes.where("sets > 2 and blocks = 1").agg(F.sum("grams")).first()[0] or 0
    groups = 1 + total // BLOCK_GRAMS
    dealt = whole_sets(wanted.select("node")).join(wanted, "node") \
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(17)), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("node", "grams", "comp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                (F.col("own") > F.col("other")).cast("int").alias("side"),
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(groups))).alias("shared_group")) \
        .withColumn("meeting", F.coalesce("shared_group", F.xxhash64("comp", "x", "y"))).drop("shared_group")
    counted = dealt.groupBy("meeting").applyInArrow(_meetings, "node bigint, n_links bigint")
    return scratch.keep(counted.groupBy("node").agg(F.sum("n_links").alias("n_links")).unionByName(pairs))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those whose component holds a smaller doc_id.

    Rows that repeat a doc_id count as one document: all of them stay or go.
    Rows without an id stay.
    """
    places = similar_texts(docs, count_links=False).where("component_id < doc_id").select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(places, docs["doc_id"] == places["_later"], "left_anti")


def _short_of_units(sets: DataFrame) -> DataFrame:
    """Nodes whose filled segments, the wider ones counted twice, are fewer than they need."""
    def run(batches):
        for b in batches:
            out = [node for node, blob in zip(b.column("node").to_pylist(), b.column("grams").to_pylist(), strict=True)
                   if any(neighbour_signatures(np.frombuffer(blob, U), *r)[1] < 0 for r in roles(len(blob) // 8))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["node"])
    return sets.mapInArrow(run, "node bigint")


MARKS = [f"p{i}" for i in range(4)]


def _marked(batches):
    """Each set's shingles by 256 places, one bit each: whether an odd number of them falls there."""
    for b in batches:
        bits = np.zeros((b.num_rows, 64 * len(MARKS)), np.uint8)
        for row, blob in zip(bits, b.column("grams").to_pylist(), strict=True):
            grams = np.frombuffer(blob, U)
            row += (np.bincount((grams >> U(32)).astype(np.int64) % len(row), minlength=len(row)) & 1).astype(np.uint8)
        longs = np.packbits(bits, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("node"), *(pa.array(longs[:, i].copy()) for i in range(len(MARKS)))],
                                         ["a", *MARKS])


def _by_rarest(scratch: Scratch, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs of different components that share one of both sets' rarest shingles.

    A partner shares at least 3/4 of a set's shingles, so one of the rarest
    n - ceil(3n / 4) + 1 is shared: both sets order their shingles alike. The
    join itself leaves out pairs that can't link: if this is the first shared
    shingle, at most the rest of either set is shared too, and the sets'
    odd places differ in no more places than the sets in shingles.
    """
    def run(batches):
        for b in batches:
            grams = [np.frombuffer(x, np.int64) for x in b.column("grams").to_pylist()]
            sizes = np.array([len(g) for g in grams], np.int64)
            nodes = np.repeat(b.column("node").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.repeat(sizes, sizes), pa.int32()),
                                              pa.array(np.concatenate(grams) if grams else np.empty(0, np.int64))], ["a", "na", "gram"])

    rows = scratch.keep(sets.mapInArrow(run, "a bigint, na int, gram bigint"))
    counts = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    order = Window.partitionBy("a").orderBy("held", "gram")
    marks = sets.mapInArrow(_marked, ", ".join(["a bigint", *(f"{p} bigint" for p in MARKS)]))
    rare = rows.join(counts, "gram").withColumn("place", F.row_number().over(order)) \
        .where(f"place <= na - ceil({SHARE} * na / {WHOLE}) + 1 and held > 1") \
        .join(comp.withColumnRenamed("node", "a"), "a", "left").withColumn("comp", F.coalesce("comp", "a")) \
        .join(marks, "a").select("gram", "a", "na", "comp", "place", *MARKS)
    rare = scratch.keep(rare)
    mixed = rare.groupBy("gram").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("gram")
    left = rare.join(mixed, "gram", "left_semi").alias("l")
    apart = " + ".join(f"bit_count(l.{p} ^ r.{p})" for p in MARKS)
    may = F.expr(f"""l.gram = r.gram and l.a < r.a and l.comp <> r.comp
        and {WHOLE} * least(l.na, r.na) >= {SHARE} * greatest(l.na, r.na)
        and {WHOLE + SHARE} * (1 + least(l.na - l.place, r.na - r.place)) >= {SHARE} * (l.na + r.na)
        and {WHOLE + SHARE} * ({apart}) <= {WHOLE - SHARE} * (l.na + r.na)""")
    return left.join(rare.alias("r"), may).selectExpr("l.a as a", "l.na as na", "r.a as b", "r.na as nb")
