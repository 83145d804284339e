"""WARC archives: a deterministic sharded writer with revisits, and a checking reader.

Writing, for pages of (page_id, url, html):

1. Repeated rows are counted, and of all records with equal payloads of at least
   ``min_revisit_bytes`` that with the largest page_id (then url) is the response;
   the others become revisits of it. Smaller payloads are all responses.
2. The records, without payloads, are range-sorted by (page_id, url, digest, copy).
   Running sums of their sizes within the ranges, plus the sums of the ranges
   before, cut the order into shards of ``shard_bytes``. Range bounds come from a
   sample, shards don't: they follow from the rows alone.
3. Headers and digests are made anew for each response and the record is
   compressed to a gzip member of its own, which is the only form in which a
   payload moves, once, to its shard. The shards' first keys, of at most
   ``MAX_SHARDS`` shards, tell a page its shard.
4. A shard's task streams its records in order into files, rolled when the
   compressed size would pass ``file_bytes``. Files get temporary names of the
   task's attempt; those of attempts that Spark committed are renamed, and the
   manifest (a row per file with size, records and hash) is published last, by
   one rename. A folder without a manifest is no archive.

Record ids and dates follow from the rows, so equal tables give equal files byte
for byte, whatever the partitions. Of digests with more than ``HOT_SHARE`` of
the rows (at most 1 / HOT_SHARE of them, broadcast) only the response's rows keep
their payloads, and a repeated row is written in runs of ``COPIES`` records, so
no hot payload or row meets in one task.

Files are opened by tasks through ``pyarrow.fs``: the archive's folder must be
on storage that driver and executors share.

Defined results: a null html is an empty payload; a null page_id is the smallest;
a null url becomes a URN of the page's number; characters that can't stand in a
header are percent-encoded; every repeated row is a record of its own; an empty
table gives an archive without files; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import skew_safe_join
from .common import Memo, Scratch, ship

MIN_REVISIT_BYTES = 0
SHARD_BYTES = 128 << 20  # of records before compression: what a task writes
MAX_SHARDS = 65_536  # beyond, shards grow
FILE_BYTES = 16 << 20  # of compressed records
HOT_SHARE = 0.001
COPIES = 1000
HEAD_BYTES = 700  # about a record's headers
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("5b0f6c1e-7f0b-5c55-9d3e-0c5b7f4b0a11")
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F))
_ORDER = ("page_id", "url", "digest", "copy")

MANIFEST = "shard bigint, name string, records bigint, bytes bigint, sha256 string"


# --- records ------------------------------------------------------------------


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, url: str | None, digest: bytes, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {copy} {digest.hex()} {url}')}>"


def target(page_id: int | None, url: str | None) -> str:
    return f"urn:page:{page_id}" if url is None else quote(url, safe=_PLAIN, errors="surrogatepass")


def member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record as one gzip member without a time."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, digest: bytes, copy: int, size: int, payload: bytes | None,
                refers: tuple[int | None, str | None] | None, date: str) -> bytes:
    """A response (with its payload) or, with ``refers``, a revisit of that page."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    revisit = refers is not None
    return member([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, url, digest, copy)),
        ("WARC-Date", date), ("WARC-Target-URI", target(page_id, url)),
        ("WARC-Payload-Digest", "sha1:" + base32(digest)), ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(*refers, digest, 0) if revisit else None),
        ("WARC-Refers-To-Target-URI", target(*refers) if revisit else None),
        ("WARC-Refers-To-Date", date if revisit else None),
        ("Page-ID", page_id), ("Page-Refers-To", refers[0] if revisit else None), ("Page-Payload-Length", size),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))], block)


def info_record(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"), ("WARC-Date", date),
                   ("WARC-Filename", name), ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())),
                   ("Content-Type", "application/warc-fields"), ("Content-Length", len(block))], block)


# --- planning -----------------------------------------------------------------


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    return rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("size", F.octet_length("payload").cast("bigint"))


def _planned(scratch: Scratch, base: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """All records without large payloads (runs of copies in one row), and each digest's rows and response."""
    same = [F.count(F.lit(1)).alias("copies"), F.max("size").alias("size")]
    if min_bytes > 0:
        same.append(F.first(F.when(F.col("size") < min_bytes, F.col("payload"))).alias("small"))
    rows = base.groupBy("page_id", "url", "digest").agg(*same)
    rows = scratch.keep(rows if min_bytes > 0 else rows.withColumn("small", F.lit(None).cast("binary")))
    best = scratch.keep(rows.groupBy(F.col("digest").alias("_digest")).agg(
        F.max(F.struct("page_id", "url")).alias("best"), F.sum("copies").alias("rows")))
    known = skew_safe_join(rows, best.select("_digest", "best"), "digest", "_digest").drop("_digest")
    # the first record of a row, then its further copies by runs
    runs = F.sequence(F.lit(0).cast("bigint"), F.ceil((F.col("copies") - 1) / COPIES).cast("bigint"))
    known = known.select("*", F.explode(runs).alias("_run"))
    first = F.col("_run") == 0
    known = known.withColumn("copy", F.when(first, F.lit(0).cast("bigint")).otherwise(1 + (F.col("_run") - 1) * COPIES)) \
        .withColumn("last", F.when(first, F.lit(0).cast("bigint")).otherwise(F.least(F.col("copies") - 1, F.col("_run") * COPIES)))
    own = (F.col("size") < min_bytes) | (first & F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url")))
    return known.select(*_ORDER, "last", "size", "small", F.when(~own, F.col("best")).alias("refers")), best


def _sharded(scratch: Scratch, records: DataFrame, shard_bytes: int) -> DataFrame:
    """The records with their shard: where the sum of the sizes before them falls in the whole order."""
    one = HEAD_BYTES + F.when(F.col("refers").isNull(), F.col("size")).otherwise(0)
    ranged = records.withColumn("weight", (F.col("last") - F.col("copy") + 1) * one) \
        .repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    names = [f.name for f in ranged.schema.fields]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            weights = b.column("weight").to_pylist()
            before = []
            for w in weights:
                before.append(total)
                total += w
            columns = [*(b.column(c) for c in names), pa.array([part] * b.num_rows, pa.int64()), pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "part", "before"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    kept = scratch.keep(ranged.mapInArrow(summed, f"{kinds}, part bigint, before bigint"))
    # a row for each range: as many as shuffle partitions
    parts = kept.groupBy("part").agg(F.max(F.col("before") + F.col("weight")).alias("_sum"))
    total = parts.agg(F.sum("_sum")).first()[0] or 0
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    shard = F.floor((F.col("_base") + F.col("before")) / max(shard_bytes, -(-total // MAX_SHARDS))).cast("bigint")
    return scratch.keep(kept.join(F.broadcast(parts), "part").select(*_ORDER, "last", "size", "small", "refers", shard.alias("shard")))


def _key(page_id: int | None, url: str | None, digest: bytes, copy: int = 0) -> tuple:
    """A record's place in the order, as Spark sorts: nulls first, texts by their bytes."""
    return page_id is not None, page_id or 0, url is not None, (url or "").encode("utf-8", "surrogatepass"), digest, copy


def _members(base: DataFrame, best: DataFrame, plan: DataFrame, min_bytes: int, date: str) -> DataFrame:
    """Each large payload as the compressed response of its page, in the shard where that would stand.

    Rows of hot digests that aren't the response's are left out before. Of the
    others, revisits' payloads come along and are left out by the writer; a
    repeated row may come more than once.
    """
    total = best.agg(F.sum("rows")).first()[0] or 0
    hot = best.where(F.col("rows") > total * HOT_SHARE).select("_digest", "best")
    large = base.where(F.col("size") >= min_bytes).join(F.broadcast(hot), F.col("digest") == F.col("_digest"), "left")
    large = large.where(F.col("_digest").isNull() | (F.col("page_id").eqNullSafe(F.col("best.page_id"))
                                                     & F.col("url").eqNullSafe(F.col("best.url"))))
    # at most MAX_SHARDS rows
    first = plan.groupBy("shard").agg(F.min(F.struct(*_ORDER)).alias("key")).collect()
    starts = sorted((_key(r["key"]["page_id"], r["key"]["url"], bytes(r["key"]["digest"]), r["key"]["copy"]), r["shard"]) for r in first)
    keys, shards = [k for k, _ in starts], [n for _, n in starts]

    def sealed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Memo(50_000)
        for b in batches:
            rows = []
            for page_id, url, payload, digest in zip(*b.columns, strict=True):
                key = page_id.as_py(), url.as_py(), digest.as_py()
                new: list = []
                seen.get(key, lambda _: new.append(1) or True)  # noqa: B023
                if new:
                    payload = payload.as_py()
                    rows.append((shards[bisect_right(keys, _key(*key)) - 1], *key, page_record(*key, 0, len(payload), payload, None, date)))
            kinds = pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                             ["shard", "page_id", "url", "digest", "member"])

    return large.select("page_id", "url", "payload", "digest").mapInArrow(
        sealed, "shard bigint, page_id bigint, url string, digest binary, member binary")


# --- writing ------------------------------------------------------------------


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and its path there."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Roll:
    """The files of one shard, one open at a time."""

    def __init__(self, root: str, shard: int, attempt: str, file_bytes: int, date: str):
        self.fs, self.root = store(root)
        self.shard, self.attempt, self.limit, self.date = shard, attempt, file_bytes, date
        self.done: list[dict] = []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is None or self.size + len(data) > self.limit and self.records:
            self.close()
            self.name = f"pages-{self.shard:07d}-{len(self.done):05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.root}/_staging/{self.name}.{self.attempt}", compression=None)
            self.size = self.records = 0
            self.sha = hashlib.sha256()
            self._put(info_record(self.name, self.date))
        self._put(data)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append({"shard": self.shard, "name": self.name, "attempt": self.attempt, "records": self.records,
                              "bytes": self.size, "sha256": self.sha.hexdigest()})


def _written(plan: DataFrame, members: DataFrame, path: str, min_bytes: int, file_bytes: int, date: str) -> DataFrame:
    """The records' files below ``_staging``: a row for each file of this attempt.

    A shard's planned records and compressed responses are sorted together: a
    response's payload stands right before its record.
    """
    schema = pa.schema([("shard", pa.int64()), ("name", pa.string()), ("attempt", pa.string()), ("records", pa.int64()),
                        ("bytes", pa.int64()), ("sha256", pa.string())])
    rows = plan.unionByName(members, allowMissingColumns=True).withColumn("copy", F.coalesce("copy", F.lit(0).cast("bigint")))
    order = ("shard", *_ORDER)
    names = (*order, "last", "size", "small", "refers", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        roll, held = None, (None, None)
        for b in batches:
            for row in zip(*(b.column(c) for c in names), strict=True):
                shard, page_id, url, digest, copy, last, size, small, refers = (x.as_py() for x in row[:-1])
                key = page_id, url, digest
                if last is None:
                    held = key, row[-1]
                    continue
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        yield pa.RecordBatch.from_pylist(roll.done, schema)
                    roll = _Roll(path, shard, attempt, file_bytes, date)
                if refers is None and size >= min_bytes:
                    if held[0] != key:
                        raise ValueError(f"the payload of page {page_id} is missing")
                    roll.add(held[1].as_py())
                    continue
                for n in range(copy, last + 1):
                    roll.add(page_record(*key, n, size, small, (refers["page_id"], refers["url"]) if refers else None, date))
        if roll is not None:
            roll.close()
            yield pa.RecordBatch.from_pylist(roll.done, schema)

    kinds = "shard bigint, name string, attempt string, records bigint, bytes bigint, sha256 string"
    dealt = rows.select(*names).repartition("shard").sortWithinPartitions(*order, F.col("last").isNotNull())
    return dealt.mapInArrow(run, kinds)


def _renamed(staged: DataFrame, path: str) -> DataFrame:
    """The staged files under their names. Done again by another attempt, it finds them there."""
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(path)
        for b in batches:
            for name, attempt, size in zip(b.column("name").to_pylist(), b.column("attempt").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                staged_name, final = f"{root}/_staging/{name}.{attempt}", f"{root}/{name}"
                if files.get_file_info(staged_name).type == fs.FileType.File:
                    files.move(staged_name, final)
                elif files.get_file_info(final).size != size:
                    raise OSError(f"{name} was neither staged nor committed whole")
            yield b.select(names)

    return staged.mapInArrow(run, MANIFEST)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, shard_bytes: int = SHARD_BYTES,
                  file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``pages`` as an archive below ``path``; returns its manifest. An archive that is there stays and is an error."""
    spark = pages.sparkSession
    ship(spark)
    files, root = _hadoop(spark, path)
    child = spark._jvm.org.apache.hadoop.fs.Path
    if files.exists(child(root, "manifest")):
        raise ValueError(f"{path} holds an archive")
    files.mkdirs(child(root, "_staging"))
    scratch = Scratch(spark, "warc")
    base = _payloads(pages)
    plan, best = _planned(scratch, base, min_revisit_bytes)
    plan = _sharded(scratch, plan, shard_bytes)
    members = _members(base, best, plan, min_revisit_bytes, date)
    staged = scratch.keep(_written(plan, members, path, min_revisit_bytes, file_bytes, date))
    _renamed(staged, path).write.mode("overwrite").json(f"{path}/_manifest")
    files.rename(child(root, "_manifest"), child(root, "manifest"))
    files.delete(child(root, "_staging"), True)
    scratch.free(*scratch.tables)
    return read_manifest(spark, path)


# --- reading ------------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    files, root = _hadoop(spark, path)
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(root, "manifest")):
        raise ValueError(f"{path} holds no committed archive")
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, each unpacked whole."""
    data = stream.read(chunk)
    while data:
        z, parts = zlib.decompressobj(31), []
        while True:
            parts.append(z.decompress(data))
            if z.eof:
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("a record is cut off")
        data = z.unused_data or stream.read(chunk)
        yield b"".join(parts)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record, its length and digest checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[:int(headers["content-length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't fit")
    if headers["warc-block-digest"] != "sha1:" + base32(hashlib.sha1(block).digest()):
        raise ValueError(f"block digest of {headers['warc-record-id']} doesn't fit")
    return headers, block


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, target URI, payload (None: a revisit), its size and digest, record type and refers_to."""
    payload, digest = None, headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(headers["page-payload-length"])
    if headers["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} doesn't fit")
    number = {k: int(headers[k]) if k in headers else None for k in ("page-id", "page-refers-to")}
    return number["page-id"], headers["warc-target-uri"], payload, size, digest, headers["warc-type"], number["page-refers-to"]


PAGES = "page_id bigint, target_uri string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The archive's page records, all lengths and digests checked; a file is streamed by one task.

    ``payloads=False`` checks them and leaves them out.
    """
    ship(spark)
    schema = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(path)
        for b in batches:
            for name, records in zip(b.column("name").to_pylist(), b.column("records").to_pylist(), strict=True):
                rows, held, found = [], 0, 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        headers, block = parsed(raw)
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        got = page_of(headers, block)
                        found += 1
                        rows.append(got if payloads else (*got[:2], None, *got[3:]))
                        held += 200 + (len(got[2] or b"") if payloads else 0)
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if found != records:
                    raise ValueError(f"{name} holds {found} of {records} records")
                if rows:
                    yield batch(rows)

    manifest = read_manifest(spark, path).select("name", "records")
    # a task for each file: their rows are few, and would be joined into one task by size
    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, PAGES)
