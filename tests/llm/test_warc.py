"""The archive writer and reader: round trips, brute force for revisits, equal bytes at any width, failures."""

import base64
import gzip
import hashlib
import os
import random

import pytest

from callsheet.llm import warc
from callsheet.llm.queries import op11_warc

SCHEMA = "page_id bigint, url string, html string, digest string, size int, copy int, shard string"


def pages(rng):
    bodies = [None, "", "<p>ü</p>", "a\r\n\r\nb", "\r\n\r\n", "WARC/1.1\r\n", "x" * 300_000, *(f"<html>{rng.random()}</html>" * 40 for _ in range(40))]
    urls = [None, "", "http://a.example/x y", "http://b.example/\r\nX: 1", "http://ü.example/?q=%20#f"]
    rows = [(rng.choice((i, i, i, 3, None)), rng.choice((*urls, *[f"http://c.example/{i}"] * 5)), rng.choice(bodies)) for i in range(300)]
    return rows + rows[:40] + [(7, "http://hot.example/", "same")] * 2500


def table(spark, rows, width=5):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(width)


def brute(rows, least=0):
    best = {}
    for page, url, html in rows:
        key = (page is not None, page or 0, url is not None, url or "")
        best[html or ""] = max(best.get(html or "", key), key)
    out, used = [], set()
    for page, url, html in rows:
        text = html or ""
        raw = text.encode()
        known = best[text]
        own = len(raw) < least or (known == (page is not None, page or 0, url is not None, url or "") and text not in used)
        if own:
            used.add(text)
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit",
                    None if own or not known[0] else known[1]))
    return sorted(out, key=repr)


def short(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("least", [0, 1, 30])
def test_records_equal_brute_force(spark, tmp_path, least):
    rows = pages(random.Random(1))
    manifest = warc.write_archive(table(spark, rows), f"{tmp_path}/a", min_revisit_bytes=least, shard_bytes=200_000, file_bytes=30_000)
    got = warc.read_archive(spark, f"{tmp_path}/a")
    assert short(got) == brute(rows, least)
    known = {(base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()): (h or "").encode() for _, _, h in rows}
    responses = got.where("record_type = 'response'").collect()
    assert all(bytes(r.payload) == known[r.payload_digest] for r in responses)
    assert got.where("record_type = 'revisit' and payload is not null").count() == 0
    files = manifest.collect()
    assert len({f.shard for f in files}) > 2 and len(files) > len({f.shard for f in files})
    assert all(f.bytes <= 30_000 or f.records == 1 for f in files)
    assert sum(f.records for f in files) == len(rows)
    for f in files:
        data = open(f"{tmp_path}/a/{f.name}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (f.bytes, f.sha256)
    assert not os.path.exists(f"{tmp_path}/a/_staging")


def test_query_on_the_whole_table(spark, tmp_path):
    rows = pages(random.Random(2))
    table(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    assert short(op11_warc(spark, str(tmp_path))) == brute(rows)


def test_equal_tables_give_equal_files(spark, tmp_path):
    rows = pages(random.Random(3))
    out = []
    for k, (width, shuffled) in enumerate(((1, 3), (9, 17))):
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        try:
            random.Random(k).shuffle(rows)
            warc.write_archive(table(spark, rows, width), f"{tmp_path}/{k}", shard_bytes=150_000, file_bytes=20_000)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        out.append({n: open(f"{tmp_path}/{k}/{n}", "rb").read() for n in os.listdir(f"{tmp_path}/{k}") if n.endswith(".gz")})
    assert len(out[0]) > 5 and out[0] == out[1]


def test_files_are_plain_warc(spark, tmp_path):
    rows = [(1, "http://a.example/", "one"), (2, "http://b.example/é", "one"), (3, None, "two")]
    warc.write_archive(table(spark, rows), f"{tmp_path}/a")
    (name,) = [n for n in os.listdir(f"{tmp_path}/a") if n.endswith(".gz")]
    text = gzip.open(f"{tmp_path}/a/{name}").read().decode()
    assert text.count("WARC/1.1\r\n") == 4 and text.startswith("WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    first, second, third = (x.split("\r\n") for x in text.split("WARC/1.1\r\n")[2:])
    assert "WARC-Type: revisit" in first and "WARC-Refers-To-Target-URI: http://b.example/%C3%A9" in first
    its = [x for x in second if x.startswith("WARC-Record-ID")][0].split(": ")[1]
    assert f"WARC-Refers-To: {its}" in first and "WARC-Target-URI: urn:page:3" in third
    assert second[-4:] == ["", "one", "", ""] and "Content-Length: 3" in second


def test_staged_files_alone_are_no_archive(spark, tmp_path):
    path = f"{tmp_path}/a"
    os.makedirs(f"{path}/_staging")
    open(f"{path}/_staging/pages-0000000-00000.warc.gz.lost", "wb").write(b"half a file of a lost task")
    with pytest.raises(ValueError):
        warc.read_archive(spark, path)
    rows = [(1, "u", "one")]
    warc.write_archive(table(spark, rows), path)
    assert short(warc.read_archive(spark, path)) == brute(rows)
    with pytest.raises(ValueError):
        warc.write_archive(table(spark, rows), path)


def test_renaming_again_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/a"
    os.makedirs(f"{path}/_staging")
    staged = spark.createDataFrame([(0, "f.warc.gz", "t1", 1, 4, "x")], "shard bigint, name string, attempt string, records bigint, bytes bigint, sha256 string")
    open(f"{path}/_staging/f.warc.gz.t1", "wb").write(b"data")
    assert warc._renamed(staged, path).collect() == warc._renamed(staged, path).collect()
    assert open(f"{path}/f.warc.gz", "rb").read() == b"data"
    open(f"{path}/f.warc.gz", "wb").write(b"longer data")
    with pytest.raises(Exception, match="neither staged"):
        warc._renamed(staged, path).collect()


def test_damaged_files_are_found():
    good = warc.page_record(1, "u", hashlib.sha1(b"one").digest(), 0, 3, b"one", None, warc.DATE)
    headers, block = warc.parsed(gzip.decompress(good))
    assert warc.page_of(headers, block)[2] == b"one"
    with pytest.raises(ValueError, match="block digest"):
        warc.parsed(gzip.decompress(good).replace(b"one", b"two"))
    with pytest.raises(ValueError, match="length"):
        warc.parsed(gzip.decompress(good)[:-1])
    wrong = warc.page_record(1, "u", hashlib.sha1(b"two").digest(), 0, 3, b"one", None, warc.DATE)
    with pytest.raises(ValueError, match="payload"):
        warc.page_of(*warc.parsed(gzip.decompress(wrong)))


def test_empty_table(spark, tmp_path):
    warc.write_archive(table(spark, []), f"{tmp_path}/a")
    assert warc.read_archive(spark, f"{tmp_path}/a").collect() == []
