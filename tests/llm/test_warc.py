import gzip
import hashlib
import io
import zlib
from pathlib import Path

import pytest

from pyspark.sql import functions as F
from tableflow.llm import warc

PAGES = [
    (1, "http://a/1", "<p>" + "x" * 2000), (2, "http://a/2", "<p>" + "x" * 2000), (5, None, "<p>" + "x" * 2000),
    (3, "http://a/\r\n3", "short"), (4, "http://a/4", "short"), (6, "http://a/6", None), (7, "u", ""),
    (8, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "é" * 499 + "x"), (11, "u", "é" * 499 + "x"),
    (12, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n" * 90000),
    (None, "n", "<p>" + "x" * 2000), (20, "r", "y" * 1500), (20, "r", "y" * 1500), (19, "r", "y" * 1500),
]


def archived(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(warc.page_records(pages), folder, **options)
    return manifest, warc.read_archives(spark, manifest, folder)


@pytest.mark.parametrize("file_bytes", [1 << 28, 100])
def test_round_trip(spark, tmp_path, file_bytes):
    manifest, records = archived(spark, tmp_path, PAGES, file_bytes=file_bytes)
    if file_bytes == 100:
        assert manifest.count() >= len(PAGES) - 3
    found = records.withColumn("page_id", warc.page_number(F.col("id"))).collect()
    assert len(found) == len(PAGES)
    payloads = {(i, (html or "").encode()) for i, _, html in PAGES}
    for r in found:
        said = {p for i, p in payloads if i == r.page_id}
        assert len(said) == 1
        payload = said.pop()
        assert (r.payload_bytes, r.digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert r.payload == (payload if r.type == "response" else None)
    refers = {(r.page_id, r.type, warc_id(r.refers_to)) for r in found}
    assert {(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (None, "revisit", 5)} <= refers
    assert {(3, "response", None), (4, "response", None), (6, "response", None), (7, "response", None)} <= refers
    assert {(8, "revisit", 9), (9, "response", None), (10, "response", None), (11, "response", None)} <= refers
    assert {(19, "revisit", 20), (20, "response", None)} <= refers


def warc_id(name):
    return int(name.removeprefix("<urn:x-page:").removesuffix(">")) if name else None


def test_one_gzip_member_per_record(spark, tmp_path):
    manifest, records = archived(spark, tmp_path, PAGES)
    paths = [r.path for r in manifest.collect()]
    members = 0
    for path in paths:
        data = Path(path).read_bytes()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        while data:
            unpacker = zlib.decompressobj(31)
            assert unpacker.decompress(data).startswith(b"WARC/1.1\r\n")
            data, members = unpacker.unused_data, members + 1
    assert members == len(PAGES) + len(paths)
    for r in records.collect():  # an offset leads to its record
        with open(r.path, "rb") as source:
            source.seek(r.offset)
            assert next(warc.read_records(source))["id"] == r.id


def test_damage_is_found():
    good = warc.record("<urn:x-page:1>", "u", b"payload" * 400, hashlib.sha1(b"payload" * 400).hexdigest(), None)
    assert next(warc.read_records(io.BytesIO(good)))["payload"] == b"payload" * 400
    plain = gzip.decompress(good)
    for before, after in ((b"payloadp", b"payloadq"), (b"Content-Length: 2", b"Content-Length: 1"), (b"WARC/1.1", b"HTTP/1.1"),
                          (b"Content-Length: 2", b"Content-Length: 9")):
        with pytest.raises(warc.DamagedRecord):
            list(warc.read_records(io.BytesIO(gzip.compress(plain.replace(before, after, 1)))))
    with pytest.raises(warc.DamagedRecord):
        list(warc.read_records(io.BytesIO(good[:-20])))
    wrong = warc.record("<urn:x-page:1>", "u", b"x", hashlib.sha1(b"y").hexdigest(), None)
    with pytest.raises(warc.DamagedRecord):
        list(warc.read_records(io.BytesIO(good + wrong)))


def test_empty_table_and_clashing_columns(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    other = pages.withColumns({c: F.lit(0) for c in ("payload", "digest", "hash", "last", "name", "bytes")})
    assert sorted(map(repr, warc.page_records(other).collect())) == sorted(map(repr, warc.page_records(pages).collect()))
    manifest, records = archived(spark, tmp_path, PAGES[:0])
    assert manifest.count() == 0 and records.count() == 0


@pytest.mark.parametrize("shuffle", ["2", "4", "16", "40"])
def test_a_task_reads_one_file(spark, tmp_path, shuffle):
    """Whatever the number of shuffle partitions, equal to that of files or not."""
    rows = [(i, "u", f"{i}" * 700) for i in range(16)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(16)
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(warc.page_records(pages), folder, file_bytes=1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        found = warc.read_archives(spark, manifest.union(manifest), folder)
        tasks = found.select("path", F.spark_partition_id().alias("task")).distinct().collect()
        assert found.count() == 16
        assert len(tasks) == len({t.task for t in tasks}) == len({t.path for t in tasks}) == 16
        assert warc.read_archives(spark, manifest.limit(0), folder).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
