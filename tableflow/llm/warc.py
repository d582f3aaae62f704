"""WARC archives: one gzip member per record, written and read back in sequence."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.rows import stored

VERSION = b"WARC/1.1"
BLOCK = 1 << 16
FILE_BYTES = 256 << 20
COLUMNS = ("name", "uri", "payload", "digest", "refers_to")
# WARC 1.1, annex of revisit profiles.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = (
    "path string, offset long, type string, id string, uri string, digest string, "
    "refers_to string, payload_bytes long, payload binary"
)


# ---- writing -----------------------------------------------------------------------------------

def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record(name: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or a revisit that names the response."""
    headers = [
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
        *([("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A"))] if uri else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
    ]
    block = _http(len(payload))
    if refers_to:
        headers += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    else:
        block += payload
        headers.append(("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"))
    return _member(headers, block)


def _info(name: str) -> bytes:
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", own), ("WARC-Date", DATE),
         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
        b"format: WARC File Format 1.1\r\n",
    )


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes (name, uri, payload, digest, refers_to) rows as .warc.gz files; the manifest of their paths.

    A task writes its rows one after another into files of about ``file_bytes``. Files have names of
    the attempt, and the manifest, itself a stored table, has those of attempts that succeeded:
    what a lost executor leaves behind is never read. The folder must be one all executors
    share.
    """
    spark = records.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, path, size, done = None, "", 0, []
        try:
            for batch in batches:
                for row in zip(*(batch.column(c) for c in COLUMNS), strict=True):
                    if out is None:
                        store.create_dir(root, recursive=True)
                        name = f"{stem}-{len(done):04d}.warc.gz"
                        path = f"{root}/{name}"
                        out = store.open_output_stream(path, compression=None)
                        size = out.write(_info(name))
                    size += out.write(record(*(v.as_py() for v in row)))
                    if size >= file_bytes:
                        out.close()
                        out = None
                        done.append((path, size))
        finally:
            if out is not None:
                out.close()
                done.append((path, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in done]), pa.array([s for _, s in done], pa.int64())], ["path", "size"]
            )

    return stored(spark, records.mapInArrow(write, "path string, size long"), "warc-manifest")


# ---- reading -----------------------------------------------------------------------------------

class DamagedRecord(ValueError):
    pass


class _Member:
    """The bytes of one gzip member, decompressed as they are asked for."""

    def __init__(self, reader: MemberReader):
        self.reader, self.unpacker, self.ready = reader, zlib.decompressobj(31), bytearray()

    def fill(self) -> bool:
        """More decompressed bytes; whether there are any before the member's end."""
        while not self.unpacker.eof:
            if self.unpacker.unconsumed_tail:
                packed = self.unpacker.unconsumed_tail
            else:
                packed = self.reader.take()
                if not packed and not self.unpacker.decompress(b"", 1) and not self.unpacker.eof:
                    raise DamagedRecord(f"the file ends within a record at {self.reader.offset}")
            more = self.unpacker.decompress(packed, BLOCK)
            if self.unpacker.eof:
                self.reader.back(self.unpacker.unused_data)
            if more:
                self.ready += more
                return True
        return False

    def line(self) -> bytes:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self.fill():
                raise DamagedRecord("a header without an end")
        out = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return out

    def exactly(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.ready and not self.fill():
                raise DamagedRecord(f"{size} bytes less than the content length")
            part = bytes(self.ready[:size])
            del self.ready[:size]
            size -= len(part)
            yield part

    def rest(self) -> bytes:
        while self.fill():
            if len(self.ready) > 4:
                break
        return bytes(self.ready)


class MemberReader:
    """A file's gzip members, in sequence, with their offsets."""

    def __init__(self, source: BinaryIO):
        self.source, self.held, self.offset, self.position = source, b"", 0, 0

    def take(self) -> bytes:
        out, self.held = self.held or self.source.read(BLOCK), b""
        self.position += len(out)
        return out

    def back(self, unused: bytes) -> None:
        self.held = unused + self.held
        self.position -= len(unused)

    def __iter__(self) -> Iterator[_Member]:
        while first := self.take():
            self.back(first)
            self.offset = self.position
            yield _Member(self)


def _headers(member: _Member) -> dict[str, str]:
    out = {}
    while line := member.line():
        key, _, value = line.partition(b":")
        out[key.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def read_records(source: BinaryIO, path: str = "") -> Iterator[dict]:
    """The response and revisit records of an archive, one after another.

    The block of a record is as long as its Content-Length says and must be followed by two line
    ends and the end of its gzip member. Block and payload digests are computed while the block
    passes and compared with the headers; a difference raises :class:`DamagedRecord`. The payload
    is what follows the HTTP headers; for a revisit its size is the HTTP Content-Length.
    """
    reader = MemberReader(source)
    for member in reader:
        offset = reader.offset
        if not member.line().startswith(b"WARC/"):
            raise DamagedRecord(f"no WARC version at {offset}")
        warc = _headers(member)
        block, kind = hashlib.sha1(), warc.get("warc-type", "")
        parts = []
        for part in member.exactly(int(warc["content-length"])):
            block.update(part)
            parts.append(part)
        if member.rest() != b"\r\n\r\n":
            raise DamagedRecord(f"the record at {offset} isn't framed by its content length")
        said = warc.get("warc-block-digest")
        if said and said != f"sha1:{block.hexdigest()}":
            raise DamagedRecord(f"block digest of the record at {offset}")
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = b"".join(parts).partition(b"\r\n\r\n")
        fields = dict(
            (k.strip().lower(), v.strip()) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])
        )
        digest = warc.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "response" and digest and digest != hashlib.sha1(payload).hexdigest():
            raise DamagedRecord(f"payload digest of the record at {offset}")
        yield {
            "path": path, "offset": offset, "type": kind, "id": warc.get("warc-record-id"),
            "uri": warc.get("warc-target-uri"), "digest": digest, "refers_to": warc.get("warc-refers-to"),
            "payload_bytes": int(fields.get(b"content-length", len(payload))),
            "payload": payload if kind == "response" else None,
        }


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files, each read in sequence by a task of its own.

    A file that the manifest names several times is read once; a manifest without rows gives none. A
    damaged record fails the job. Payloads are as they were written, the empty one too, and a record is
    held whole while its digests are checked; others of its file aren't, beyond batches of 4 MB.
    """
    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for found in read_records(source, path):
                        if not payloads:
                            found.pop("payload")
                        held.append(found)
                        size += 500 + len(found.get("payload") or b"")
                        if size > 4 << 20:
                            yield _batch(held, payloads)
                            held, size = [], 0
                    if held:
                        yield _batch(held, payloads)

    files = manifest.select("path").distinct()
    # Ranges of as many distinct names as there are partitions hold one each. A given number of ranges
    # is neither merged at run time nor satisfied by the shuffle of distinct().
    return files.repartitionByRange(max(1, files.count()), "path").mapInArrow(read, schema)


def _batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [c.split()[0] for c in RECORD.split(", ")][: None if payloads else -1]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names], names
    )


# ---- pages -------------------------------------------------------------------------------------

def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000
) -> DataFrame:
    """Pages as rows for :func:`write_archives`, each named by its page id.

    The payload is the html in UTF-8, empty for a null. Of pages with equal payloads of at least
    ``least_bytes`` that with the greatest id is a response, and the others revisit it; smaller
    ones are all responses. Rows that repeat the greatest id are all responses; a null id comes
    before all others, and without others its page is a response. Payloads are equal if SHA-1, a
    64-bit hash and size are.

    The search for equal payloads counts hashes within tasks before it moves them, so a payload
    that a third of the pages hold is one row a task; in the join such a payload's pages can be
    split, as both sides lie directly on their shuffles.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("uri"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({
        "digest": F.sha1("payload"), "hash": F.xxhash64("payload"), "bytes": F.octet_length("payload"),
    })
    key = ["digest", "hash", "bytes"]
    latest = rows.where(F.col("bytes") >= least_bytes).groupBy(*key).agg(
        F.max("page_id").alias("last"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    name = lambda c: F.format_string("<urn:x-page:%s>", F.coalesce(c.cast("string"), F.lit("none")))
    revisits = F.coalesce(F.col("page_id"), F.lit(-(1 << 63))) < F.col("last")
    return rows.join(latest, key, "left").select(
        name(F.col("page_id")).alias("name"), "uri", "payload", "digest",
        F.when(revisits, name(F.col("last"))).alias("refers_to"),
    )


def page_number(name: Column) -> Column:
    """The page id in a record's name."""
    return F.regexp_extract(name, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
