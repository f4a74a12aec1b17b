"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: pages that share a payload are found by digest; the one with the
smallest id becomes a ``response`` record, the others ``revisit`` records that
refer to it and carry only the HTTP header. Each task writes archives of its
own into a folder that all executors share; the manifest of the tasks that
succeeded names the archives that count.

Reading: a sequential reader per archive. The stream is decompressed member by
member and in small steps, a record is framed by its Content-Length, and its
block and payload digests are verified.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import materialise, shared_path, whole_text

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"

MANIFEST = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("n_records", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
])


class CorruptArchive(ValueError):
    """An archive breaks off, or a digest does not hold."""


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def urn(page_id: int | None) -> bytes:
    return f"<urn:page:{NO_ID if page_id is None else page_id}>".encode()


def from_urn(value: str) -> int | None:
    last = value.strip("<>").rpartition(":")[2]
    return None if last == NO_ID else int(last)


def make_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, is_first: bool) -> bytes:
    """One record as a gzip member."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if is_first else http
    fields = [
        (b"WARC-Type", b"response" if is_first else b"revisit"),
        (b"WARC-Record-ID", urn(page_id)),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
    ]
    if url is not None:
        fields.append((b"WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A").encode()))
    if not is_first:
        fields += [(b"WARC-Refers-To", urn(first)), (b"WARC-Profile", PROFILE)]
    fields += [
        (b"WARC-Payload-Digest", b"sha1:" + digest32(payload).encode()),
        (b"WARC-Block-Digest", b"sha1:" + digest32(block).encode()),
        (b"Content-Type", b"application/http;msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    head = VERSION + b"\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head + block + b"\r\n\r\n") + z.flush()


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def members(stream: BinaryIO, step: int = 1 << 16) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after the other."""
    z, out, fresh = zlib.decompressobj(31), [], True
    rest = b""
    while data := rest or stream.read(step):
        out.append(z.decompress(data))
        rest, fresh = z.unused_data, False
        if z.eof:
            yield b"".join(out)
            z, out, fresh = zlib.decompressobj(31), [], True
    if not fresh:
        raise CorruptArchive("the last member breaks off")


def headers_of(data: bytes) -> tuple[bytes, dict[str, str]]:
    first, *lines = data.split(b"\r\n")
    pairs = (line.partition(b":") for line in lines if line)
    return first, {k.decode().strip().lower(): v.decode().strip() for k, _, v in pairs}


def records(stream: BinaryIO) -> Iterator[Record]:
    """Verified records of an archive."""
    for m in members(stream):
        head, sep, body = m.partition(b"\r\n\r\n")
        version, headers = headers_of(head)
        if not sep or version != VERSION:
            raise CorruptArchive(f"not a record: {version[:40]!r}")
        n = int(headers["content-length"])
        block = body[:n]
        if len(block) != n or body[n:] != b"\r\n\r\n":
            raise CorruptArchive(f"{headers['warc-record-id']}: Content-Length does not frame the block")
        if headers["warc-block-digest"] != "sha1:" + digest32(block):
            raise CorruptArchive(f"{headers['warc-record-id']}: block digest")
        yield Record(headers, block)


def page_row(r: Record) -> tuple:
    http, _, payload = r.block.partition(b"\r\n\r\n")
    n = int(headers_of(http)[1]["content-length"])
    digest = r.headers["warc-payload-digest"].removeprefix("sha1:")
    kind, rid = r.headers["warc-type"], from_urn(r.headers["warc-record-id"])
    if kind == "response" and (len(payload) != n or digest32(payload) != digest):
        raise CorruptArchive(f"{r.headers['warc-record-id']}: payload digest")
    refers = from_urn(r.headers["warc-refers-to"]) if kind == "revisit" else None
    return rid, r.headers.get("warc-target-uri"), n, digest, kind, refers


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; returns the manifest.

    Uses ``page_id``, ``url`` and ``html`` (null html: empty payload; null url:
    no target). Of rows with one payload, those with the smallest id are
    responses (rows that repeat that id and payload alike); ids that are null
    come last, and are responses only where no row of the payload has an id.
    An empty table writes no archive.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(whole_text("html"), "utf-8").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    # narrow: one row per payload that several rows share, frozen so that the join below
    # sees two plain inputs and a payload that many rows share can be split
    shared = materialise(
        p.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1").select("digest", "first_id"), "payloads")
    rows = (p.join(shared.withColumn("is_shared", F.lit(True)), "digest", "left")
            .withColumn("is_first", F.col("is_shared").isNull() | F.col("page_id").eqNullSafe(F.col("first_id")))
            .select("page_id", "url", "payload", "first_id", "is_first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        out, name, n, size, done = None, "", 0, 0, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    # a retried or speculative attempt writes files of its own
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(root, recursive=True)
                    out, n, size = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = make_record(*row)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(MANIFEST.names, d)) for d in done],
            schema=pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return materialise(rows.mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, batch_rows: int = 2000) -> DataFrame:
    """The records of the archives that ``manifest`` names, an archive per task.

    Raises :class:`CorruptArchive` where framing or a digest fails.
    ``payload_bytes`` and ``payload_digest`` are those of the full payload,
    for revisits from their HTTP and record headers.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("archive").to_pylist():
                fs, path = file_system(uri)
                with fs.open_input_stream(path, compression=None) as stream:
                    rows = []
                    for r in records(stream):
                        rows.append(page_row(r))
                        if len(rows) == batch_rows:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # a partition per archive: the names are few bytes, which Spark would merge into one task
    return manifest.select("archive").repartition(max(1, manifest.count()), "archive").mapInArrow(read, RECORDS)


def archive_folder(pages: DataFrame) -> str:
    """A fresh folder for archives below the shared checkpoint folder."""
    return shared_path(pages.sparkSession, "warc")
