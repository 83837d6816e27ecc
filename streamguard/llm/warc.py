"""WARC archives: writing records and reading them back sequentially (operator 7).

Every record is one gzip member.  Records that repeat an earlier payload
(equal SHA-1) become revisits of the one with the smallest page id; digests
are compared in a small table of (page, digest), and pages join only their
own row of it, so a payload shared by a third of all pages meets in an
aggregation with partial minima.

Archives are written by Spark's own text writer, so they land on any file
system it knows and only committed tasks leave files: a gzip member ends with
the high byte of its length, 0 below 16 MB, and that byte is the writer's
line separator.  A longer record gets an empty member behind it, whose last
byte is 0 too.  The reader takes an archive's bytes (``binaryFile``), feeds
them to zlib piece by piece, one member per record, frames the block by
Content-Length and verifies block and payload digests.

Defined results: a null html is an empty payload; a null url has an empty
target URI; rows with equal page_id and payload are all responses; rows with
a null page_id are responses and cannot be referred to; an empty table writes
no record.  Line breaks in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Payload bytes of one archive file, about; records are never split.
ARCHIVE_BYTES = 16 << 20
#: Bytes fed to zlib at once.
PIECE = 64 << 10
DATE = "2024-01-01T00:00:00Z"


def _base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, min_payload: int = 0) -> bytes:
    """One WARC record: response with the whole payload, or revisit with the HTTP headers only."""
    digest = _base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_base32_sha1(block)}", "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is 0 (an empty member follows where the length's high byte is not)."""
    def gz(x: bytes) -> bytes:
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(x) + c.flush()
    out = gz(data)
    return out if out[-1] == 0 else out + gz(b"")


def write_archives(pages: DataFrame, path: str, min_payload: int = 0) -> None:
    """Write every row of (page_id, url, html) as a record of a .gz archive under ``path``.

    Of rows with equal payloads of at least ``min_payload`` bytes, that with
    the smallest page_id is the response.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digests = pages.where(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_payload)).select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where(F.col("first") < F.col("last"))
    revisits = digests.join(first, "digest").where(F.col("page_id") > F.col("first")).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct()
    # pages are dealt by id into archives of bounded size; the small table follows the same key
    parts = max(1, -(-common.input_bytes(pages) // ARCHIVE_BYTES), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = pages.repartition(parts, "page_id")
    rows = dealt.join(revisits.repartition(parts, "_id"), (F.col("page_id") == F.col("_id")) & (F.sha1(F.encode("html", "UTF-8")) == F.col("_digest")), "left").select("page_id", "url", "html", "first")

    def write(batches):
        for b in batches:
            out = [member(record(p, u, h.encode(), r))[:-1] for p, u, h, r in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "first")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    rows.mapInArrow(common.tidy(write), "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def read_members(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an archive, decompressed member by member as the bytes come."""
    unzip, out, rest = zlib.decompressobj(31), [], b""
    for piece in pieces:
        rest += piece
        while rest:
            out.append(unzip.decompress(rest))
            rest = b""
            if unzip.eof:
                rest = unzip.unused_data
                data = b"".join(out)
                if data:
                    yield data
                unzip, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> dict:
    """Headers and block of one record, framed by Content-Length; digests must fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("the block does not fit its Content-Length")
    if fields["WARC-Block-Digest"] != "sha1:" + _base32_sha1(block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length")))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or _base32_sha1(payload) != digest):
        raise ValueError("payload differs from its digest")
    page = lambda x: int(m) if (m := x.removeprefix("<urn:page:").rstrip(">")) else None
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": length, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, "payload": payload if fields["WARC-Type"] == "response" else None}


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        for b in batches:
            for i in range(b.num_rows):
                body = memoryview(b.column("content")[i].as_buffer())
                rows, size = [], 0
                for data in read_members(bytes(body[k:k + PIECE]) for k in range(0, len(body), PIECE)):
                    rows.append(parse(data))
                    size += len(data) if payloads else 256
                    if size > common.BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)], names=names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(common.tidy(read), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payloads else ""))


def round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write all pages into the shared folder and report the records read back."""
    path = common.new_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_payload)
    return read_archives(pages.sparkSession, path)
