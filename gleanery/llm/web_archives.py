"""Web archives: one gzip member per record, written by Spark's text sink, read back by a sequential reader.

Defined results: a null page body is an empty payload; equal payloads of at least `REVISIT_BYTES` bytes are stored once, under
the smallest page_id, all other rows with that payload refer to it; rows repeated under the smallest page_id are all responses;
a page without page_id never is the one referred to unless no equal page has one (then each is a response).
An empty table gives an archive folder without records. Line breaks in addresses are escaped.
A record that breaks off, or whose digest differs from its content, is returned with `verified` false.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.lookup import lookup_join

REVISIT_BYTES = 100
CHUNK_BYTES = 4 << 20
CHUNKS_PER_ARCHIVE = 8
READ_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member. Spark's text sink needs something between rows, and a reader of members skips this.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, size, digest, refers_to: which rows are stored whole and which refer to another."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest")
    )
    alike = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = alike.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return lookup_join(rows, repeated, ["digest"], "left").select(
        "page_id", "url", "payload", "size", "digest", F.when(other, F.col("first")).alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head only; the head's Content-Length is the payload's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, folder: str) -> None:
    """Writes the pages as archives of at most about CHUNKS_PER_ARCHIVE * CHUNK_BYTES compressed bytes each."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (column[row].as_py() for column in columns)
                held.append(record(page_id, url, payload.encode(), digest, refers_to))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], names=["value"])

    chunks = planned(pages).mapInArrow(members, "value binary")
    raw = chunks.select(F.col("value").cast("string").alias("value"))  # bytes unchanged: the sink writes them as they are
    sink = raw.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
    sink.option("maxRecordsPerFile", CHUNKS_PER_ARCHIVE).text(folder)


def members_of(archive: memoryview) -> Iterator[tuple[bytes, bool]]:
    """The content of each gzip member in order and whether it ended properly, unpacked piece by piece."""
    at = 0
    while at < len(archive):
        unpack, parts = zlib.decompressobj(31), []
        try:
            while at < len(archive) and not unpack.eof:
                piece = archive[at : at + READ_BYTES]
                parts.append(unpack.decompress(piece))
                at += len(piece) - len(unpack.unused_data)
        except zlib.error:
            yield b"".join(parts), False
            return  # without its end the next member's start is unknown
        yield b"".join(parts), unpack.eof


def fields_of(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_record(content: bytes, whole: bool) -> dict:
    """One record: framed by its content length, its digests compared with its bytes."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = fields_of(head)
    length = int(fields.get("content-length", "0"))
    block = rest[:length]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda urn: None if urn in (None, "<urn:page:None>") else int(urn[len("<urn:page:") : -1])
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    good = whole and rest[length:] == b"\r\n\r\n" and fields.get("warc-block-digest") == "sha256:" + hashlib.sha256(block).hexdigest()
    kind = fields.get("warc-type")
    if kind == "response":
        good = good and hashlib.sha256(payload).hexdigest() == digest
    return {
        "page_id": number(fields.get("warc-record-id")),
        "payload_bytes": len(payload) if kind == "response" else int(fields_of(http).get("content-length", "0")),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields.get("warc-refers-to")),
        "verified": bool(good),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """All records of a folder of archives; with `payloads` also url and payload (binary, null for a revisit)."""
    schema = RECORD + (", url string, payload binary" if payloads else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    names = [part.split()[0] for part in schema.split(", ")]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "verified": pa.bool_(), "payload": pa.binary()}
    layout = pa.schema([(name, types.get(name, pa.string())) for name in names])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for member, whole in members_of(memoryview(content.as_buffer())):
                    if member or not whole:
                        found = read_record(member, whole)
                        held.append({name: found[name] for name in names})
                        size += len(member)
                    if size >= CHUNK_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=layout)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=layout)

    return files.mapInArrow(records, schema)
