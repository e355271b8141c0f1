"""WARC archives: writing with segmented records, reading with segment reassembly.

A record whose block is longer than ``segment_bytes`` is split into a first record and
continuation records. Reading groups continuation records by the identifier of
their origin, orders them by segment number, checks that none is missing and that the total length holds, and
then takes the HTTP message apart, decoding chunked transfer framing.

Archives are written by Spark's text writer (a record's last line break is the writer's
separator), so they go to any file system that Spark reaches, by committed tasks.
"""

from __future__ import annotations

import base64
import gzip
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION = b"WARC/1.1"
#: Payloads from this size on are written once; later equal ones refer to the first.
REVISIT_BYTES = 1000
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = b"2024-01-01T00:00:00Z"


def _uri(number: int, segment: int = 1) -> bytes:
    return f"<urn:uuid:{uuid.UUID(int=((number & (1 << 64) - 1) << 64) | segment)}>".encode()


def chunked(payload: bytes, size: int) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(parts)
        piece = body[end + 2 : end + 2 + size]
        if len(piece) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunked body ends early")
        parts.append(piece)
        at = end + 4 + size


def _record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = b"".join(b"%b: %b\r\n" % f for f in fields)
    return b"%b\r\n%bContent-Length: %d\r\n\r\n%b\r\n\r\n" % (VERSION, head, len(block), block)


def _line(text: str | None) -> bytes:
    return " ".join((text or "").split()).encode()


def _records(number, page, url, html, sha1, refers, refers_url, segment_bytes, chunk_bytes) -> Iterator[bytes]:
    own = [(b"WARC-Page-Id", str(page).encode())] if page is not None else []
    digest = b"sha1:" + base64.b32encode(bytes.fromhex(sha1))
    shared = [(b"WARC-Target-URI", _line(url)), (b"WARC-Date", _DATE), (b"WARC-Payload-Digest", digest), *own]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers is not None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(html)
        yield _record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", _uri(number)), *shared, (b"WARC-Profile", _PROFILE),
                       (b"WARC-Refers-To-Target-URI", _line(refers_url)), (b"WARC-Refers-To-Date", _DATE),
                       (b"WARC-Refers-To-Page-Id", str(refers).encode()),
                       (b"Content-Type", b"application/http; msgtype=response")], block)
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(html, chunk_bytes)
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    first = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", _uri(number)), *shared, (b"Content-Type", b"application/http; msgtype=response")]
    if len(pieces) == 1:
        yield _record(first, block)
        return
    yield _record([*first, (b"WARC-Segment-Number", b"1")], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        last = [(b"WARC-Segment-Total-Length", str(len(block)).encode())] if k == len(pieces) else []
        yield _record([(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", _uri(number, k)), *shared[:2],
                       (b"WARC-Segment-Origin-ID", _uri(number)), (b"WARC-Segment-Number", str(k).encode()), *last], piece)


def write_warc(
    pages: DataFrame, path: str, segment_bytes: int = 8192, chunk_bytes: int = 4096, compression: str = "gzip"
) -> None:
    """One record (with its continuations) per row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of at least 1000 bytes, the one with the largest page_id is a
    response and the others revisit it; a repeated row of that page_id is a response too.
    Null html is an empty payload; a null url is empty; a null page_id is written without
    one, as a response. Other columns are ignored, whatever their names.
    """
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    large = (F.octet_length("html") >= REVISIT_BYTES) & F.col("page_id").isNotNull()
    # digests held by several pages, and the page that holds the response
    held = p.filter(large).groupBy("sha1").agg(
        F.max(F.struct("page_id", "url")).alias("last"), F.min("page_id").alias("least")
    ).filter("last.page_id > least").select("sha1", F.col("last.page_id").alias("last"), F.col("last.url").alias("last_url"))
    # payloads that can be no copies meet nothing, each under a key of its own
    key = F.when(large, F.col("sha1")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("url"), F.lit(""))))
    p = p.withColumn("key", key).join(held.withColumnRenamed("sha1", "key"), "key", "left")
    again = large & (F.col("page_id") < F.col("last"))
    p = p.select(
        F.monotonically_increasing_id().alias("number"), "page_id", "url", "html", "sha1",
        F.when(again, F.col("last")).alias("refers"), F.when(again, F.col("last_url")).alias("refers_url"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns))
                # the writer ends every record with its separator, the last line break
                out = [r[:-2] for row in rows for r in _records(*row, segment_bytes, chunk_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    rows = p.mapInArrow(run, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.text(path, compression=compression, lineSep="\r\n")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields, name = {}, ""
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and name:  # a folded line
                fields[name] += " " + line.strip().decode("utf-8", "replace")
                continue
            key, _, value = line.partition(b":")
            name = key.strip().decode("utf-8", "replace").lower()
            fields[name] = value.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("an archive ends within a record")
        yield fields, block


def payload_of(block: bytes) -> tuple[bytes, int | None]:
    """The payload of an HTTP message without its transfer framing, and its stated length."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return block, None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower().endswith(b"chunked"):
        return dechunked(body), None
    return body, int(fields[b"content-length"]) if b"content-length" in fields else None


_FIELDS = {
    "type": "warc-type", "record_id": "warc-record-id", "uri": "warc-target-uri", "digest": "warc-payload-digest",
    "page_id": "warc-page-id", "refers_uri": "warc-refers-to-target-uri", "refers_page": "warc-refers-to-page-id",
    "origin": "warc-segment-origin-id",
}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path`` (plain or gzip): its fields as strings,
    segment, total and block. An archive is read whole, 2 GB at most as Spark stores it, and its records are
    handed on a few megabytes at a time; ``write_warc`` makes one archive a task."""
    schema = ", ".join(f"{c} string" for c in _FIELDS) + ", segment long, total long, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_FIELDS, "segment", "total", "block"]
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw)) if raw.size < 2 or raw[:2].to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
                rows, size = [], 0
                for fields, block in parse(stream):
                    number = lambda f: int(fields[f]) if f in fields else None
                    rows.append([*(fields.get(f) for f in _FIELDS.values()), number("warc-segment-number"),
                                 number("warc-segment-total-length"), block])
                    size += len(block)
                    if size > 8 << 20:
                        yield _rows(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def _rows(rows: list, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * (len(names) - 3) + [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def reassembled(records: DataFrame) -> DataFrame:
    """``records`` with each segmented block put together from its continuations.

    Only segmented records are shuffled, by the origin's identifier. A record with a missing or
    repeated segment, or of another total length than stated, fails the job: an archive is
    read whole or not at all. A record is one row, with 2 GB at most.
    """
    whole = records.filter("segment is null").drop("origin", "segment", "total")
    parts = records.filter("segment is not null")
    head = [c for c in whole.columns if c != "block"]
    first = F.struct(*head)
    g = parts.groupBy(F.coalesce("origin", "record_id").alias("key")).agg(
        F.max(F.when(F.col("segment") == 1, first)).alias("h"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("s"), F.max("total").alias("total"),
    )
    # bytes put together in one pass; as strings, which Spark takes as they are
    block = F.array_join(F.transform("s", lambda x: x["block"].cast("string")), "").cast("binary")
    numbers = F.transform("s", lambda x: x["segment"])
    g = g.withColumn("block", block).withColumn("ok", (numbers == F.sequence(F.lit(1), F.size("s").cast("long")))
                                                & (F.octet_length("block") == F.col("total")) & F.col("h").isNotNull())
    checked: Column = F.when(F.coalesce("ok", F.lit(False)), F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("incomplete segments of "), F.col("key"))).cast("binary"))
    return whole.unionByName(g.select("h.*", checked.alias("block")))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits under ``path``: page_id, uri, record_type, payload (null for
    revisits), payload_bytes, payload_digest (hex), refers_to (a page_id).

    Payloads are compared with their digest; a difference fails the job. Other record types are
    skipped. An archive without records gives an empty result.
    """
    schema = "page_id long, uri string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = []
                for page, uri, kind, digest, refers, block in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns)):
                    payload, stated = payload_of(block)
                    hexed = base64.b32decode(digest.partition(":")[2]).hex() if digest else None
                    if kind == "revisit":
                        rows.append((page, uri, kind, None, stated, hexed, refers))
                        continue
                    own = hashlib.sha1(payload).hexdigest()
                    if hexed not in (None, own):
                        raise ValueError(f"payload of {uri} differs from its digest")
                    rows.append((page, uri, kind, payload, len(payload), own, None))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["page_id", "uri", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"],
                )

    rows = reassembled(read_records(spark, path)).filter(F.col("type").isin("response", "revisit"))
    return rows.select(
        F.col("page_id").cast("long"), "uri", "type", "digest", F.col("refers_page").cast("long"), "block"
    ).mapInArrow(run, schema)
