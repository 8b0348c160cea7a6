"""WARC archives: written record by record, read by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.formats import scratch
from .common import slices, stored

#: Payloads from this size on are written once.
LEAST_BYTES = 1000
#: Rows of the table of repeated payloads that may be broadcast, each of about 100 bytes.
BROADCAST_ROWS = 100_000
SALTS = 32
SPLIT_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
READ = 1 << 20
#: The date of records whose time is unknown.
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def clean(value: str) -> str:
    """A header's value: control characters and % are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def unclean(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A WARC record as a gzip member of its own. A revisit has no payload but its digest and length."""
    block = HTTP % len(payload) + (b"" if revisit else payload)
    # The id follows from the contents, so that a task that runs again writes the same.
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}\n{digest}")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{base32(digest)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(whole) + pack.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a decoded record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Writes a record for each row, and returns the archives: (path, bytes, records).

    Of rows with equal payloads of ``LEAST_BYTES`` or more, the one with the
    largest id is a response and the others revisit it (repeated rows with that
    id are all responses; if none has an id, all are). Payloads meet by length
    and SHA-1. A null payload is empty; null ids and urls have no header.

    Each task writes a file whose name holds its attempt, and only what the
    attempts that succeeded return is listed, so a task that is lost or runs
    twice leaves nothing that is read. An empty table gives no archives.
    """
    spark = pages.sparkSession
    folder = folder or scratch(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.length("html") >= LEAST_BYTES, F.sha1("html")))
    large = rows.where("digest is not null").groupBy("digest", F.length("html").alias("size")).agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stored(large.where("n > 1 and first is not null").select("digest", "size", "first"))
    if repeated.count() <= broadcast_rows:
        rows = rows.join(F.broadcast(repeated), (rows.digest == repeated.digest) & (F.length("html") == repeated["size"]), "left")
    else:  # a payload that many pages have goes to several tasks
        salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("s", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        rows = rows.join(salted, (rows.digest == salted.digest) & (F.length("html") == salted["size"]) & (rows.s == salted.salt), "left")
    rows = rows.select("page_id", "url", "html", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        file, n, size = None, 0, 0
        for batch in slices(batches):
            for r in batch.to_pylist():
                if file is None:
                    system, at = opened(path)
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    file = system.open_output_stream(at, compression=None)
                revisit = r["first"] is not None and r["page_id"] != r["first"]
                raw = record(r["page_id"], r["url"], r["html"], hashlib.sha1(r["html"]).hexdigest(), r["first"] if revisit else None, revisit)
                file.write(raw)
                n, size = n + 1, size + len(raw)
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([n])], ["path", "bytes", "records"])

    return stored(rows.mapInArrow(run, "path string, bytes long, records long"))


def member(file: BinaryIO, at: int, data: bytes, head_only: bool) -> tuple[bytes | None, int, bytes]:
    """Decodes the gzip member at byte ``at`` whose first bytes are ``data`` (more is read as needed).

    Returns its contents, where it ends, and the bytes read beyond; None for
    contents if no member with a WARC header begins here. With ``head_only``,
    the contents are the header's first bytes alone.
    """
    unpack, parts, size, read = zlib.decompressobj(31), [], 0, at + len(data)
    try:
        while True:
            new = unpack.decompress(data, 64 if head_only else 0)
            parts.append(new)
            size += len(new)
            if size >= 7 and not b"".join(parts[:8])[:7].startswith(b"WARC/1."):
                return None, at, b""
            if head_only and size >= 7:
                return b"".join(parts), at, b""
            if unpack.eof:
                return (b"".join(parts), read - len(unpack.unused_data), unpack.unused_data) if size >= 7 else (None, at, b"")
            data = unpack.unconsumed_tail or file.read_at(READ, read)
            if not unpack.unconsumed_tail:
                read += len(data)
            if not data:
                return None, at, b""
    except zlib.error:
        return None, at, b""


def records_in(path: str, low: int, high: int) -> Iterator[tuple[int, bytes]]:
    """(offset, contents) of the records that start in bytes [low, high) of an archive.

    From ``low`` on, each gzip magic is a candidate, and is a record if its
    header decodes to a WARC version. Whoever starts in the range is read to
    its end, also beyond the range.
    """
    system, at_path = opened(path)
    with system.open_input_file(at_path) as file:
        at, data = low, b""
        while at < high:
            if len(data) < len(MAGIC):
                data += file.read_at(READ, at + len(data))
            found = data.find(MAGIC)
            if found < 0:
                keep = min(len(data), len(MAGIC) - 1)
                step = len(data) - keep
                if step == 0:
                    return
                at, data = at + step, data[step:]
                continue
            at, data = at + found, data[found:]
            if at >= high:
                return
            if member(file, at, data, True)[0] is None:
                at, data = at + 1, data[1:]
                continue
            raw, end, rest = member(file, at, data, False)
            if raw is None:
                at, data = at + 1, data[1:]
                continue
            yield at, raw
            at, data = end, rest


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives (path, bytes), read by tasks that each take a byte range.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to,
    payload, path, offset); the digest is computed from the payload, for
    revisits, which have none (null), it is the header's, and so is the length.
    """
    size = F.lit(split_bytes)
    splits = archives.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, size)).alias("low"))
    splits = splits.select("path", "low", F.least(F.col("low") + size, "bytes").alias("high"))
    splits = splits.repartition(max(1, min(splits.count(), 10_000)), "path", "low")
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, path string, offset long"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(text: str | None) -> int | None:
            return None if text is None else int(text)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for r in batch.to_pylist():
                rows, size = [], 0
                for offset, raw in records_in(r["path"], r["low"], r["high"]):
                    head, payload = parsed(raw)
                    url = head.get("WARC-Target-URI")
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    length, kind = int(head["X-Payload-Length"]), head["WARC-Type"]
                    if kind == "response":
                        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
                    rows.append((number(head.get("X-Page-ID")), None if url is None else unclean(url), kind, length, digest, number(head.get("X-Refers-To-Page-ID")), payload if kind == "response" else None, r["path"], offset))
                    size += len(payload)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return splits.mapInArrow(run, schema)
