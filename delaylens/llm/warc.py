"""WARC archives: one gzip member per record, written by tasks and read back in sequence.

Archives lie in a shared folder that pyarrow's file systems can open (a mounted path,
HDFS or an object store). A task writes one archive under a name of its own for each
attempt; only archives named by finished tasks are read. The reader decompresses block
by block, frames records by their content length and verifies block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import staged
from delaylens.operators.joins import skew_join

BLOCK = 256 << 10
ARCHIVE_BYTES = 1 << 30
OUT_ROWS, OUT_BYTES = 5_000, 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = pa.schema(
    [
        ("record_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "record_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


class DamagedRecord(ValueError):
    """A record that is cut short, framed wrongly or does not match its digests."""


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a URI or local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _name(record_id: int | None) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def _id(name: str) -> int | None:
    digits = name[len("<urn:page:") : -1]
    return int(digits) if digits else None


def _sha(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def record_bytes(
    record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
    length: int | None = None,
) -> bytes:
    """One record before compression: a WARC header, an HTTP header and, unless it revisits, the payload.

    ``length`` is that of the whole payload, where a revisit comes without it.
    """
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload) if length is None else length}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(record_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: {_sha(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        # a header value ends with its line
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream: BinaryIO) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, read block by block."""
    held = b""
    while True:
        if not held:
            held = stream.read(BLOCK)
            if not held:
                return
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not held:
                held = stream.read(BLOCK)
                if not held:
                    raise DamagedRecord("the archive ends within a record")
            parts.append(inflate.decompress(held))
            held = inflate.unused_data
        yield b"".join(parts)


def _header(data: bytes, start: int) -> tuple[str, dict[str, str], int]:
    end = data.find(b"\r\n\r\n", start)
    if end < 0:
        raise DamagedRecord("a header does not end")
    first, *lines = data[start:end].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    return first, fields, end + 4


def parse(data: bytes) -> tuple:
    """A member as a row of ``RECORD``; raises ``DamagedRecord`` if anything does not fit."""
    version, fields, at = _header(data, 0)
    size = int(fields["Content-Length"])
    if version != "WARC/1.1" or data[at + size :] != b"\r\n\r\n":
        raise DamagedRecord("a record is framed wrongly")
    block = data[at : at + size]
    if _sha(block) != fields["WARC-Block-Digest"]:
        raise DamagedRecord("a block does not match its digest")
    _, http, start = _header(block, 0)
    kind, payload = fields["WARC-Type"], block[start:]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length, refers = int(http["Content-Length"]), None
    if kind == "revisit":
        refers, payload = _id(fields["WARC-Refers-To"]), None
    elif len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
        raise DamagedRecord("a payload does not match its digest")
    return _id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, refers, length, digest, payload


def _write(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = file_system(folder)
        path, out, n = "", None, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": f"{folder}/{path}", "records": n}])

        for batch in batches:
            payloads = batch.column("payload")
            names = ("record_id", "url", "length", "digest", "first_id")
            for i, (record_id, url, length, digest, first_id) in enumerate(zip(*[batch.column(c).to_pylist() for c in names])):
                if out is not None and out.tell() >= most:
                    yield done()
                    out = None
                if out is None:
                    path, n = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    system.create_dir(inner, recursive=True)
                    out = system.open_output_stream(f"{inner}/{path}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                payload = payloads[i].as_py()
                data = record_bytes(record_id, url, payload or b"", digest, first_id, payload is None, length)
                out.write(pack.compress(data) + pack.flush())
                n += 1
        if out is not None:
            yield done()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            system, inner = file_system(archive)
            with system.open_input_stream(inner, compression=None) as stream:
                rows, size = [], 0
                for member in members(stream):
                    rows.append(parse(member))
                    size += len(member)
                    if len(rows) >= OUT_ROWS or size >= OUT_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)


def with_first(records: DataFrame, least: int) -> DataFrame:
    """Add digest, first_id and revisit. Records with equal payloads of ``least`` bytes or more
    revisit the one with the smallest id.

    Null ids are never smallest; where all ids are null, and where rows repeat the
    smallest id, each of these is a response.
    """
    hashed = records.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    # only digests of more than one id can be revisited, so that few rows meet the payloads
    firsts = (
        hashed.filter(large)
        .groupBy("digest")
        .agg(F.min("record_id").alias("first_id"), F.count("*").alias("_n"))
        .filter((F.col("_n") > 1) & F.col("first_id").isNotNull())
        .select("digest", "first_id")
    )
    # a page that many records repeat is spread over tasks
    return skew_join(hashed, firsts, ["digest"], "left").withColumn(
        "revisit", F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    )


def write(records: DataFrame, folder: str, least: int = 100, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``records`` (record_id, url, payload) in ``folder``: archive and records, one row each.

    A null payload is empty, a null url leaves its header out; other columns are not read. A
    task begins a new archive once one has ``most`` bytes.
    """
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("payload", F.lit("").cast("binary")).alias("payload"),
    )
    known = with_first(rows, least)
    # what revisits another record leaves its payload behind
    payload = F.when(~F.col("revisit"), F.col("payload")).alias("payload")
    length = F.octet_length("payload").cast("long").alias("length")
    ready = known.select("record_id", "url", payload, length, "digest", "first_id")
    return staged(ready.mapInArrow(_write(folder, most), "archive string, records long"), "archives")


def read(archives: DataFrame) -> DataFrame:
    """Records of the archives named in ``archive``; an archive is read by one task, in sequence.

    There is a task for each archive. Records that repeat come back each; other columns are not read.
    """
    named = archives.select("archive")
    return named.repartitionByRange(max(named.count(), 1), "archive").mapInArrow(_read, RECORD_DDL)
