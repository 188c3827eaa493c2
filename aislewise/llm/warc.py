"""Operator 7: WARC archives, written from pages and read back record by record.

Every record is its own gzip member. Of pages with equal payloads, the one with the largest id is a ``response``; the
others are ``revisit`` records that carry the HTTP header, the payload's digest, and the id of the response.

Writing: payloads are grouped by digest and length, which sums up map-side; the few columns of that result are joined to
the pages, where adaptive execution can split a payload that a third of all pages share. A task writes archives of
about ``ARCHIVE_BYTES``, a record at a time, under a name of its own attempt. Only the names that successful tasks return
are read, so a lost executor or a second attempt leaves no wrong data, just a file that nothing names.

Reading: a task streams an archive in blocks through one zlib object per member, frames the record by its
Content-Length, and checks block and payload digests. It holds one record, never an archive. Files are opened through
Arrow's file systems, so the folder may be any URI they know (a mounted path, HDFS, S3).

Defined results: a null html is an empty payload; a null url gives no target URI. Repeated rows of the response's id are
responses too. Null ids rank below all others; a payload that only null ids have is all responses. Payloads shorter than
``shortest`` bytes are never revisits. Control characters in a url are percent-encoded in the header. Broken records
raise, with the archive and the offset.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm.common import raw_bytes
from aislewise.session import cut_lineage, shared_dir

ARCHIVE_BYTES = 256_000_000
BLOCK = 1 << 20
ID = "urn:page:"
# A fixed date: the pages have none, and equal input shall give equal archives.
DATE = "2024-01-01T00:00:00Z"
COLUMNS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers hold it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_text(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A whole record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", header_text(url)))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<{ID}{refers_to}>"))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(stream, block: int = BLOCK) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Offset and decompressed pieces of each gzip member; a member has to be read before the next one."""
    rest, offset, ended = b"", 0, False

    def fill() -> bool:
        nonlocal rest, ended
        if not rest and not ended:
            rest = stream.read(block)
            ended = not rest
        return bool(rest)

    def pieces(start: int) -> Iterator[bytes]:
        nonlocal rest, offset
        z = zlib.decompressobj(31)
        while not z.eof:
            if not fill():
                raise ValueError(f"member at {start} is cut off")
            # Output is bounded too: a member may unpack to far more than it takes.
            given = len(rest)
            out = z.decompress(rest, block)
            rest = z.unused_data if z.eof else z.unconsumed_tail
            offset += given - len(rest)
            if out:
                yield out

    while fill():
        yield offset, pieces(offset)


def parse(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Named fields and block of one record, framed by its Content-Length."""
    data = b""
    for piece in pieces:
        data += piece
        if b"\r\n\r\n" in data:
            break
    head, found, body = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(fields["content-length"])
    held, size = [body], len(body)
    for piece in pieces:
        held.append(piece)
        size += len(piece)
    body = b"".join(held)
    if size != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError(f"record of {size} bytes, {length + 4} announced")
    return fields, body[:length]


def check(fields: dict[str, str], block: bytes) -> tuple[int, bytes | None]:
    """Length of the full payload, and the payload where the record holds it; digests are verified."""
    if fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if fields["warc-type"] == "revisit":
        return length, None
    if len(payload) != length or fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise ValueError("payload digest differs")
    return length, payload


def page_id_of(value: str) -> int | None:
    number = value.strip("<>").removeprefix(ID)
    return int(number) if number else None


def write(pages: DataFrame, folder: str, shortest: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``folder``; returns path, records and bytes of each archive."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select(
        "page_id", "url", "html", F.sha1(payload).alias("sha1"), F.length(payload).cast("long").alias("size")
    )
    shared = keyed.where(F.col("size") >= shortest).groupBy("sha1", "size")
    shared = shared.agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).where("copies > 1")
    rows = keyed.join(shared.drop("copies"), ["sha1", "size"], "left").select(
        "page_id", "url", "html", F.expr("CASE WHEN NOT (page_id <=> response) THEN response END").alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, number, records, size = None, "", 0, 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in batches:
            ids, urls, refers = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for i, payload in enumerate(raw_bytes(batch.column(2))):
                if out is None:
                    path = f"{root}/part-{task.partitionId():05d}-{number:04d}-{task.taskAttemptId()}.warc.gz"
                    # The file itself is gzip; Arrow must not compress it once more by its ending.
                    out, records, size = store.open_output_stream(path, compression=None), 0, 0
                    number += 1
                data = member(record(ids[i], urls[i], payload, refers[i]))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return cut_lineage(rows.mapInArrow(run, "path string, records long, bytes long"))


def read(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives named by column ``path``, verified; with ``payloads`` also column ``payload``."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payloads

    def rows(path: str) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(folder)
        with store.open_input_stream(path, compression=None) as stream:
            for offset, pieces in members(stream):
                try:
                    fields, block = parse(pieces)
                    length, payload = check(fields, block)
                except (ValueError, KeyError, zlib.error) as broken:
                    raise ValueError(f"{path} at {offset}: {broken}") from broken
                refers = fields.get("warc-refers-to")
                row = (
                    page_id_of(fields["warc-record-id"]),
                    fields.get("warc-target-uri"),
                    fields["warc-type"],
                    page_id_of(refers) if refers else None,
                    length,
                    fields["warc-payload-digest"].removeprefix("sha1:"),
                )
                yield (*row, payload) if payloads else row

    def columns(held: list[tuple]) -> list[pa.Array]:
        return [pa.array(list(c), k) for c, k in zip(zip(*held), kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(path):
                    held.append(row)
                    size += len(row[-1] or b"") if payloads else 1_000
                    if size >= 8_000_000:
                        yield pa.RecordBatch.from_arrays(columns(held), names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays(columns(held), names)

    # Archives are the units of work; they are dealt out anew, whichever tasks wrote them.
    parts = 8 * archives.sparkSession.sparkContext.defaultParallelism
    dealt = archives.select("path").repartition(parts, "path")
    return dealt.mapInArrow(run, COLUMNS + ", payload binary" * payloads)


def archive_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach, as a URI."""
    base = shared_dir(spark)
    if "://" not in base:
        base = f"file://{base.removeprefix('file:')}"
    return f"{base}/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame) -> DataFrame:
    """What the archives of ``pages`` say of each page."""
    folder = archive_folder(pages.sparkSession)
    return read(write(pages, folder), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
