"""WARC archives: one gzip member per record, revisit records for repeated payloads, and a sequential reader.

A task packs records into archives of bounded size, each one row of bytes, which Spark's own text writer puts into a file
of its own; so the commit protocol covers retried and lost tasks, and any file system that Spark knows will do. The
writer takes strings as the bytes they hold. It ends a row with a separator, which here is a whole last record, a gzip
member like the others, of type metadata: it closes the archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import attached, grouped, salted, scratch

CRLF = b"\r\n"
RESPONSE_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _gzip(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


#: The record that closes each archive.
CLOSING = _gzip(b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:archive:end>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
ARCHIVE_BYTES = 32 << 20


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    return int(x) if (x := name.strip("<>").rpartition(":")[2]) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One gzip member. A revisit carries the HTTP head alone, whose Content-Length is that of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id))]
    head += [("WARC-Target-URI", "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "urn:unknown"))]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name(refers_to))]
    head += [("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + digest(payload)), ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Type", RESPONSE_TYPE), ("Content-Length", str(len(block)))]
    return _gzip(b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + CRLF + block + CRLF + CRLF)


def _members(chunks: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """Each gzip member of the archive, as an iterator of what it decompresses to."""
    source, rest = iter(chunks), b""

    def member() -> Iterator[bytes]:
        nonlocal rest
        z = zlib.decompressobj(31)
        while not z.eof:
            if not rest and not (rest := next(source, b"")):
                raise ValueError("the archive ends within a gzip member")
            out = z.decompress(rest, 1 << 20)
            rest = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                yield out

    while rest or (rest := next(source, b"")):
        yield (m := member())
        for _ in m:  # what a reader left
            pass


def read_archive(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], int, str, bool]]:
    """(WARC headers, payload length, payload digest, verified) of each record, in order, holding one record at most.

    The block is cut by Content-Length; a record that is short, or lacks its closing lines, raises. verified: the block
    digest holds, and for a response the payload digest too. Records that are neither response nor revisit are passed.
    """
    for m in _members(chunks):
        data = bytearray()
        for part in m:
            data += part
        if not data:
            continue
        head, sep, _ = data.partition(CRLF + CRLF)
        lines = head.decode().split("\r\n")
        if not sep or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at, n = len(head) + 4, int(headers["content-length"])
        if bytes(data[at + n :]) != CRLF + CRLF:
            raise ValueError(f"{headers.get('warc-record-id')}: the block is not {n} bytes long")
        if headers["warc-type"] not in ("response", "revisit"):
            continue
        block = bytes(data[at : at + n])
        good = headers["warc-block-digest"] == "sha1:" + digest(block)
        http, _, payload = block.partition(CRLF + CRLF)
        told = headers["warc-payload-digest"].removeprefix("sha1:")
        size = int(next(x for x in http.lower().split(CRLF) if x.startswith(b"content-length:")).split(b":")[1])
        if headers["warc-type"] == "response":
            good = good and len(payload) == size and digest(payload) == told
        yield headers, size, told, good


def _write(date: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for b in batches:
            for i in range(b.num_rows):
                p, u, h, r, v = (b.column(k)[i].as_py() for k in range(5))
                out.append(record(p, u, (h or "").encode(), r, v, date))
                size += len(out[-1])
                if size >= most:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["value"])

    return run


READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for b in batches:
        for content in b.column(0):
            view, rows = memoryview(content.as_buffer()), []
            for h, size, told, good in read_archive(bytes(view[i : i + 65536]) for i in range(0, len(view), 65536)):
                rows.append((_page(h["warc-record-id"]), h["warc-target-uri"], size, told, h["warc-type"], _page(h.get("warc-refers-to", "")), good))
                if len(rows) == 4096:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with refers_to and revisit: of rows with equal payloads of min_bytes at least, the
    smallest page_id is the response, which the others revisit. Rows that repeat that page_id are responses too; a null
    page_id counts as larger than any.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = salted(pages.select("page_id", "url", "html", F.sha1(html).alias("sha"), (F.length(html) >= min_bytes).alias("long_enough")), F.struct("page_id", "url"))
    groups = grouped(rows.select("sha", "salt", "page_id"), "sha", {"first": (F.min("page_id"), F.min)})
    revisit = F.col("long_enough") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return attached(rows, groups, "sha").select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes a record per row of pages into files at path; each file is a WARC archive in itself.

    An archive ends after the record that brings it to archive_bytes, so its size is that and one record at most. date:
    when the pages were fetched, which the pages do not say. A null html is an empty payload, a null url urn:unknown;
    payloads of any length are written whole; other columns are left out. No rows give no records.
    """
    records = with_revisits(pages, min_bytes).mapInArrow(_write(date, archive_bytes), "value binary").select(F.col("value").cast("string").alias("value"))
    out = records.write.option("encoding", "ISO-8859-1").option("lineSep", CLOSING.decode("latin-1")).option("maxRecordsPerFile", 1)
    out.text(path)


def read_warc(spark, path: str) -> DataFrame:
    """A row per response or revisit record of the archives at path, each archive read in order by one task.

    A task holds one compressed archive and one record. A record whose digests do not hold comes with verified = false,
    with the length and digest that it claims; a record cut short or without its frame raises.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read, READ_SCHEMA)


def query(spark, pages: DataFrame) -> DataFrame:
    path = scratch(spark)
    write_warc(pages, path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")
