"""Web archives: pages written as gzipped WARC records, and a splittable reader.

Every record is a gzip member of its own, as archives usually are. The reader cuts the files
into byte ranges. A task scans its range for the magic number of gzip, takes a hit for a member
only if a WARC header can be decoded there, and owns the records that start inside its range;
the last one is read on past the end. So no index is needed and a file may be of any size.

Archives lie in the shared folder (or any folder that ``pyarrow.fs`` opens: local and shared
paths, hdfs, s3, gs, abfss). A writing task names its files freshly and returns the names; only
files named by tasks that ended well are in the manifest, so what a lost or repeated task leaves
behind is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, clean_text, importable, scratch_path, stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Payloads below this are stored again rather than referred to.
LEAST_SHARED = 100
#: Compressed bytes after which a task begins a new file.
ARCHIVE_BYTES = 1 << 30
#: Bytes of one range, and of the ranges that one task is dealt on average.
RANGE_BYTES, TASK_BYTES = 8 << 20, 64 << 20
#: Bytes read from a file, given to the decoder and taken from it at once, and of a header at most.
READ_BYTES, FEED_BYTES, DECODE_BYTES, HEADER_BYTES = 1 << 20, 1 << 14, 1 << 20, 1 << 16

_NAMES = uuid.UUID("6f7c1b58-5f0e-4d0c-9d0e-0a6d0f9a7c31")


class DamagedRecord(ValueError):
    """A member with a WARC header cannot be decoded to its end."""


# --- writing -----------------------------------------------------------------------------


def record_urn(page_id: int | None, digest: str) -> str:
    """The same id wherever and whenever a page is written."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def _line(value: str) -> str:
    """A header value on one line: control characters become %XX."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {_line(value)}\r\n" for name, value in headers).encode()
    return b"".join((VERSION, b"\r\n", head, b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"))


def member(data: bytes) -> bytes:
    """``data`` as one gzip member in which no other one can be seen.

    Incompressible data, such as a payload that is an archive itself, lies in its member as it
    is. So a block ends within every magic number of the data.
    """
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed, at = [], 0
    while (found := data.find(MAGIC, at)) >= 0:
        packed += [packer.compress(data[at:found + 1]), packer.flush(zlib.Z_SYNC_FLUSH)]
        at = found + 1
    return b"".join([*packed, packer.compress(data[at:]), packer.flush()])


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None) -> bytes:
    """A response, or a revisit of the response of page ``refers_to`` with the same payload."""
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", record_urn(page_id, digest)), ("WARC-Date", DATE),
               ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        block = http + payload
    else:
        headers += [("WARC-Refers-To", record_urn(refers_to, digest)), ("WARC-Profile", PROFILE)]
        block = http
    return record([*headers, ("Content-Type", "application/http; msgtype=response")], block)


def with_first_holders(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which page is stored and which refer to it.

    ``refers_to`` is the smallest id among equal payloads of 100 bytes or more, for pages of
    another id; rows that repeat this id are stored each. A NULL id is never the smallest one;
    a payload held by NULL ids only is stored each time.
    """
    importable(pages.sparkSession)
    html = F.col("html")
    given = (pages.select(F.col("page_id").cast("long").alias("page_id"),
                          F.col("url").cast("string").alias("url"), clean_text("html"))
             .withColumn("digest", F.sha2(html, 256)))
    large = F.octet_length(html) >= LEAST_SHARED
    # Partial sums, so a payload that many pages share is one row a task here; in the join its
    # pages are split by Spark. Small payloads get keys of their own that meet nothing.
    holders = (given.filter(large).groupBy("digest")
               .agg(F.min("page_id").alias("holder"), F.count(F.lit(1)).alias("pages"))
               .filter("pages > 1").select(F.col("digest").alias("key"), "holder"))
    keyed = given.withColumn("key", F.when(large, F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    others = ~F.col("page_id").eqNullSafe(F.col("holder"))
    return keyed.join(holders, "key", "left").select(
        "page_id", "url", "html", "digest", F.when(others, F.col("holder")).alias("refers_to"))


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


_FILES = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; the manifest (path, bytes, records).

    Needs page_id, url and html; a NULL html is an empty payload. One record at a time is in
    memory. An empty table gives an empty manifest.
    """
    def written(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(folder)
        files.create_dir(base, recursive=True)
        out, path, size, count = None, "", 0, 0
        rows = (row for batch in stream for row in zip(*batch.columns))
        try:
            for page_id, url, html, digest, refers_to in rows:
                if out is None:
                    name = uuid.uuid4().hex
                    path, size, count = f"{folder.rstrip('/')}/{name}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base.rstrip('/')}/{name}.warc.gz", compression=None)
                    size += out.write(member(record(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(name)}>"),
                         ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                        b"format: WARC File Format 1.1\r\n")))
                size += out.write(member(page_record(
                    page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), digest.as_py(),
                    refers_to.as_py())))
                count += 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield from batches([(path, size, count)], _FILES)
            if out is not None:
                out.close()
                out = None
                yield from batches([(path, size, count)], _FILES)
        finally:
            if out is not None:
                out.close()

    decided = with_first_holders(pages)
    return stored(decided.mapInArrow(written, "path string, bytes long, records long"), "warc-manifest")


# --- reading -----------------------------------------------------------------------------


def parsed_header(head: bytes) -> dict[str, str] | None:
    """Fields of the WARC header that ``head`` begins with; ``None`` without one that has a length."""
    end = head.find(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.") or end < 0:
        return None
    lines = head[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {name.strip().lower(): value.strip() for name, colon, value in
              (line.partition(":") for line in lines) if colon}
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


class _Window:
    """Bytes of a file from a position on, read forward as they are needed."""

    def __init__(self, file, start: int, size: int):
        self._file, self._size = file, size
        self.start, self._data = start, b""

    def at(self, position: int, least: int) -> memoryview:
        """Bytes from ``position``: ``least`` or more, fewer only at the end of the file."""
        while position + least > self.start + len(self._data) < self._size:
            behind = self.start + len(self._data)
            if position > self.start:
                self._data = self._data[position - self.start:]
                self.start = position
            self._file.seek(behind)
            self._data += self._file.read(min(max(READ_BYTES, least), self._size - behind))
        return memoryview(self._data)[position - self.start:]

    def find(self, position: int, end: int) -> int:
        """The first magic number that starts in [position, end), or -1."""
        while position < end:
            self.at(position, len(MAGIC))
            found = self._data.find(MAGIC, position - self.start)
            if found >= 0:
                found += self.start
                return found if found < end else -1
            behind = self.start + len(self._data)
            if behind >= self._size:
                return -1
            position = max(position, behind - len(MAGIC) + 1)
        return -1


@dataclass
class Record:
    """A record as it was decoded. ``payload`` is kept only if asked for."""

    offset: int
    length: int
    headers: dict[str, str]
    payload_bytes: int
    payload_sha256: str
    payload: bytes | None


def _decoded(window: _Window, offset: int, keep: bool) -> Record | None:
    """The record of the member at ``offset``; ``None`` if no WARC header can be decoded there."""
    opened, at = zlib.decompressobj(31), offset
    head, headers, wanted, http = b"", None, 0, False
    digest, size, kept = hashlib.sha256(), 0, []
    while not opened.eof:
        raw = opened.unconsumed_tail
        if not raw:
            raw = bytes(window.at(at, FEED_BYTES)[:FEED_BYTES])
            at += len(raw)
        try:
            if not raw:
                raise zlib.error("the file ends")
            data = opened.decompress(raw, DECODE_BYTES)
        except zlib.error as error:
            if headers is None:
                return None
            raise DamagedRecord(f"the member at byte {offset}: {error}") from error
        if headers is None:
            head += data
            headers = parsed_header(head)
            if headers is None:
                if len(head) > HEADER_BYTES or not VERSION.startswith(head[:7]):
                    return None
                continue
            data = head[head.find(b"\r\n\r\n") + 4:]
            wanted, head = int(headers["content-length"]), b""
            http = headers.get("content-type", "").startswith("application/http")
        data = data[:wanted]
        wanted -= len(data)
        if http:                    # the payload begins behind the HTTP header
            head += data
            end = head.find(b"\r\n\r\n")
            if end < 0:
                continue
            data, http, head = head[end + 4:], False, b""
        digest.update(data)
        size += len(data)
        if keep:
            kept.append(data)
    if headers is None:
        return None
    if wanted:
        raise DamagedRecord(f"the record at byte {offset} ends early")
    return Record(offset, at - len(opened.unused_data) - offset, headers, size, digest.hexdigest(),
                  b"".join(kept) if keep else None)


def records_in_range(file, start: int, end: int, size: int, keep: bool = False) -> Iterator[Record]:
    """Records whose first byte lies in [start, end) of a file of ``size`` bytes."""
    window, position = _Window(file, start, size), start
    while (position := window.find(position, end)) >= 0:
        found = _decoded(window, position, keep)
        if found is None:
            position += 1
            continue
        yield found
        position += found.length


_RECORDS = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("refers_to_record", pa.string()), ("header_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
_RECORD_DDL = ("path string, offset long, record_id string, record_type string, page_id long, "
               "url string, refers_to_record string, header_digest string, payload_bytes long, "
               "payload_digest string, payload binary")


def _row(path: str, one: Record) -> tuple:
    get = one.headers.get
    number = get("warc-page-id")
    return (path, one.offset, get("warc-record-id"), get("warc-type"),
            int(number) if number is not None else None, get("warc-target-uri"),
            get("warc-refers-to"), (get("warc-payload-digest") or ":").partition(":")[2] or None,
            one.payload_bytes, one.payload_sha256, one.payload)


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, end, size) covering every file of (path, bytes); none for empty files."""
    return (files.filter("bytes > 0")
            .select("path", F.col("bytes").alias("size"), F.explode(F.sequence(
                F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
            .select("path", "start", F.least(F.col("start") + range_bytes, "size").alias("end"), "size"))


def read_archives(files: DataFrame, payloads: bool = True, range_bytes: int = RANGE_BYTES,
                  task_bytes: int = TASK_BYTES) -> DataFrame:
    """All records of the archives in (path, bytes), each once, with digests of what was read.

    A record is read whole, in pieces; its payload is kept in memory only with ``payloads``
    (NULL otherwise). A member with a WARC header that cannot be decoded to its end raises
    ``DamagedRecord``. A payload of a foreign archive that holds a whole gzipped WARC member
    uncompressed could be taken for a record; ``write_archives`` writes none such.
    """
    importable(files.sparkSession)
    total, count = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)),
                             F.coalesce(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.lit(0))).first()
    tasks = max(1, min(count, 64), -(-total // task_bytes))
    ranges = byte_ranges(files, range_bytes).repartition(int(tasks))

    def scanned(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for path, start, end, size in zip(*(c.to_pylist() for c in batch.columns)):
                    system, name = _opened(path)
                    with system.open_input_file(name) as file:
                        for one in records_in_range(file, start, end, size, payloads):
                            yield _row(path, one)

        yield from batches(rows(), _RECORDS, 64 if payloads else 2048)

    return ranges.mapInArrow(scanned, _RECORD_DDL)


def resolved(records: DataFrame) -> DataFrame:
    """Page records with the payload facts of the response that a revisit refers to.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to). A revisit whose
    response is not among the records has NULL bytes and its header's digest.
    """
    own = records.filter(F.col("record_type").isin("response", "revisit"))
    # Repeated rows of a page have one record id; any of them serves.
    responses = (own.filter("record_type = 'response'").groupBy(F.col("record_id").alias("_of"))
                 .agg(F.first("page_id").alias("_page"), F.first("payload_bytes").alias("_bytes"),
                      F.first("payload_digest").alias("_digest")))
    # Responses refer to nothing and get keys of their own, so that they do not meet in one task.
    key = F.coalesce("refers_to_record", F.concat(F.lit("-"), "path", F.lit(":"), "offset"))
    revisit = F.col("record_type") == "revisit"
    return (own.withColumn("_key", key).join(responses, F.col("_key") == F.col("_of"), "left")
            .select("page_id", "url", "record_type",
                    F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                    F.when(revisit, F.coalesce("_digest", "header_digest"))
                    .otherwise(F.col("payload_digest")).alias("payload_digest"),
                    F.when(revisit, F.col("_page")).alias("refers_to")))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    found = stored(read_archives(write_archives(pages, folder), payloads=False), "warc-records")
    return resolved(found)
