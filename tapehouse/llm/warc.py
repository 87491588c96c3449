"""Operator 2: WARC archives of web pages and a salvage reader.

Writing: of pages with equal payloads of at least ``REVISIT_LEAST`` bytes the one with
the smallest page_id is a response record and the others are revisit records
that refer to it. Every task writes its records as gzip members of its own
files, through the file system that the folder's URI names; a file's name is
new for each attempt, and only the files in the manifest that Spark has
committed are read, so a lost or repeated task leaves no double records.

Reading: members (or plain records) are read one after another in bounded
memory. Where a check fails (compression, version line, header, length, block
digest, payload digest) the reader searches on for the next member or version line from
which a whole record can be read, also inside a member; the bytes between are one row of
the quarantine log, with the reason. Later records are recovered, and so are those that
stand before a fault in a member's compression.

Nulls and edges: a null html counts as empty; small payloads are all responses;
a null page_id is never referred to, and revisits if a page with an id has the
same payload; rows that tie at the smallest page_id are all responses; a null
url writes no target; an empty table gives empty results; other columns are not
used. Records of more than ``MOST_BYTES``, more than any Spark string holds, are
quarantined; a header may be of any length. A gap in an archive that the query
wrote itself fails the query.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import written
from tapehouse.session import scratch_path

REVISIT_LEAST = 100
#: A page is at most 2 GiB, and its HTTP header some bytes more.
FILE_BYTES, MOST_BYTES, CHUNK, HEADER_BYTES = 64 << 20, (1 << 31) + (1 << 12), 1 << 18, 1 << 16
#: Fixed values of the WARC format.
VERSION, CRLF, MAGIC = b"WARC/1.1", b"\r\n", b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SINGLE = ("warc-type", "warc-record-id", "content-length")
DATE = "1970-01-01T00:00:00Z"
HTTP_TYPE = "application/http;msgtype=response"
RECORD_ID = "<urn:tapehouse:page:{}>"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")


def http_block(payload: bytes | None, length: int) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    return head.encode() + (payload or b"")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record of a page: a response, or a revisit without its payload."""
    revisit = refers_to is not None
    block = http_block(None if revisit else payload, len(payload))
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", RECORD_ID.format("" if page_id is None else page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]+", "", url) if url else None),
        ("WARC-Refers-To", RECORD_ID.format(refers_to) if revisit else None),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    head = VERSION + CRLF + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None) + CRLF
    return head + block + CRLF + CRLF


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block after its HTTP header, where it has one."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


@dataclass
class Gap:
    """Bytes of an archive that could not be read; in a member that could be, its range
    there and that of the bytes in its content."""

    start: int
    end: int
    reason: str
    inner_start: int | None = None
    inner_end: int | None = None


class Bad(ValueError):
    """A check that failed."""


def parse_record(read, at: int, most: int = MOST_BYTES) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at ``at``; ``read(at, n)`` gives bytes."""
    head = read(at, HEADER_BYTES)
    if not re.match(rb"WARC/1\.\d\r\n", head):
        raise Bad("version line")
    stop = head.find(b"\r\n\r\n")
    while stop < 0:  # a long header: search on, as far as there are bytes
        known = len(head)
        head = read(at, 2 * known)
        if len(head) == known:
            raise Bad("header end")
        stop = head.find(b"\r\n\r\n", known - 3)
    headers = {}
    for line in head[:stop].split(CRLF)[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header line")
        field = name.strip().decode("latin-1").lower()
        if field in SINGLE and field in headers:  # two records run together
            raise Bad("header line twice")
        headers[field] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit():
        raise Bad("content length")
    size = int(headers["content-length"])
    if size > most:
        raise Bad("record too long")
    body = read(at + stop + 4, size + 4)
    if len(body) < size + 4 or body[size:] != b"\r\n\r\n":
        raise Bad("record end")
    block = body[:size]
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        raise Bad("block digest")
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind == "sha256" and headers.get("warc-type") == "response":
        if hashlib.sha256(Record(at, headers, block).payload).hexdigest() != digest:
            raise Bad("payload digest")
    return headers, block, at + stop + 4 + size + 4


def member(read, at: int, most: int = MOST_BYTES) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member that starts at ``at``; with a reason, the content before a fault."""
    machine, parts, total, place = zlib.decompressobj(31), [], 0, at
    while not machine.eof:
        raw = read(place, CHUNK)
        if not raw:
            return b"".join(parts), place, "member cut off"
        try:
            out = machine.decompress(raw)
        except zlib.error:
            return b"".join(parts) + before_fault(read, at, place), place, "compression"
        place += len(raw)
        total += len(out)
        if total > 2 * most + HEADER_BYTES:  # a header holds an url, which may be as long as a page
            raise Bad("record too long")
        parts.append(out)
    return b"".join(parts), place - len(machine.unused_data), None


def before_fault(read, at: int, place: int) -> bytes:
    """What the chunk at ``place`` of the member at ``at`` gives before its fault: byte by
    byte, as a chunk with a fault gives nothing."""
    machine, out = zlib.decompressobj(31), []
    for start in range(at, place, CHUNK):
        machine.decompress(read(start, CHUNK))
    try:
        for byte in read(place, CHUNK):
            out.append(machine.decompress(bytes([byte])))
    except zlib.error:
        pass
    return b"".join(out)


def inside(content: bytes, at: int, end: int, whole: bool, most: int) -> Iterator[Record | Gap]:
    """Records of a member's content, and gaps in it. Of a member with a fault (not
    ``whole``) a record that nothing follows is not trusted, as no digest covers its header."""
    inner, gap = 0, None
    while inner < len(content):
        try:
            headers, block, after = parse_record(lambda a, n: content[a : a + n], inner, most)
        except Bad as e:
            gap = gap or Gap(at, end, str(e), inner, inner)
            found = VERSION_LINE.search(content, inner + 1)
            inner = gap.inner_end = found.start() if found else len(content)
            continue
        if not whole and after == len(content):
            break
        if gap:
            yield gap
            gap = None
        yield Record(at, headers, block)
        inner = after
    if gap:
        yield gap


def salvage(read, size: int, most: int = MOST_BYTES) -> Iterator[Record | Gap]:
    """All records that can be read, and a gap for every stretch that cannot.

    ``read(at, n)`` gives up to ``n`` bytes of an archive of ``size`` bytes.
    """

    def search(at: int) -> int:
        while at < size:
            raw = read(at, CHUNK + 8)
            found = START.search(raw)
            if found:
                return at + found.start()
            at += max(1, len(raw) - 7)
        return size

    at, gap, before = 0, None, []  # before: records of a member with a fault, which may be stored as they are
    while at < size:
        start, fault = read(at, 8), None
        found: list[Record | Gap] = []
        try:
            if start.startswith(MAGIC):
                content, end, fault = member(read, at, most)
                found = list(inside(content, at, end, fault is None, most))
            else:
                headers, block, end = parse_record(read, at, most)
                found.append(Record(at, headers, block))
        except Bad as e:
            gap = gap or Gap(at, at, str(e))
            at = search(at + 1)
            gap.end = at
            continue
        if start.startswith(MAGIC):
            before = [(x.headers, x.block) for x in found if fault and isinstance(x, Record)]
        elif (headers, block) in before:
            gap = gap or Gap(at, at, "record read before")
            at = gap.end = end
            continue
        if fault and not any(isinstance(x, Record) for x in found):
            gap = gap or Gap(at, at, fault)
            at = gap.end = search(at + 1)
            continue
        if gap:
            yield gap
            gap = None
        yield from found
        if fault:  # its first records were read; its other bytes are a gap
            gap = Gap(at, at, fault)
            end = gap.end = search(at + 1)
        at = end
    if gap:
        yield gap


def file_reader(path: str):
    """``read(at, n)`` and size of a file of any file system that pyarrow knows by URI."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    source = system.open_input_file(name)
    buffered, size = [0, b""], source.size()

    def read(at: int, n: int) -> bytes:
        n = max(0, min(n, size - at))
        start, raw = buffered
        if not (start <= at and at + n <= start + len(raw)):
            buffered[:] = [at, source.read_at(max(n, CHUNK * 4), at)]
            start, raw = buffered
        return raw[at - start : at - start + n]

    return read, size


def typed(pages: DataFrame) -> DataFrame:
    """Pages with payload digest, length and the page that they revisit, if any."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    made = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html")).select(
        "*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("length")
    )
    first = made.where(F.col("length") >= REVISIT_LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # one row per repeated payload; a payload that stands alone needs no look-up
    first = first.where("n > 1 AND first IS NOT NULL").select("digest", "first")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return made.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(later & F.col("first").isNotNull(), F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, compress: bool = True) -> DataFrame:
    """Write all pages as WARC files below ``folder``; returns the manifest (path, n_records, n_bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        sink, name, records, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            sink.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
                names=["path", "n_records", "n_bytes"],
            )

        for batch in batches:
            html, at = ta.flat(batch.column(2))
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True)
            for i, (page_id, url, digest, refers_to) in enumerate(rows):
                if sink is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc" + ".gz" * compress, 0, 0
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                raw = record_bytes(page_id, url, html[at[i] : at[i + 1]].tobytes(), digest, refers_to)
                if compress:
                    machine = zlib.compressobj(5, zlib.DEFLATED, 31)
                    raw = machine.compress(raw) + machine.flush()
                sink.write(raw)
                records, size = records + 1, size + len(raw)
                if size >= FILE_BYTES:
                    yield done()
                    sink = None
        if sink is not None:
            yield done()

    return written(typed(pages).mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


def page_of(record_id: str | None) -> int | None:
    found = re.fullmatch(re.escape(RECORD_ID).replace(r"\{\}", r"(-?\d+)"), record_id or "")
    return int(found[1]) if found else None


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, path string, start long, end long, reason string"


def read_archives(files: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the files of column ``path``, and a row with a ``reason`` for every gap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * payloads
        types = [pa.int64() if x.endswith("long") else pa.string() for x in READ.split(", ")] + [pa.binary()] * payloads

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                read, size = file_reader(path)
                rows, held = [], 0
                for x in salvage(read, size):
                    if isinstance(x, Gap):
                        part = "" if x.inner_start is None else f", bytes {x.inner_start} to {x.inner_end} of the member's content"
                        row = (None, None, None, None, None, None, path, x.start, x.end, x.reason + part)
                        payload = None
                    else:
                        h, payload = x.headers, x.payload
                        revisit = h.get("warc-type") == "revisit"
                        digest = None if revisit else hashlib.sha256(payload).hexdigest()
                        row = (page_of(h.get("warc-record-id")), h.get("warc-target-uri"), h.get("warc-type"), page_of(h.get("warc-refers-to")))
                        row += (None if revisit else len(payload), digest or h.get("warc-payload-digest", "").partition(":")[2], path, x.offset, None, None)
                    rows.append(row + ((payload,) if payloads else ()))
                    held += 200 + (len(payload or b"") if payloads else 0)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    one_each = files.select("path").repartition(int(np.clip(files.count(), 1, 100_000)), "path")
    return one_each.mapInArrow(run, READ + ", payload binary" * payloads)


def resolved(records: DataFrame) -> DataFrame:
    """Records with the length of the payload that revisits refer to."""
    records = records.where("reason IS NULL AND record_type IN ('response', 'revisit')")
    lengths = records.where("record_type = 'response' AND page_id IS NOT NULL").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest"
    ).agg(F.max("payload_bytes").alias("full"))
    return records.join(lengths, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url"
    )


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives in the shared folder, then read back."""
    folder = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex[:12]}")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = written(read_archives(manifest), "warc-records")
    gap = records.where("reason IS NOT NULL").first()
    if gap:
        raise RuntimeError(f"{gap.path} cannot be read from byte {gap.start} to {gap.end}: {gap.reason}")
    wrote, found = manifest.agg(F.sum("n_records")).first()[0] or 0, records.count()
    if wrote != found:
        raise RuntimeError(f"{wrote} records were written to {folder}, {found} read")
    return resolved(records)
