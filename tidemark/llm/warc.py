"""WARC records in seekable Zstandard bundles.

A bundle is a sequence of independent frames, each holding whole WARC/1.1 records up to a
target size, then a skippable frame with the seek table: compressed and decompressed size
of each frame and a footer with their number.  Any Zstandard decoder reads a bundle from
front to end.  An index row maps each record to its bundle, frame and offset within
the frame, so one record is read by decompressing one frame.

Records of equal payload: that with the smallest page id is the ``response``; the others are
``revisit`` records that refer to it and hold the HTTP header only, whose Content-Length
tells the full payload's length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import materialise, shared_file

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, frame_offset long, length long"
PAGE_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int"


class BundleWriter:
    """Writes records to one bundle; ``add`` returns (frame, offset in the frame)."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.held = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.held and self.held + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.held
        self.parts.append(record)
        self.held += len(record)
        return place

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.parts))
            self.sink.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.sink.close()


def seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the end of a bundle."""
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    source.seek(size - 9 - count * entry)
    table, frames, at = source.read(count * entry), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        frames.append((at, packed, plain))
        at += packed
    return frames


def read_frame(source, frame: tuple[int, int, int]) -> bytes:
    source.seek(frame[0])
    return zstandard.ZstdDecompressor().decompress(source.read(frame[1]), max_output_size=frame[2])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header(value: str | None) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def build_record(page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: str, first: int | None) -> bytes:
    """One WARC record; ``payload`` None gives a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if payload is None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first)}",
            f"X-Refers-To-Page: {first}",
        ]
    block = http + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_records(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes]]:
    """(offset, WARC headers, HTTP headers, payload) of each record of a frame from ``at`` on."""
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = _fields(data[at:stop])
        block = data[stop + 4 : stop + 4 + int(head["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        yield at, head, _fields(http), payload
        at = stop + 8 + len(block)


def _fields(lines: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines.decode().split("\r\n")[1:])}


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``first_id``: the smallest page id of an equal payload, if not its own.

    The smallest id per digest is an aggregate with partial sums on the map side.  Only digests
    that occur for several ids are written and joined, as a plain table, so AQE can split the rows
    of a hot payload.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("html"), F.sha1(body.cast("binary")).alias("sha"))
    groups = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha")
    firsts = groups.agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("sha", "first_id")
    firsts = materialise(firsts, "warc-firsts")
    return rows.join(firsts, "sha", "left").withColumn(
        "first_id", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    )


def write_bundles(pages: DataFrame, folder: str, least_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes all ``pages`` as bundles under ``folder``; returns the index (one row per record).

    Each task writes bundles of its own, named by partition and attempt.  The index is written
    as a table, so only bundles of committed attempts are named in it; a lost task writes anew and
    leaves at most a file that nothing refers to.  Null html is an empty payload; a null page
    id never becomes the response of others; rows that repeat the smallest id are responses.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, name, made, rows = None, "", 0, []
        files, root = shared_file(folder)
        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first_id"))):
                if writer is None:
                    name = f"bundle-{task.partitionId():05d}-{task.taskAttemptId()}-{made}.warc.zst"
                    files.create_dir(root, recursive=True)
                    writer = BundleWriter(files.open_output_stream(f"{root}/{name}", compression=None), frame_bytes)
                    made += 1
                payload = html.encode()
                record = build_record(page_id, url, payload if first is None else None, len(payload), digest_of(payload), first)
                frame, offset = writer.add(record)
                rows.append((record_id(page_id), page_id, name, frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            if writer is None and rows:
                yield _index(rows)
                rows = []
        if writer is not None:
            writer.close()
        if rows:
            yield _index(rows)

    planned = plan_records(pages, least_bytes).select("page_id", "url", "html", "first_id")
    return materialise(planned.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    names = ["record_id", "page_id", "bundle", "frame", "frame_offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """One row per record of the bundles the index names, parsed and hashed from the archives."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_file(folder)
        for batch in batches:
            for name, wanted in zip(batch.column("bundle").to_pylist(), batch.column("frames").to_pylist()):
                path = f"{root}/{name}"
                with files.open_input_file(path) as source:
                    table = seek_table(source, files.get_file_info(path).size)
                    for frame in wanted:
                        yield _parsed(read_frame(source, table[frame]), name, frame)

    places = index.select("bundle", "frame", (F.col("frame") / 64).cast("int").alias("run")).distinct()
    runs = materialise(places.groupBy("bundle", "run").agg(F.sort_array(F.collect_list("frame")).alias("frames")), "warc-runs")
    return runs.repartition(max(1, runs.count()), "bundle", "run").mapInArrow(parse, PAGE_SCHEMA)


def _parsed(data: bytes, name: str, frame: int) -> pa.RecordBatch:
    rows = []
    for _, head, http, payload in parse_records(data):
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        length = int(http["content-length"])
        if head["warc-type"] == "response":
            if digest_of(payload) != digest or len(payload) != length:
                raise ValueError(f"damaged record {head['warc-record-id']} in {name}")
        number, first = head["x-page-id"], head.get("x-refers-to-page")
        rows.append((int(number) if number else None, length, digest, head["warc-type"], int(first) if first else None, name, frame))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def fetch_record(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """(WARC headers, payload) of one record, decompressing one frame."""
    files, root = shared_file(folder)
    path = f"{root}/{bundle}"
    with files.open_input_file(path) as source:
        data = read_frame(source, seek_table(source, files.get_file_info(path).size)[frame])
    _, head, _, payload = next(parse_records(data, offset))
    return head, payload


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` under the shared folder and reads the archives back."""
    folder = scratch_path(pages.sparkSession, "llm", "warc")
    return read_bundles(write_bundles(pages, folder, least_bytes), folder)
