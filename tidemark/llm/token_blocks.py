"""Token ids in patched frame-of-reference blocks.

A file holds the ids of consecutive documents as one sequence, cut into blocks of
``BLOCK_IDS``.  A block stores its minimum, packs what is above the minimum at the width
that holds the ``PERCENTILE`` of its values, and lists the outliers' places and high bits as
exceptions.  The footer indexes the block starts and lists each document's id and length,
so any document is read from its blocks alone.

    magic | blocks | block starts u64 | doc ids i64 | null ids u8 | lengths u32 | trailer

Tokenising: documents are range-partitioned by id, so files are in ascending order, and
each task encodes and writes its range in one go.  White space ends every token of this tokenizer
family, so a text's ids are those of its white-space-free chunks in order.  Distinct pieces of a
slice are encoded once by the library and remembered, within a bound, by the worker.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import materialise, shared_file, text_slices, word_hashes, words_of

MAGIC = b"PFB1"
BLOCK_IDS = 4096
PERCENTILE = 0.9
#: Ids after which a task begins another file.
FILE_IDS = 1 << 24
REMEMBERED = 3_000_000
#: Larger slices repeat more pieces, so fewer are looked up.
SLICE_BYTES = 1 << 20
END_ID = 1

HEADER, TRAILER = struct.Struct("<IHBH"), struct.Struct("<QQQQ4s")
FILES_SCHEMA = "part int, seq int, file string, ids long, docs long, blocks long"
DOCS_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at most BLOCK_IDS ids (unsigned 32 bits)."""
    base = int(ids.min())
    above = (ids - np.uint32(base)).astype(np.uint32)
    at = max(0, int(np.ceil(PERCENTILE * len(ids))) - 1)
    width = int(np.partition(above, at)[at]).bit_length()
    odd = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(above.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    packed = np.packbits(bits).tobytes()
    return (
        HEADER.pack(base, len(ids), width, len(odd)) + packed + odd.astype("<u2").tobytes() + (above[odd] >> np.uint32(width)).astype("<u4").tobytes()
    )


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    base, count, width, odd = HEADER.unpack_from(data, at)
    at += HEADER.size
    size = (count * width + 7) // 8
    bits = np.zeros((count, 32), np.uint8)
    bits[:, 32 - width :] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * width).reshape(count, width)
    above = np.packbits(bits).view(">u4").astype(np.uint32)
    at += size
    places = np.frombuffer(data, "<u2", odd, at)
    above[places] |= np.frombuffer(data, "<u4", odd, at + 2 * odd) << np.uint32(width)
    return above + np.uint32(base)


class BlockWriter:
    def __init__(self, sink):
        self.sink, self.at, self.ids = sink, len(MAGIC), 0
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.rest = np.empty(0, np.uint32)
        sink.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents with their ids in one array."""
        self.doc_ids += doc_ids
        self.lengths.append(lengths.astype("<u4"))
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, full, BLOCK_IDS):
            self._block(ids[i : i + BLOCK_IDS])
        self.rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack_block(ids)
        self.starts.append(self.at)
        self.at += len(data)
        self.sink.write(data)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        null = np.array([x is None for x in self.doc_ids], np.uint8)
        known = np.array([x or 0 for x in self.doc_ids], "<i8")
        lengths = np.concatenate(self.lengths) if self.lengths else np.empty(0, "<u4")
        self.sink.write(np.array(self.starts, "<u8").tobytes() + known.tobytes() + null.tobytes() + lengths.tobytes())
        self.sink.write(TRAILER.pack(self.at, len(self.starts), len(null), self.ids, MAGIC))
        self.sink.close()


class BlockReader:
    """Random access to a file by its footer."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - TRAILER.size)
        self.end, blocks, docs, self.ids, magic = TRAILER.unpack(source.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a block file")
        source.seek(self.end)
        foot = source.read(size - TRAILER.size - self.end)
        self.starts = np.append(np.frombuffer(foot, "<u8", blocks), self.end).astype(np.int64)
        known = np.frombuffer(foot, "<i8", docs, 8 * blocks)
        null = np.frombuffer(foot, np.uint8, docs, 8 * (blocks + docs))
        self.doc_ids = [None if n else int(x) for x, n in zip(known, null)]
        self.lengths = np.frombuffer(foot, "<u4", docs, 8 * blocks + 9 * docs).astype(np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids from ``first`` on, decoding the blocks that hold them."""
        if not count:
            return np.empty(0, np.uint32)
        a, b = first // BLOCK_IDS, (first + count - 1) // BLOCK_IDS + 1
        self.source.seek(int(self.starts[a]))
        data = self.source.read(int(self.starts[b] - self.starts[a]))
        ids = np.concatenate([unpack_block(data, int(s - self.starts[a])) for s in self.starts[a:b]])
        return ids[first - a * BLOCK_IDS :][:count]


_CLASS = np.full(256, 4, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other, 4 left to the library
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x27] = _CLASS[0x7C] = 4  # contractions; special tokens hold a bar
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0


#: The normaliser and splitter that the cutting below stands for, as the library writes them.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def cuts_alike(tokenizer) -> bool:
    """Whether a tokenizer cuts and lower-cases texts as ``PieceEncoder`` does; all others get whole texts."""
    held = json.loads(tokenizer.to_str())
    return (
        held["normalizer"] == NORMALIZER and held["pre_tokenizer"] == SPLITTER and held["truncation"] is None and held["padding"] is None
        and held["model"]["type"] == "BPE" and not held["model"].get("dropout") and held["model"].get("end_of_word_suffix") == "</w>"
        and all("|" in token["content"] for token in held["added_tokens"])
    )


class PieceEncoder:
    """Ids of white-space-free pieces by the tokenizers library, each distinct piece once while remembered.

    Chunks of ASCII and of the Latin letters with two-byte codes that begin with 0xC3 are cut into runs of
    letters, single digits and runs of others, lower-cased: what this tokenizer's own normaliser and
    splitter make of them (a test holds them against it).  Any other chunk goes to the library whole, and
    so does any text if the tokenizer has another normaliser or splitter.  Pieces are told by two
    independent 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.cuts = cuts_alike(self.whole)
        self.model = self.whole.model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.reset()

    def reset(self) -> None:
        self.keys, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.first, self.length = np.array([0], np.int64), np.array([1], np.int64)
        self.pool = np.array([END_ID], np.uint32)
        self.check = np.array([0], np.uint64)  # of each unit

    def _library(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [bytes(data[a:z]).decode() for a, z in zip(offsets[:-1], offsets[1:])]
        ids = [[*self.whole.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
        return np.array([len(x) for x in ids], np.int64), np.array([y for x in ids for y in x], np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per document, ids) of a slice, the end id after each document."""
        if not self.cuts:
            return self._library(data, offsets)
        start, end, row = words_of(data, offsets)
        data, kind = self._classed(data, start, end)
        edge = np.zeros(len(data) + 1, bool)
        edge[start] = edge[end] = True
        cut = edge[:-1].copy()
        if len(data):
            cut[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut &= kind > 0
        first = np.flatnonzero(cut)
        stop = np.append(first[1:], len(data))
        if len(start):
            stop = np.minimum(stop, end[np.searchsorted(start, first, side="right") - 1])
        whole = (kind[first] == 4).astype(np.uint64)
        hashes, checks = (word_hashes(data, first, stop, fold=False, table=t) ^ whole for t in (0, 1))
        unit = self._units(hashes, checks, data, first, stop, kind)
        bounds = np.searchsorted(first, offsets[1:], side="left")
        unit = np.insert(unit, bounds, 0)  # unit 0 is the end id
        bounds = np.append(0, bounds + np.arange(1, len(bounds) + 1))
        length = self.length[unit]
        total = np.append(0, np.cumsum(length))
        take = np.arange(total[-1]) - np.repeat(total[:-1] - self.first[unit], length)
        return np.diff(total[bounds]), self.pool[take]

    @staticmethod
    def _classed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cased bytes and each byte's class; chunks for the library stay as they are, all of class 4."""
        kind = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        good = (tail != 0x97) & (tail != 0xB7)
        lead, tail = lead[good], tail[good]
        kind[lead] = kind[lead + 1] = 1
        lower = data.copy()
        upper = (data >= 0x41) & (data <= 0x5A)
        lower[upper] += 32
        lower[lead[(tail >= 0x80) & (tail <= 0x9E)] + 1] += 32
        odd = kind == 4
        if odd.any():
            held = np.searchsorted(start, np.flatnonzero(odd), side="right") - 1
            for i in np.unique(held):
                kind[start[i] : end[i]] = 4
                lower[start[i] : end[i]] = data[start[i] : end[i]]
        return lower, kind

    def _units(self, hashes: np.ndarray, checks: np.ndarray, data: np.ndarray, first: np.ndarray, stop: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Place of each piece in the pool's tables, encoding those not met before."""
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if not len(distinct):
            return np.empty(0, np.int64)
        if len(self.keys) + len(distinct) > REMEMBERED:
            self.reset()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            places = self._add(where[fresh], checks, data, first, stop, kind)
            spot = np.searchsorted(self.keys, distinct[fresh])
            self.keys, self.place = np.insert(self.keys, spot, distinct[fresh]), np.insert(self.place, spot, places)
            at = np.searchsorted(self.keys, distinct)
        unit = self.place[at][back]
        unlike = np.flatnonzero(self.check[unit] != checks)  # another piece of the same first hash: encoded on its own
        if len(unlike):
            unit[unlike] = self._add(unlike, checks, data, first, stop, kind)
        return unit

    def _add(self, pieces: np.ndarray, checks: np.ndarray, data: np.ndarray, first: np.ndarray, stop: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """New units for some pieces."""
        ids = [self._ids(bytes(data[first[i] : stop[i]]), kind[first[i]]) for i in pieces]
        length = np.array([len(x) for x in ids], np.int64)
        places = len(self.first) + np.arange(len(ids))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pool = np.concatenate([self.pool, np.array([y for x in ids for y in x], np.uint32)])
        self.check = np.concatenate([self.check, checks[pieces]])
        return places

    def _ids(self, piece: bytes, kind: int) -> list[int]:
        text = piece.decode()
        if kind == 4:
            return self.whole.encode(text, add_special_tokens=False).ids
        if not text.isascii():
            text = self.as_bytes.pre_tokenize_str(text)[0][0]
        return [t.id for t in self.model.tokenize(text)]


@lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    """One per worker, kept over its tasks."""
    return PieceEncoder(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order; returns the written table of files.

    Null ids come first, equal ids go by the CRC of their text; null and empty texts have the end id
    only; other columns are ignored.  Files are named by partition, attempt and number, and the table
    names those of committed attempts, so lost tasks leave nothing that a reader meets.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pieces = TaskContext.get(), encoder(tokenizer)
        files, root = shared_file(folder)
        writer, name, seq, done = None, "", 0, []
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}-{seq}.pfb"
                    writer = BlockWriter(files.open_output_stream(f"{root}/{name}", compression=None))
                lengths, ids = pieces.encode(data, offsets)
                writer.add(ids_of[lo:hi], lengths, ids)
                if writer.ids >= file_ids:
                    done.append(_close(writer, task.partitionId(), seq, name))
                    writer, seq = None, seq + 1
        if writer is not None:
            done.append(_close(writer, task.partitionId(), seq, name))
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "seq", "file", "ids", "docs", "blocks"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.crc32("text")).repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text")
    return materialise(rows.mapInArrow(write, FILES_SCHEMA), "token-files")


def _close(writer: BlockWriter, part: int, seq: int, name: str) -> tuple:
    writer.close()
    return part, seq, name, writer.ids, len(writer.doc_ids), len(writer.starts)


def read_token_files(files_table: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it), n_tokens and ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_file(folder)
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                path = f"{root}/{name}"
                with files.open_input_file(path) as source:
                    yield from _documents(BlockReader(source, files.get_file_info(path).size), before)

    order = Window.partitionBy(F.lit(0)).orderBy("part", "seq")  # a row per file of millions of ids
    placed = files_table.withColumn("before", F.sum("ids").over(order) - F.col("ids")).select("file", "before")
    count = max(1, files_table.count())
    return placed.repartition(count, "file").mapInArrow(read, DOCS_SCHEMA)


def _documents(reader: BlockReader, before: int, run: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of documents, some ``run`` ids decoded at a time."""
    lo = 0
    while lo < len(reader.lengths):
        hi = max(lo + 1, int(np.searchsorted(reader.firsts, reader.firsts[lo] + run)))
        ids = reader.read(int(reader.firsts[lo]), int(reader.lengths[lo:hi].sum())).astype("<u4")
        at = reader.firsts[lo:hi] - reader.firsts[lo]
        crc = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at, reader.lengths[lo:hi])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(reader.doc_ids[lo:hi], pa.int64()),
                pa.array(reader.firsts[lo:hi] + before),
                pa.array(reader.lengths[lo:hi]),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
        lo = hi


def token_output(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the token files under the shared folder and reads them back; an empty table gives no rows."""
    folder = scratch_path(docs.sparkSession, "llm", "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
