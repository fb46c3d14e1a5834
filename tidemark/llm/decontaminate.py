"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is leaked by a document that holds at least ``threshold`` of the item's distinct
k-word shingles.  Plain MinHash fails here, for a short item in a long text has a tiny Jaccard.
So items are partitioned by size, and each document is cut, per partition, into half-overlapping
windows of twice the partition's largest size: a contained passage lies within one window
and its Jaccard with it is at least threshold / (3 - threshold).  Items and windows carry
one-permutation MinHash signatures: ``BINS`` bins by the top bits of a shingle's hash, with the
smallest hash of each.  A window that agrees with an item in one bin makes a candidate, and
candidates are verified by exact containment of the words in the whole document.

A window's signature is evaluated lazily: a bin can agree with an item's only if the window has
the item's minimum, so only shingles found among the items' minima are compared with the
rest of their bin.  The search runs in one pass over the documents and shuffles nothing; the
benchmark is a query set that goes to the tasks in blocks of ``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, materialise, shingles_of, small, text_slices, word_hashes, words_of

BINS = 128
#: Items of fewer distinct shingles are candidates wherever one of them is; a window's bin could hide so few.
FEW_SHINGLES = 8
#: Bytes of item text sent to the tasks at once (the broadcast's proven bound).
BLOCK_BYTES = 16 << 20
LEAKS_SCHEMA = "doc_id long, item_id long, item_shingles long, shared_shingles long, containment double"

_WORD = regex.compile(WORD)
_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def word_list(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_ASCII_LOWER))


def word_shingles(words: list[str], k: int) -> set[tuple[str, ...]]:
    """Distinct k-word shingles; fewer words give one of them all, no words none."""
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k))))


class ItemIndex:
    """Signatures of a block of items, by shingle width and size partition."""

    def __init__(self, items: list[tuple[int, str]], k: int):
        self.groups: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.items: list[tuple[int, set[tuple[str, ...]]]] = []
        minima: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = word_list(text)
            if not words:
                continue
            width = min(k, len(words))
            self.items.append((item_id, word_shingles(words, width)))
            data = np.frombuffer(text.encode(), np.uint8)
            start, end, row = words_of(data, np.array([0, len(data)]))
            h = np.unique(shingles_of(word_hashes(data, start, end), row, width)[0])
            if len(h) < FEW_SHINGLES:
                minima.setdefault((width, 0), []).extend((int(x), len(self.items) - 1) for x in h)
                continue
            size = 1 << max(3, (len(words) - 1).bit_length())
            first = np.concatenate([[True], _bin(h)[1:] != _bin(h)[:-1]])  # sorted: the first of a bin is its smallest
            minima.setdefault((width, size), []).extend((int(x), len(self.items) - 1) for x in h[first])
        for key, pairs in minima.items():
            value = np.array([p[0] for p in pairs], np.uint64)
            order = np.argsort(value, kind="stable")
            self.groups[key] = value[order], np.array([p[1] for p in pairs])[order], _marks(value)

    def candidates(self, words: np.ndarray, row: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) of documents' windows that agree with an item in a bin."""
        found: set[tuple[int, int]] = set()
        for width in {w for w, _ in self.groups}:
            h, of, first = shingles_of(words, row, width)
            offset = first - np.searchsorted(row, of, side="left")
            for (w, size), (value, owner, marks) in self.groups.items():
                if w != width:
                    continue
                hit = np.flatnonzero(marks[h >> np.uint64(44)])
                place = np.searchsorted(value, h[hit])
                place[place == len(value)] = 0
                hit = hit[value[place] == h[hit]]
                for i in hit:
                    if not size:  # a short item: any of its shingles
                        a, z = np.searchsorted(value, h[i], "left"), np.searchsorted(value, h[i], "right")
                        found.update((int(of[i]), int(x)) for x in owner[a:z])
                        continue
                    lo = np.searchsorted(of, of[i], side="left")
                    hi = np.searchsorted(of, of[i], side="right")
                    half = offset[i] // size
                    for b in (half - 1, half):  # the two windows over this half
                        a = np.searchsorted(offset[lo:hi], max(0, b) * size) + lo
                        z = np.searchsorted(offset[lo:hi], (b + 2) * size) + lo
                        window = h[a:z]
                        if window[_bin(window) == _bin(h[i : i + 1])[0]].min() == h[i]:
                            a, z = np.searchsorted(value, h[i], "left"), np.searchsorted(value, h[i], "right")
                            found.update((int(of[i]), int(x)) for x in owner[a:z])
                            break
        return found


def _bin(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - BINS.bit_length() + 1)


def _marks(value: np.ndarray) -> np.ndarray:
    """Which top 20 bits occur: a first, cheap filter."""
    marks = np.zeros(1 << 20, bool)
    marks[value >> np.uint64(44)] = True
    return marks


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one partition of a few blocks in the driver at a time."""
    block, held = [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item_id, text in rows.distinct().toLocalIterator():
        block.append((item_id, text))
        held += len(text)
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment) of every leaked item of every document row.

    Words have A-Z lower-cased.  An item of fewer than ``k`` words is one shingle of all its words,
    looked for as a run of that length; items without words, null items and empty or null texts
    match nothing.  Repeated document rows give repeated results, repeated items one.  Extra
    columns are ignored.
    """
    found = None
    for block in item_blocks(benchmark, block_bytes):
        part = _search(docs, block, k, threshold)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], LEAKS_SCHEMA) if found is None else found


def _search(docs: DataFrame, block: list[tuple[int, str]], k: int, threshold: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(sent.value, k)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            out = []
            for lo, hi, data, offsets in text_slices(texts):
                start, end, row = words_of(data, offsets)
                for r, group in _by_row(index.candidates(word_hashes(data, start, end), row)):
                    words = word_list(texts[lo + r].as_py())
                    sets: dict[int, set] = {}
                    for item in group:
                        item_id, shingles = index.items[item]
                        width = len(next(iter(shingles)))
                        own = sets.setdefault(width, word_shingles(words, width))
                        shared = len(shingles & own)
                        if shared >= threshold * len(shingles) - 1e-9:
                            out.append((ids[lo + r].as_py(), item_id, len(shingles), shared, shared / len(shingles)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                names = ["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(search, LEAKS_SCHEMA)


def _by_row(found: set[tuple[int, int]]) -> Iterator[tuple[int, list[int]]]:
    rows: dict[int, list[int]] = {}
    for r, item in found:
        rows.setdefault(r, []).append(item)
    yield from sorted((r, sorted(items)) for r, items in rows.items())


def drop_leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows that leak an item; a text decides alone, so rows are told by its 64-bit hash.

    Rows of null or empty text stay, repeated rows stay or go together, and null ids count like others.
    """
    found = find_leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark, k, threshold)
    name = free_name(docs.columns, "_leaked")
    leaked = small(materialise(found.select(F.col("doc_id").alias(name)).distinct(), "leaked"))
    return docs.join(leaked, F.xxhash64(docs["text"]) == F.col(name), "left_anti")
