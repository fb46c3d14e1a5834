"""Shared helpers of the training-data operators.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set is its
distinct k-word shingles (fewer words: the whole sequence as one; no words: empty).
Shingles are 64-bit hashes computed over whole Arrow buffers in slices of bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random value for each byte at each place of a stretch: equal sums need equal words, whatever their structure.
_STRETCH = 64
_BYTES = [np.random.default_rng(seed).integers(0, 2**64, (_STRETCH, 256), dtype=np.uint64) for seed in (20240917, 20250311)]
_POWER = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


#: Rows and bytes that go to a Python worker at once.  A batch is held several times over: by the JVM, which keeps
#: such buffers for later ones, and by the worker.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside use ``BATCHES``; the session's own settings stay."""
    before = {key: spark.conf.get(key, None) for key in BATCHES}
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under spark.checkpoint.dir and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of two to four longs that may be broadcast: about 32 MB.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a written narrow table, only if its row count is within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so what is made of a batch stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) of a string column; null is empty.

    A slice ends once it holds ``limit`` bytes; a longer text is a slice of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def runs_of(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true bytes; a row's end ends a run."""
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    if len(solid):
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        stops[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of a slice."""
    start, end = runs_of(~_SPACE[data], offsets)
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True, table: int = 0) -> np.ndarray:
    """64-bit hash of each word; ``fold`` lower-cases A-Z first; the two tables give independent hashes.

    Tabulation: the sum of a random value per byte and place; behind the first 64 places, that
    value is mixed with the number of the stretch.
    """
    if not len(start):
        return np.empty(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
    chars = data[np.repeat(start, length) + place]
    value = _BYTES[table][place % _STRETCH, _LOWER[chars] if fold else chars]
    with np.errstate(over="ignore"):
        far = np.flatnonzero(place >= _STRETCH)
        if len(far):
            value[far] = mix(value[far] + (place[far] // _STRETCH).astype(np.uint64) * _POWER)
        return mix(np.add.reduceat(value, first) + length.astype(np.uint64))


def shingles_of(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of every k-word shingle, in text order; a row of fewer words gives one of all its words."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    weight = mix(np.arange(1, k + 1, dtype=np.uint64) * _POWER) | np.uint64(1)
    m = max(0, n - k + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(m, np.uint64)
        for i in range(k):
            h += words[i : i + m] * weight[i]
        full = np.flatnonzero(row[:m] == row[k - 1 :]) if m else np.empty(0, np.int64)
        h = mix(h[full] + np.uint64(k))
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        count = np.diff(np.append(first, n))
        short = first[count < k]
        extra = np.array([_whole(words[i : i + c], weight) for i, c in zip(short, count[count < k])], np.uint64)
    place = np.concatenate([full, short]).astype(np.int64)
    order = np.argsort(place, kind="stable")
    return np.concatenate([h, extra])[order], row[place][order], place[order]


def _whole(words: np.ndarray, weight: np.ndarray) -> np.uint64:
    return mix((words * weight[: len(words)]).sum(dtype=np.uint64).reshape(1) + np.uint64(len(words)))[0]


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row that has words."""
    for lo, _, data, offsets in text_slices(column):
        start, end, row = words_of(data, offsets)
        h, of, _ = shingles_of(word_hashes(data, start, end), row, k)
        if not len(h):
            continue
        order = np.lexsort((h, of))
        h, of = h[order], of[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])
        h, of = h[new], of[new]
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        for a, b in zip(cut[:-1], cut[1:]):
            yield lo + int(of[a]), h[a:b]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` holds long pairs; returns (node, component) for every node of an edge, the
    component being its smallest node.  Each step is two aggregations and a join of written
    tables, so AQE can split a hub's edges; the edge list never leaves Spark.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs = materialise(pairs, "cc")
    while not _are_stars(pairs):
        both = materialise(pairs.union(pairs.select("v", "u")), "cc")
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u > v").distinct(), "cc")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "cc")
        joined = large.join(least, "u")
        star = joined.select(F.greatest("u", "m").alias("u"), F.least("u", "m").alias("v")).union(
            joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        pairs = materialise(star.distinct(), "cc")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether each larger node has one smaller one, which has none itself: nothing is left to contract."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(pairs.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def shared_file(uri: str):
    """(file system, path) for a URI under the shared folder, from a task.

    ``s3a`` and ``s3n`` are the names that Hadoop has for ``s3``; ``dbfs:/`` is mounted under ``/dbfs``.  A scheme that
    is not known is an error and never a folder of the machine.
    """
    from pyarrow import fs

    scheme, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(.*)", uri, re.S).groups()
    if scheme is None:
        return fs.LocalFileSystem(), uri
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        return fs.FileSystem.from_uri(f"s3:{rest}")
    return fs.FileSystem.from_uri(uri)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as make it none of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a unique long per row, and that column's name (none of the table's own)."""
    name = free_name(docs.columns, "_row")
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name
