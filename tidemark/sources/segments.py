"""A feed landed as segment files, streamed by its own offsets.

A log is a folder with one subfolder per partition; a segment file holds a run of offsets and says
so in its name, ``partition=<p>/<first>-<end>.parquet`` (``end`` exclusive, 20 digits), so newest
offsets come from a listing and no file is opened on the driver.  Offsets of a partition have no
gaps; a gap between segments is data that was lost.

Options:

- ``path``: the log's folder.
- ``startingOffsets``: ``earliest`` (default), ``latest``, or JSON from partition to offset; a partition it leaves out starts at its earliest.
- ``maxOffsetsPerTrigger``: most offsets of one batch over all partitions, shared by what each has
  left.  Needs ``positionPath``, a small file beside the checkpoint that holds the end of the newest
  planned batch: the source is not told where a restarted query stands.  A bounded run under a cap
  uses a processing-time trigger and ``processAllAvailable``; ``availableNow`` asks a Python source
  for one end and would read one batch.
- ``failOnDataLoss``: ``true`` (default) ends the query when offsets of a batch are in no segment;
  ``false`` gives one row per lost run: its first offset, no value, and in ``lost`` how many are gone.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .shared import files_in, get, put, shared_fs

FORMAT = "landed_segments"
SCHEMA = "log_partition int, log_offset long, value string, lost long"
_SEGMENT = re.compile(r"partition=(\d+)/(\d{20})-(\d{20})\.parquet$")
#: Offsets that one task reads of segments that are smaller than that.
SHARE_OFFSETS = 100_000
_ARROW = pa.schema([("log_partition", pa.int32()), ("log_offset", pa.int64()), ("value", pa.string()), ("lost", pa.int64())])


@dataclass
class Slice(InputPartition):
    """Offsets ``first`` to ``end`` of a log partition, all in the file ``path``; lost if there is none."""

    partition: int
    first: int
    end: int
    path: str | None


@dataclass
class Share(InputPartition):
    """Slices that one task reads, one after the other."""

    slices: list[Slice]


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first, end, file) of every segment by partition, in order; other files are ignored."""
    found: dict[int, list[tuple[int, int, str]]] = {}
    for name in files_in(path):
        if m := _SEGMENT.search(name):
            found.setdefault(int(m[1]), []).append((int(m[2]), int(m[3]), name))
    for runs in found.values():
        runs.sort(key=lambda run: (run[0], -run[1]))
    return found


def slices(runs: list[tuple[int, int, str]], partition: int, start: int, end: int) -> list[Slice]:
    """What covers offsets ``start`` to ``end``, each offset once: slices of files, and lost runs between them."""
    out, at = [], start
    for first, stop, name in runs:
        if stop <= at or first >= end or at >= end:
            continue
        if first > at:
            out.append(Slice(partition, at, first, None))
            at = first
        out.append(Slice(partition, at, min(stop, end), name))
        at = min(stop, end)
    if at < end:
        out.append(Slice(partition, at, end, None))
    return out


def shares(found: list[Slice], most: int = SHARE_OFFSETS) -> list[Share]:
    """The slices in their order, dealt to tasks of ``most`` offsets or one slice; a lost run is one row."""
    out, room = [], 0
    for piece in found:
        offsets = piece.end - piece.first if piece.path else 1
        if not out or offsets > room:
            out.append(Share([]))
            room = most
        out[-1].slices.append(piece)
        room -= offsets
    return out


def next_ends(at: dict[int, int], ends: dict[int, int], cap: int | None) -> dict[int, int]:
    """Ends of the next batch: all there is, or ``cap`` offsets shared by what each partition has left."""
    left = {p: max(0, ends[p] - at.get(p, 0)) for p in ends}
    total, out = sum(left.values()), dict(at)
    budget = total if cap is None else min(cap, total)
    rest = budget
    for p in sorted(ends):
        take = min(left[p], rest, -(-left[p] * budget // total)) if total else 0
        out[p] = at.get(p, 0) + take
        rest -= take
    return out


class SegmentStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.starting = options.get("startingOffsets", "earliest")
        self.cap = int(options["maxOffsetsPerTrigger"]) if "maxOffsetsPerTrigger" in options else None
        self.position_path = options.get("positionPath")
        self.fails = options.get("failOnDataLoss", "true").lower() != "false"
        if self.cap is not None and (self.cap < 1 or not self.position_path):
            raise ValueError("maxOffsetsPerTrigger needs to be positive and to come with positionPath")
        self.position: dict[int, int] | None = None

    def initialOffset(self) -> dict:
        found = segments(self.path)
        if self.starting == "latest":
            return {str(p): max(end for _, end, _ in runs) for p, runs in found.items()}
        given = {} if self.starting == "earliest" else {int(p): int(at) for p, at in json.loads(self.starting).items()}
        return {str(p): at for p, at in ({p: runs[0][0] for p, runs in found.items()} | given).items()}

    def latestOffset(self) -> dict:
        ends = {p: max(end for _, end, _ in runs) for p, runs in segments(self.path).items()}
        return {str(p): at for p, at in next_ends(self._position(), ends, self.cap).items()}

    def _position(self) -> dict[int, int]:
        if self.position is None:
            held = get(self.position_path) if self.position_path else None
            self.position = {int(p): at for p, at in (json.loads(held) if held else self.initialOffset()).items()}
        return self.position

    def partitions(self, start: dict, end: dict) -> list[Share]:
        """Tasks for the segments touched, small ones together.  A partition that is new in ``end`` starts at offset 0."""
        found, out = segments(self.path), []
        for p, stop in end.items():
            out += slices(found.get(int(p), []), int(p), start.get(p, 0), stop)
        lost = [s for s in out if s.path is None]
        if lost and self.fails:
            raise RuntimeError("offsets in no segment: " + ", ".join(f"{s.partition}:{s.first}-{s.end}" for s in lost[:10]))
        if self.position_path:
            put(self.position_path, json.dumps(end).encode())
        self.position = {int(p): at for p, at in end.items()}
        return shares(out)

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        for piece in share.slices:
            yield from self._rows(piece)

    def _rows(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.path is None:
            lost = partition.end - partition.first
            yield pa.RecordBatch.from_pylist([{"log_partition": partition.partition, "log_offset": partition.first, "lost": lost}], _ARROW)
            return
        system, _ = shared_fs(self.path)
        with system.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=4096, columns=["log_offset", "value"]):
                at = batch.column("log_offset").to_numpy()
                batch = batch.filter(pa.array((at >= partition.first) & (at < partition.end)))
                n = batch.num_rows
                columns = [pa.array([partition.partition] * n, pa.int32()), batch.column("log_offset"), batch.column("value").cast(pa.string()), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentStreamReader:
        return SegmentStreamReader(self.options)


def segment_stream(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The log as a stream of (log_partition, log_offset, value, lost); options as above."""
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(FORMAT).option("path", path)
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, str(value).lower() if isinstance(value, bool) else str(value))
    return reader.load()


def land_segments(rows: DataFrame, path: str, segment_rows: int = 100_000) -> DataFrame:
    """(log_partition int, log_offset long, value string) written as segments of at most ``segment_rows`` offsets.

    A task writes its segments one after the other and holds one.  A file appears whole under its name, so a
    repeated task replaces it by the same rows.  Returns (log_partition, first, stop, rows), one row per segment,
    as a plan: run it once.
    """

    def write(table: pa.Table) -> pa.RecordBatch:
        at, p = table.column("log_offset"), table.column("log_partition")[0].as_py()
        first, stop = at[0].as_py(), at[len(at) - 1].as_py() + 1
        system, root = shared_fs(path)
        folder = f"{root}/partition={p}"
        system.create_dir(folder)
        aside = f"{folder}/.{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(aside) as out:
            pq.write_table(table.select(["log_offset", "value"]), out)
        system.move(aside, f"{folder}/{first:020d}-{stop:020d}.parquet")
        return pa.RecordBatch.from_pydict({"log_partition": pa.array([p], pa.int32()), "first": [first], "stop": [stop], "rows": [len(at)]})

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            for piece, of in _by_segment(batch):
                if held and of != key:
                    yield write(pa.Table.from_batches(held))
                    held = []
                held.append(piece)
                key = of
        if held:
            yield write(pa.Table.from_batches(held))

    keys = ["log_partition", "segment"]
    dealt = rows.withColumn("segment", F.floor(F.col("log_offset") / segment_rows)).repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "log_offset").mapInArrow(land, "log_partition int, first long, stop long, rows long")


def _by_segment(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """(rows, their partition and segment) of each run of equal keys in a sorted batch."""
    keys = [batch.column(c) for c in ("log_partition", "segment")]
    new = np.zeros(max(0, batch.num_rows - 1), bool)
    for key in keys:
        values, null = key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False)
        new |= (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    cut = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    for a, b in zip(cut[:-1], cut[1:]):
        if b > a:
            yield batch.slice(a, b - a), tuple(key[a].as_py() for key in keys)
