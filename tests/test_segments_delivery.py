"""The segment source and the sink with a commit protocol."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.plans.crashing import CrashingSink
from tidemark.sinks.delivered import DeliveredWriter, Written, deliver_stream, delivered
from tidemark.sources.segments import SegmentStreamReader, Slice, land_segments, next_ends, segment_stream, segments, shares, slices

OUT = "log_partition int, log_offset long, value string, lost long"


def _land(spark, path, first, end, partitions=2, segment_rows=10):
    rows = spark.range(first, end).crossJoin(spark.range(partitions).withColumnRenamed("id", "p"))
    rows = rows.select(F.col("p").cast("int").alias("log_partition"), F.col("id").alias("log_offset"), F.concat_ws("-", "p", "id").alias("value"))
    return land_segments(rows, f"{path}/log", segment_rows).collect()


def _read(spark, path, run="r", sink=None, **options):
    """The new batches of a run, as many as there are."""
    stream = segment_stream(spark, f"{path}/log", positionPath=f"{path}/position-{run}", **options)
    kind = {} if sink is None else {"sink": sink, "after": 1, "before": 2, "marks": f"{path}/marks"}
    query = deliver_stream(stream, f"{path}/out", f"{path}/ck-{run}", run, **kind)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def _rows(spark, path, run="r"):
    found = delivered(spark, f"{path}/out", OUT).where(F.col("run_id") == run)
    return sorted((r["log_partition"], r["log_offset"], r["value"], r["lost"]) for r in found.collect())


def _all(first, end, partitions=2):
    return [(p, at, f"{p}-{at}", None) for p in range(partitions) for at in range(first, end)]


def test_ends_share_the_cap():
    ends = {0: 100, 1: 10, 2: 0}
    assert next_ends({}, ends, None) == ends
    assert next_ends({0: 100, 1: 10}, ends, 5) == ends
    at, batches = {}, 0
    while (new := next_ends(at, ends, 7)) != at | {2: 0}:
        assert 0 < sum(new.values()) - sum(at.values()) <= 7
        at, batches = new, batches + 1
    assert at == ends and batches == 16
    assert next_ends({0: 120}, {0: 100}, 5) == {0: 120}  # a start beyond the end waits there


def test_slices_cover_each_offset_once():
    runs = [(0, 10, "a"), (10, 20, "b"), (15, 18, "inside"), (18, 25, "over"), (30, 40, "c")]
    assert slices(runs, 1, 5, 35) == [
        Slice(1, 5, 10, "a"), Slice(1, 10, 20, "b"), Slice(1, 20, 25, "over"), Slice(1, 25, 30, None), Slice(1, 30, 35, "c")]
    assert slices([], 0, 3, 5) == [Slice(0, 3, 5, None)] and slices(runs, 0, 7, 7) == []


def test_small_segments_share_a_task():
    found = [Slice(0, 0, 4, "a"), Slice(0, 4, 8, "b"), Slice(0, 8, 90, None), Slice(0, 90, 92, "c"), Slice(1, 0, 25, "d"), Slice(1, 25, 26, "e")]
    dealt = [s.slices for s in shares(found, 10)]
    assert dealt == [found[:3], found[3:4], found[4:5], found[5:]] and shares([]) == []


def test_many_segments_need_few_tasks_and_groups(spark, tmp_dir):
    landed = _land(spark, tmp_dir, 0, 2000)
    assert len(landed) == 400 and sum(r["rows"] for r in landed) == 4000
    reader = SegmentStreamReader({"path": f"{tmp_dir}/log"})
    tasks = reader.partitions({"0": 0, "1": 0}, {"0": 2000, "1": 1995})
    assert len(tasks) == 1 and len(tasks[0].slices) == 400
    got = [(r["log_partition"], r["log_offset"], r["value"]) for batch in reader.read(tasks[0]) for r in batch.to_pylist()]
    assert sorted(got) == [(p, at, f"{p}-{at}") for p, end in ((0, 2000), (1, 1995)) for at in range(end)]


def test_landed_segments_over_batches_and_repeated_offsets(spark, tmp_dir):
    """Segments that span several Arrow batches, and offsets that come twice, stay whole."""
    rows = spark.range(0, 60).union(spark.range(0, 60, 7)).select(
        F.lit(0).alias("log_partition"), F.col("id").alias("log_offset"), F.col("id").cast("string").alias("value"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        landed = sorted(land_segments(rows, f"{tmp_dir}/log", 20).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(r) for r in landed] == [(0, 0, 20, 23), (0, 20, 40, 23), (0, 40, 60, 23)]


def test_landed_names_and_repeats(spark, tmp_dir):
    landed = _land(spark, tmp_dir, 0, 25)
    again = _land(spark, tmp_dir, 0, 25)
    assert sorted(landed) == sorted(again) and sum(r["rows"] for r in landed) == 50
    assert [(a, b) for a, b, _ in segments(f"{tmp_dir}/log")[1]] == [(0, 10), (10, 20), (20, 25)]


def test_batches_stay_under_the_cap_and_a_restart_goes_on(spark, tmp_dir):
    _land(spark, tmp_dir, 0, 25)
    query = _read(spark, tmp_dir, maxOffsetsPerTrigger=12)
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sum(sizes) == 50 and max(sizes) <= 12 and len(sizes) == 5
    _land(spark, tmp_dir, 25, 40)
    _read(spark, tmp_dir, maxOffsetsPerTrigger=12)
    assert _rows(spark, tmp_dir) == _all(0, 40)
    _read(spark, tmp_dir, maxOffsetsPerTrigger=12)  # nothing new
    assert _rows(spark, tmp_dir) == _all(0, 40)


def test_start_positions(spark, tmp_dir):
    _land(spark, tmp_dir, 5, 25)
    _read(spark, tmp_dir, "given", startingOffsets='{"1": 17}')
    assert _rows(spark, tmp_dir, "given") == [r for r in _all(5, 25) if r[0] == 0 or r[1] >= 17]
    _read(spark, tmp_dir, "latest", startingOffsets="latest")
    assert _rows(spark, tmp_dir, "latest") == []
    _land(spark, tmp_dir, 25, 30)
    _read(spark, tmp_dir, "latest", startingOffsets="latest")
    assert _rows(spark, tmp_dir, "latest") == _all(25, 30)
    with pytest.raises(Exception, match="positionPath"):
        deliver_stream(segment_stream(spark, f"{tmp_dir}/log", maxOffsetsPerTrigger=3), f"{tmp_dir}/x", f"{tmp_dir}/ckx", "x").processAllAvailable()


def test_lost_segment_fails_or_is_reported(spark, tmp_dir):
    _land(spark, tmp_dir, 0, 30)
    os.rename(f"{tmp_dir}/log/partition=1/{10:020d}-{20:020d}.parquet", f"{tmp_dir}/gone")
    with pytest.raises(StreamingQueryException, match="offsets in no segment: 1:10-20"):
        _read(spark, tmp_dir, "strict")
    _read(spark, tmp_dir, "lenient", failOnDataLoss=False)
    kept = [r for r in _all(0, 30) if r[0] == 0 or not 10 <= r[1] < 20]
    assert sorted(_rows(spark, tmp_dir, "lenient"), key=str) == sorted([*kept, (1, 10, None, 10)], key=str)
    os.rename(f"{tmp_dir}/gone", f"{tmp_dir}/log/partition=1/{10:020d}-{20:020d}.parquet")
    _read(spark, tmp_dir, "strict")  # found again: nothing was skipped
    assert _rows(spark, tmp_dir, "strict") == _all(0, 30)


def test_failed_and_repeated_batches_are_delivered_once(spark, tmp_dir):
    _land(spark, tmp_dir, 0, 30)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="told to fail"):
            _read(spark, tmp_dir, sink=CrashingSink, maxOffsetsPerTrigger=12)
    _read(spark, tmp_dir, sink=CrashingSink, maxOffsetsPerTrigger=12)
    assert _rows(spark, tmp_dir) == _all(0, 30)
    assert len(glob.glob(f"{tmp_dir}/out/commits/*.json")) == 5  # one per batch of 60 offsets


def test_small_segments_are_delivered_in_few_files(spark, tmp_dir):
    _land(spark, tmp_dir, 0, 600, segment_rows=4)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="told to fail"):
            _read(spark, tmp_dir, sink=CrashingSink, maxOffsetsPerTrigger=400)
    _read(spark, tmp_dir, sink=CrashingSink, maxOffsetsPerTrigger=400)
    assert _rows(spark, tmp_dir) == _all(0, 600)
    assert len(glob.glob(f"{tmp_dir}/out/commits/*.json")) == 3
    assert len(glob.glob(f"{tmp_dir}/out/data/*.parquet")) <= 4  # 300 segments; a failed batch may leave a file


def test_commit_is_once_and_abort_leaves_what_is_visible(tmp_dir):
    import pyarrow as pa

    writer = DeliveredWriter({"path": tmp_dir, "run_id": "r"})
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    first, second, none = writer.write(iter([batch, batch])), writer.write(iter([batch])), writer.write(iter([]))
    assert (first.rows, second.rows, none) == (4, 2, Written(None, 0))
    writer.commit([first, none, None], 0)
    writer.commit([second], 0)
    writer.abort([first], 0)
    assert os.listdir(f"{tmp_dir}/data") == [first.file]


def test_nothing_delivered_yet(spark, tmp_dir):
    assert delivered(spark, f"{tmp_dir}/none", OUT).columns == ["log_partition", "log_offset", "value", "lost", "run_id", "batch_id"]
    assert delivered(spark, f"{tmp_dir}/none", OUT).count() == 0
