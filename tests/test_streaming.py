"""ST1-ST11: the streaming job on the file stand-in source.

FIXTURES section 3 trace: one file per micro-batch, 1-minute window, 2-minute
watermark, append mode, availableNow with maxFilesPerTrigger=1.
"""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.config import DEFAULT
from tidemark.operators.rollups import aggregate_totals
from tidemark.plans import suite
from tidemark.plans.backfill import WarehousePaths, current_actions, current_totals
from tidemark.sources.files import events_stream, text_stream
from tidemark.streaming.monitor import ProgressRecorder, attach, detach
from tidemark.streaming.rollup_stream import (
    LATE_POLICY_CONF,
    set_late_policy,
    start_pipeline,
    start_two_queries,
    watermarked_events,
)

BASE = 1700000040  # 2023-11-14 22:14:00 UTC
TRACE = [[0, 10, 59], [60, 61], [65, 200], [5, 70, 130], [500], [7, 480]]
CFG = DEFAULT.with_(window="1 minute", watermark="2 minutes")


def _write_trace(directory, batches, first=0):
    """One file per batch; modification times 1 s apart fix the file order
    (the file source orders new files by modification time)."""
    os.makedirs(directory, exist_ok=True)
    for i, offsets in enumerate(batches, start=first):
        path = os.path.join(directory, f"part-{i:03d}.json")
        with open(path, "w") as fh:
            for off in offsets:
                fh.write(json.dumps({"wiki": "enwiki", "type": "edit", "timestamp": BASE + off}) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def _lookup(spark):
    return spark.createDataFrame([("enwiki", "English Wikipedia", "en")],
                                 "lk_wiki_key string, lk_wiki_label string, lk_language string")


def _w(minute):
    return dt.datetime(2023, 11, 14, 22, minute)


def _run_trace(spark, tmp_dir, strict):
    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE)
    emitted = []

    def sink(df, batch_id):
        rows = sorted((r["window_end"], r["edit_count"]) for r in df.collect())
        if rows:
            emitted.append(rows)

    set_late_policy(spark, strict)
    try:
        stream = aggregate_totals(watermarked_events(text_stream(spark, src, 1), CFG), CFG)
        q = (stream.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(availableNow=True).foreachBatch(sink).start())
        q.awaitTermination()
        assert q.exception() is None
    finally:
        spark.conf.unset(LATE_POLICY_CONF)
    return emitted


def test_trace_default_late_policy(spark, tmp_dir):
    emitted = _run_trace(spark, tmp_dir, strict=False)
    assert emitted == [[(_w(15), 4)], [(_w(16), 4), (_w(17), 1), (_w(18), 1)]]


def test_trace_strict_late_policy(spark, tmp_dir):
    emitted = _run_trace(spark, tmp_dir, strict=True)
    assert emitted == [[(_w(15), 3)], [(_w(16), 4), (_w(17), 1), (_w(18), 1)]]


def _pipeline(spark, src, root, run_id="run", lookup_loader=None):
    paths = WarehousePaths(f"{root}/wh")
    q = start_pipeline(spark, text_stream(spark, src, 1), lookup_loader or (lambda: _lookup(spark)), paths,
                       f"{root}/ck", run_id, CFG, available_now=True)
    try:
        q.awaitTermination()
    except Exception:  # a failed query is inspected through q.exception()
        pass
    return q, paths


def test_pipeline_trace_and_restart(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE[:3])
    q, paths = _pipeline(spark, src, tmp_dir)
    assert q.exception() is None
    # stop between batches, add the rest, restart on the same checkpoint
    _write_trace(src, TRACE[3:], first=3)
    q, paths = _pipeline(spark, src, tmp_dir)
    assert q.exception() is None
    got = sorted((r["window_end"], r["edit_count"], r["wiki_label"]) for r in current_totals(spark, paths).collect())
    # The first run ends with a no-data batch that advances the watermark past
    # 22:15 and emits that window with 3 events; the event at offset 5 then
    # arrives late and is dropped (a continuous run counts it, see the trace).
    assert got == [(_w(15), 3, "English Wikipedia"), (_w(16), 4, "English Wikipedia"),
                   (_w(17), 1, "English Wikipedia"), (_w(18), 1, "English Wikipedia")]
    acts = current_actions(spark, paths)
    assert acts.agg(F.sum("event_count")).first()[0] == 9


def test_failed_sink_batch_is_replayed_without_duplicates(spark, tmp_dir):  # B2
    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE)
    calls = {"n": 0}

    def flaky_lookup():
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("lookup unavailable once")
        return _lookup(spark)

    q, paths = _pipeline(spark, src, tmp_dir, lookup_loader=flaky_lookup)
    assert q.exception() is not None
    q, paths = _pipeline(spark, src, tmp_dir, lookup_loader=flaky_lookup)
    assert q.exception() is None
    cur = current_totals(spark, paths)
    assert cur.count() == 4
    from tidemark.sinks.warehouse import read_rollup

    assert read_rollup(spark, paths.totals).count() == 4  # no duplicate versions


def test_two_query_mode_matches_one_query(spark, tmp_dir):  # ST7, section 4.1
    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE)
    _, one = _pipeline(spark, src, f"{tmp_dir}/one")
    two = WarehousePaths(f"{tmp_dir}/two/wh")
    qt, qa = start_two_queries(spark, lambda: text_stream(spark, src, 1), _lookup(spark), two, f"{tmp_dir}/two/ck",
                               "run", CFG, available_now=True)
    qt.awaitTermination()
    qa.awaitTermination()
    cols = ["window_end", "wiki", "wiki_label", "language", "edit_count", "bot_count", "human_count", "anomaly_flag"]
    a = current_totals(spark, one).select(*cols)
    b = current_totals(spark, two).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    acols = ["window_end", "wiki", "event_type", "event_count", "bot_count", "minor_count"]
    c = current_actions(spark, one).select(*acols)
    d = current_actions(spark, two).select(*acols)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_stream_equals_batch_on_events(spark, tmp_dir):
    cfg = suite.QUERY_CONFIG
    paths = WarehousePaths(f"{tmp_dir}/wh")
    recorder = attach(spark, ProgressRecorder())
    try:
        q = start_pipeline(spark, events_stream(spark, SF_SMALL), lambda: suite._lookup(spark, SF_SMALL), paths,
                           f"{tmp_dir}/ck", "run", cfg, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    finally:
        detach(spark, recorder)
    cols = ["window_end", "wiki", "wiki_label", "language", "edit_count", "bot_count", "human_count", "anomaly_flag"]
    streamed = current_totals(spark, paths).select(*cols)
    parsed = suite._parsed(spark, SF_SMALL)
    last = parsed.agg(F.max("event_ts")).first()[0]
    batch = suite.totals_rollup(parsed, suite._lookup(spark, SF_SMALL), cfg).filter(
        F.col("window_end") <= F.lit(last - dt.timedelta(minutes=2)))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    rows = [r for r in recorder.rows() if r["query_id"] == str(q.id)]
    assert sum(r["num_input_rows"] for r in rows) == 1000
    assert not recorder.stalled(str(q.id), limit_seconds=3600)
    assert recorder.stalled(str(q.id), limit_seconds=0.0, now=10**12)


def test_kafka_source_options():
    from tidemark.sources.kafka import batch_options, sink_options, source_options

    opts = source_options(DEFAULT)
    assert opts["subscribe"] == "wiki.event.raw" and opts["maxOffsetsPerTrigger"] == "50000"
    assert opts["startingOffsets"] == "latest" and opts["failOnDataLoss"] == "false"
    assert opts["fetchOffset.numRetries"] == "5" and opts["kafka.session.timeout.ms"] == "60000"
    b = batch_options(DEFAULT)
    assert b["startingOffsets"] == "earliest" and b["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in b
    s = sink_options(DEFAULT, "/ck")
    assert s["kafka.acks"] == "all" and s["kafka.compression.type"] == "snappy" and s["checkpointLocation"] == "/ck"


def test_job_program_end_to_end(spark, tmp_dir):
    import subprocess
    import sys

    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE)
    lookup = f"{tmp_dir}/lookup.csv"
    with open(lookup, "w") as fh:
        fh.write("wiki_key,wiki_label,language\nenwiki,English Wikipedia,en\n")
    env = dict(os.environ, TIDEMARK_RAW_DIR=src, TIDEMARK_LOOKUP_CSV=lookup, TIDEMARK_AVAILABLE_NOW="1",
               TIDEMARK_WAREHOUSE=f"{tmp_dir}/wh", TIDEMARK_CHECKPOINT=f"{tmp_dir}/ck", TIDEMARK_WINDOW="1 minute",
               TIDEMARK_WATERMARK="2 minutes", TIDEMARK_TOTALS_TABLE="job_totals", TIDEMARK_ACTIONS_TABLE="job_actions",
               TIDEMARK_CREATE_TABLES="1")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "tidemark.streaming.job"], cwd=repo, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    got = sorted((r["window_end"], r["edit_count"]) for r in current_totals(spark, WarehousePaths(f"{tmp_dir}/wh")).collect())
    # maxFilesPerTrigger is not set here, so all files form one batch and
    # nothing is late: 22:15 holds offsets 0, 5, 7, 10 and 59; every window the
    # final watermark (22:20:20) passed is emitted
    assert got == [(_w(15), 5), (_w(16), 4), (_w(17), 1), (_w(18), 1)]


def test_late_policy_from_config(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE)
    paths = WarehousePaths(f"{tmp_dir}/wh")
    cfg = CFG.with_(late_policy="current")
    q = start_pipeline(spark, text_stream(spark, src, 1), lambda: _lookup(spark), paths, f"{tmp_dir}/ck", "r", cfg,
                       available_now=True)
    q.awaitTermination()
    got = {r["window_end"]: r["edit_count"] for r in current_totals(spark, paths).collect()}
    assert got[_w(15)] == 3  # the late row is dropped by the current watermark
    assert spark.conf.get(LATE_POLICY_CONF, None) in (None, "true")  # caller's session untouched


def test_publish_stream_to_files(spark, tmp_dir):  # K6 on a file sink
    from tidemark.sinks.kafka import publish_stream

    src = f"{tmp_dir}/feed"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write(json.dumps({"event": "message", "data": '{"meta":{"id":"k1"},"wiki":"a"}'}) + "\n")
        fh.write(json.dumps({"event": "ping", "data": "{}"}) + "\n")
        fh.write(json.dumps({"event": "", "data": "[DONE]"}) + "\n")
    lines = spark.readStream.schema("event string, data string").json(src)
    q = publish_stream(lines, f"{tmp_dir}/ck", f"{tmp_dir}/rejects", file_path=f"{tmp_dir}/out", available_now=True)
    q.awaitTermination()
    rejects = spark.read.parquet(f"{tmp_dir}/rejects").collect()
    assert sorted((r["reject_reason"], r["data"]) for r in rejects) == [("done", "[DONE]"), ("event", "{}")]
    out = spark.read.parquet(f"{tmp_dir}/out").selectExpr("CAST(key AS STRING) k", "CAST(value AS STRING) v").collect()
    assert [(r["k"], r["v"]) for r in out] == [("k1", '{"meta":{"id":"k1"},"wiki":"a"}')]


def test_default_run_id_is_the_query_id(spark, tmp_dir):
    """Restarts keep the run id; a fresh checkpoint gets a new one, so its
    batch 0 cannot overwrite the older run's batch 0."""
    from tidemark.sinks.warehouse import read_rollup

    src = f"{tmp_dir}/in"
    _write_trace(src, TRACE[:3])
    paths = WarehousePaths(f"{tmp_dir}/wh")

    def run(ck):
        q = start_pipeline(spark, text_stream(spark, src, 1), lambda: _lookup(spark), paths, ck, None, CFG,
                           available_now=True)
        q.awaitTermination()
        return str(q.id)

    first = run(f"{tmp_dir}/ck1")
    _write_trace(src, TRACE[3:], first=3)
    assert run(f"{tmp_dir}/ck1") == first  # restart: same id, same run
    second = run(f"{tmp_dir}/ck2")          # new checkpoint replays everything as a new run
    runs = {r["run_id"] for r in read_rollup(spark, paths.totals).select("run_id").distinct().collect()}
    assert runs == {first, second}
    assert current_totals(spark, paths).count() == 4
