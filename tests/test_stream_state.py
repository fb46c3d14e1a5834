"""Repeated messages, late rows kept aside, open windows flushed, and counts of dropped rows."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import raw_df
from tidemark.config import DEFAULT
from tidemark.functions.parse import drop_counts, flag_events, parse_events
from tidemark.plans.backfill import WarehousePaths, current_actions, current_totals
from tidemark.sources.files import text_stream
from tidemark.streaming.dedup import once_per_message
from tidemark.streaming.flush import flush_open_windows, open_windows
from tidemark.streaming.late_rows import late_counts, late_rows, split_batch, start_late_split
from tidemark.streaming.monitor import ProgressRecorder, heartbeat, parse_drops, sum_drops
from tidemark.streaming.rollup_stream import start_pipeline

BASE = 1700000040  # 2023-11-14 22:14:00 UTC
CFG = DEFAULT.with_(window="1 minute", watermark="2 minutes", shuffle_partitions=2)


def _event(offset, key=None, wiki="enwiki"):
    event = {"wiki": wiki, "type": "edit", "timestamp": BASE + offset}
    return json.dumps(event if key is None else {**event, "meta": {"id": key}})


def _put(folder, at, lines):
    import os

    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{at:03d}.json"
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


def _lookup(spark):
    return spark.createDataFrame([("enwiki", "English", "en")], "lk_wiki_key string, lk_wiki_label string, lk_language string")


def _run(spark, tmp_dir, config=CFG):
    paths = WarehousePaths(f"{tmp_dir}/wh")
    query = start_pipeline(spark, text_stream(spark, f"{tmp_dir}/in", 1), lambda: _lookup(spark), paths, f"{tmp_dir}/ck", "s", config, available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    return query, paths


def _totals(spark, paths):
    return sorted((r["window_end"].minute, r["edit_count"]) for r in current_totals(spark, paths).collect())


# ---- repeated messages ----------------------------------------------------------

def test_repeats_count_once_and_rows_without_a_key_stay(spark, tmp_dir):
    config = CFG.with_(drop_repeats=True)
    _put(f"{tmp_dir}/in", 0, [_event(0, "a"), _event(1, "b"), _event(1, "b"), _event(2), _event(2)])
    _put(f"{tmp_dir}/in", 1, [_event(0, "a"), _event(2), _event(3, "c"), _event(70, "a2")])
    _run(spark, tmp_dir, config)
    _put(f"{tmp_dir}/in", 2, [_event(1, "b"), _event(70, "a2"), _event(500, "end")])  # after a restart
    _put(f"{tmp_dir}/in", 3, [_event(0, "a"), _event(500, "end")])  # the first is late by now
    _, paths = _run(spark, tmp_dir, config)
    assert _totals(spark, paths) == [(15, 6), (16, 1)]  # a, b, c and three without a key


def test_without_the_setting_repeats_count_twice(spark, tmp_dir):
    _put(f"{tmp_dir}/in", 0, [_event(0, "a"), _event(0, "a")])
    _put(f"{tmp_dir}/in", 1, [_event(500, "end")])
    _, paths = _run(spark, tmp_dir)
    assert _totals(spark, paths) == [(15, 2)]


def test_static_input_keeps_each_key_once(spark):
    rows = raw_df(spark, [_event(0, "a"), _event(9000, "a"), _event(1), _event(1), "not json", None])
    assert once_per_message(rows, CFG).count() == 3


# ---- open windows ----------------------------------------------------------------

def test_flush_and_restart_neither_repeat_nor_lose(spark, tmp_dir):
    _put(f"{tmp_dir}/in", 0, [_event(0), _event(61)])
    query, paths = _run(spark, tmp_dir)
    assert open_windows(spark, f"{tmp_dir}/ck").count() == 2
    assert flush_open_windows(spark, f"{tmp_dir}/ck", _lookup(spark), paths, "s", CFG) == 2
    assert _totals(spark, paths) == [(15, 1), (16, 1)]
    _put(f"{tmp_dir}/in", 1, [_event(62), _event(100), _event(130)])
    _run(spark, tmp_dir)
    flush_open_windows(spark, f"{tmp_dir}/ck", _lookup(spark), paths, "s", CFG)
    flush_open_windows(spark, f"{tmp_dir}/ck", _lookup(spark), paths, "s", CFG)  # twice is once
    assert _totals(spark, paths) == [(15, 1), (16, 3), (17, 1)]
    _put(f"{tmp_dir}/in", 2, [_event(131), _event(1000)])
    _run(spark, tmp_dir)
    assert _totals(spark, paths)[:3] == [(15, 1), (16, 3), (17, 2)]  # closed with the later event
    flush_open_windows(spark, f"{tmp_dir}/ck", _lookup(spark), paths, "s", CFG)
    assert _totals(spark, paths) == [(15, 1), (16, 3), (17, 2), (31, 1)]
    labels = {(r["wiki_label"], r["language"], r["event_type"]) for r in current_actions(spark, paths).collect()}
    assert labels == {("English", "en", "edit")}


def test_flush_with_deduplication_reads_the_aggregate_only(spark, tmp_dir):
    _put(f"{tmp_dir}/in", 0, [_event(0, "a"), _event(0, "a"), _event(5)])
    _, paths = _run(spark, tmp_dir, CFG.with_(drop_repeats=True))
    rows = open_windows(spark, f"{tmp_dir}/ck").collect()
    assert [(r["wiki"], r["event_count"], r["bot_count"], r["minor_count"]) for r in rows] == [("enwiki", 2, 0, 0)]


def test_nothing_open_writes_nothing(spark, tmp_dir):
    _put(f"{tmp_dir}/in", 0, ["not json"])
    _, paths = _run(spark, tmp_dir)
    assert flush_open_windows(spark, f"{tmp_dir}/ck", _lookup(spark), paths, "s", CFG) == 0


# ---- late rows --------------------------------------------------------------------

def _split(spark, tmp_dir):
    query = start_late_split(spark, text_stream(spark, f"{tmp_dir}/in", 1), f"{tmp_dir}/late", f"{tmp_dir}/ck-late", CFG, available_now=True)
    query.awaitTermination()
    assert query.exception() is None


def test_late_and_on_time_are_all(spark, tmp_dir):
    """The first batch reaches 500, so the watermark is 380: windows that end at or before it are late."""
    batches = [[0, 500], [319, 320, 379, 380, 5], [], [10, 900], [700, 719, 720, 780]]
    for at, offsets in enumerate(batches):
        _put(f"{tmp_dir}/in", at, [_event(o) for o in offsets] or ["not json"])
        if at == 1:
            _split(spark, tmp_dir)  # and a restart for the rest
    _split(spark, tmp_dir)
    late = sorted(json.loads(r["raw"])["timestamp"] - BASE for r in late_rows(spark, f"{tmp_dir}/late").collect())
    assert late == [5, 10, 319, 320, 700, 719, 720]
    assert all(r["window_end"] <= r["watermark"] for r in late_rows(spark, f"{tmp_dir}/late").collect())
    counts = {r["batch_id"]: (r["on_time"], r["late"]) for r in late_counts(spark, f"{tmp_dir}/late").collect()}
    assert sum(a + b for a, b in counts.values()) == sum(map(len, batches)) and sum(b for _, b in counts.values()) == len(late)


def test_repeated_batch_is_judged_as_before(spark, tmp_dir):
    write = split_batch(tmp_dir, CFG)
    parsed = [parse_events(raw_df(spark, [_event(o) for o in offsets]), config=CFG, keep=("raw",)) for offsets in ([500], [0, 600], [10])]
    for at in (0, 1, 1, 2, 1):
        write(parsed[at], at)
    assert {(r["batch_id"], r["on_time"], r["late"]) for r in late_counts(spark, tmp_dir).collect()} == {(0, 1, 0), (1, 1, 1), (2, 0, 1)}


# ---- what the parse drops ------------------------------------------------------------

DROPS = {
    _event(0): None, _event(0, wiki=None): "no_wiki", "not json": "malformed", "": "malformed", "[1]": "malformed", "null": "malformed",
    '{"wiki": "a"': "malformed", '{"wiki": "a"}': "no_timestamp", '{"wiki": "a", "timestamp": "x"}': "no_timestamp", "{}": "no_wiki",
    '{"wiki": "a", "timestamp": 1e300}': "bad_time", '{"wiki": "a", "timestamp": 5, "bot": "x"}': None, ' {"wiki": "", "timestamp": 5}': None,
}


def test_reasons_and_kept_rows(spark):
    rows = raw_df(spark, [*DROPS, None])
    flagged = {r["raw"]: r["drop_reason"] for r in flag_events(rows).collect()}
    assert flagged == {**DROPS, None: "malformed"}
    kept = parse_events(rows, config=CFG, keep=("raw",))
    assert {r["raw"] for r in kept.collect()} == {k for k, v in DROPS.items() if v is None}
    observed = parse_events(rows, config=CFG, keep=("raw",), observe="parse")
    assert sorted(observed.collect()) == sorted(kept.collect())


def test_batch_and_stream_count_alike(spark, tmp_dir):
    lines = [k for k in DROPS if k]
    for at in range(3):
        _put(f"{tmp_dir}/in", at, lines)
    query, _ = _run(spark, tmp_dir)
    streamed = sum_drops(parse_drops(p) for p in query.recentProgress)
    batch = flag_events(raw_df(spark, lines * 3)).agg(*drop_counts()).first().asDict()
    assert streamed == batch and batch["rows"] == 3 * len(lines)


def test_heartbeat_names_drops(spark):
    from types import SimpleNamespace

    class Row:
        def asDict(self):
            return {"rows": 10, "malformed": 2, "no_wiki": 0}

    recorder = ProgressRecorder()
    for batch in range(2):
        progress = SimpleNamespace(id="q", name="n", batchId=batch, timestamp="t", numInputRows=10, inputRowsPerSecond=1.0,
                                   processedRowsPerSecond=1.0, eventTime={}, stateOperators=[], observedMetrics={"parse": Row()})
        recorder.onQueryProgress(SimpleNamespace(progress=progress))
    assert recorder.drops("q") == {"rows": 20, "malformed": 4, "no_wiki": 0}
    assert " malformed=4 batches=2" in heartbeat(recorder, "q")
