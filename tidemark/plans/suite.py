"""Registered queries over the given tables (one per operator of the inventory).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` table (or data Spark derives from it).  Inputs of the job that the
given tables lack -- raw JSON events, feed lines, a lookup dimension -- are
derived with built-in expressions (``sources.synthetic``): 1-day windows and
a burst threshold of 15 suit the sparse test events.  Timestamps leave as
``yyyy-MM-dd HH:mm:ss`` text so results compare exactly across engines.
"""

from __future__ import annotations

import functools
import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..config import DEFAULT, PipelineConfig
from ..functions.keys import with_message_key
from ..functions.parse import minor_flag, parse_events, parsed_columns
from ..schemas import ACTIONS_COLUMNS, LOOKUP_HEADER, RAW_EVENT_SCHEMA, TOTALS_COLUMNS
from ..functions.timefmt import WINDOW_END_FORMAT, partition_columns
from ..operators.checks import contract_violations, lookup_dup_keys
from ..operators.current import current_view
from ..operators.enrich import enrich, prepare_lookup
from ..operators.rollups import actions_rollup, totals_from_actions, totals_rollup
from ..session import checkpoint_root, scratch_path, utc_session
from ..sinks.delivered import deliver_stream, delivered
from ..sinks.delivery import deliverable, delivery_actions
from ..sinks.kafka import write_files
from ..sinks.partition_stats import estimates
from ..sinks.warehouse import read_rollup, write_batch
from ..sources import synthetic
from ..sources.feed import clean_feed
from ..sources.files import events_stream, events_table_stream, text_stream
from ..sources.lookup import dedupe_lookup, ensure_lookup_readable, lookup_from_tables, read_lookup_csv
from ..sources.segments import land_segments, segment_stream
from ..sources.tables import spread, table
from . import newest, reports
from .crashing import CRASH, CrashingSink
from .backfill import WarehousePaths, current_actions, current_totals, run_backfill

# Fixed parameters of the registered queries.
# The shuffle width is configured for the small test events (it is fixed into a streaming checkpoint).
QUERY_CONFIG = DEFAULT.with_(window="1 day", burst_threshold=15, shuffle_partitions=8)
UPDATED_AFTER = "INTERVAL 2 MINUTES"  # updated_at = window_end + 2 minutes
LOOKBACK_MINUTES = 10_080
FALLBACK_SHIFT = "INTERVAL 30 DAYS"    # as_of beyond every window: look-back empty
STALENESS_SHIFT = "INTERVAL 1 HOUR"

#: Tasks to deal the one-file events input to; unset leaves its own splits (the cluster's case).
INPUT_PARTITIONS = int(os.environ.get("TIDEMARK_INPUT_PARTITIONS") or 0) or None

QueryFn = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs ------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events"), INPUT_PARTITIONS)


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as loaded (de-duplicated and size-checked by ``enrich``)."""
    return lookup_from_tables(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def _parsed(spark: SparkSession, sf_dir: str, config: PipelineConfig = QUERY_CONFIG) -> DataFrame:
    return parse_events(synthetic.raw_events(_events(spark, sf_dir), keep_id=False), config=config)


def _text(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamp columns -> fixed-format text (compare-friendly)."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.date_format(F.col(c), WINDOW_END_FORMAT))
    return df


def _all_ts_text(df: DataFrame) -> DataFrame:
    return _text(df, *[f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)])


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current view of the stored totals, as the reports read it."""
    return current_totals(spark, _stored(spark, sf_dir)).select(*TOTALS_COLUMNS, "updated_at", "ds")


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_actions(spark, _stored(spark, sf_dir)).select(*ACTIONS_COLUMNS, "updated_at", "ds")


def _total_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored versions of the totals."""
    return read_rollup(spark, _stored(spark, sf_dir).totals, "totals")


def _materialised(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Reports that run several actions over one rollup (values to pivot on,
    emptiness checks) read it from a reliable checkpoint in the shared folder
    instead of re-deriving it from the whole input each time."""
    checkpoint_root(spark)
    return df.checkpoint(eager=True)


def _shown(df: DataFrame) -> DataFrame:
    """A report's rows without the partition column that only prunes."""
    return _all_ts_text(df.drop("ds"))


def _max_window(df: DataFrame) -> Column:
    return df.agg(F.max("window_end")).scalar()


# ---- sources / parsing ----------------------------------------------------------

def q_event_parse(spark, sf_dir):
    raw = synthetic.raw_events(_events(spark, sf_dir))
    fields = parsed_columns(raw, "raw", keep=("event_id",), schema=RAW_EVENT_SCHEMA)
    return fields.select(
        "event_id", "wiki", "type", F.coalesce(F.col("bot"), F.lit(False)).alias("bot"),
        F.col("timestamp").alias("event_unix_ts"),
    )


def q_minor_flag(spark, sf_dir):
    raw = synthetic.raw_events(_events(spark, sf_dir))
    return raw.select("event_id", minor_flag("raw").alias("is_minor"))


def _perturbed_raw(events: DataFrame) -> DataFrame:
    """Raw events with missing wiki, string timestamps, junk text and
    out-of-range epochs (fixed rules: event_id % 6, % 10, % 14, % 97)."""
    base = synthetic.event_struct(events)
    eid = F.col("event_id")
    ts = base.getField("timestamp")
    st = base.withField("timestamp", F.when(eid % 97 == 0, ts * F.lit(1_000_000.0)).otherwise(ts))
    st = st.withField("wiki", F.when(eid % 6 == 0, F.lit(None).cast("string")).otherwise(st.getField("wiki")))
    as_text = st.withField("timestamp", st.getField("timestamp").cast("string"))
    raw = (
        F.when(eid % 14 == 0, F.lit("not json"))
        .when(eid % 10 == 0, F.to_json(as_text))
        .otherwise(F.to_json(st))
    )
    return events.select("event_id", raw.alias("raw"))


def q_required_fields(spark, sf_dir):
    parsed = parse_events(_perturbed_raw(_events(spark, sf_dir)), config=QUERY_CONFIG, keep=("event_id",))
    return _text(parsed.select("event_id", "wiki", "event_ts"), "event_ts")


def q_epoch_normalise(spark, sf_dir):
    parsed = parse_events(_perturbed_raw(_events(spark, sf_dir)), config=QUERY_CONFIG, keep=("event_id",))
    return _text(parsed.select("event_id", "event_unix_ts", "event_unix_sec", "event_ts"), "event_ts")


def q_type_normalise(spark, sf_dir):
    ev = _events(spark, sf_dir)
    eid = F.col("event_id")
    type_col = (
        F.when(eid % 17 == 0, F.rpad(F.concat(F.col("event_type"), F.lit("-")), 80, "x"))
        .when(eid % 8 == 0, F.lit(None).cast("string"))
        .when(eid % 6 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.col("event_type")))
    )
    raw = synthetic.raw_events_with_type(ev, type_col)
    parsed = parse_events(raw, config=QUERY_CONFIG, keep=("event_id",))
    return parsed.select("event_id", "event_type")


def q_partition_cols(spark, sf_dir):
    hourly_config = QUERY_CONFIG.with_(window="1 hour")
    hourly = totals_rollup(_parsed(spark, sf_dir, hourly_config), _lookup(spark, sf_dir), hourly_config)
    parts = partition_columns("window_end")
    return hourly.select(
        parts["window_end_ts"].alias("window_end_ts"), parts["ds"].alias("ds"), parts["hr"].alias("hr"),
        "wiki", "edit_count",
    )


def q_message_key(spark, sf_dir):
    raw = synthetic.raw_events(_events(spark, sf_dir))
    return with_message_key(raw).select("event_id", "message_key")


def q_feed_clean(spark, sf_dir):
    lines = synthetic.feed_lines(_events(spark, sf_dir))
    return clean_feed(lines).select("event_id", "accepted", "reject_reason")


def q_message_key_forms(spark, sf_dir):
    """P18 on ids of every JSON form: numbers keep their digits, so distinct ids keep distinct keys."""
    return with_message_key(synthetic.id_forms(_events(spark, sf_dir))).select("event_id", "message_key")


def q_lookup_dim(spark, sf_dir):
    return dedupe_lookup(_lookup(spark, sf_dir))


def q_lookup_dup_keys(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    doubled = nation.unionByName(nation.filter(F.col("n_nationkey") < 3))
    return lookup_dup_keys(lookup_from_tables(doubled, table(spark, sf_dir, "region")))


# ---- join / aggregations -------------------------------------------------------------

def q_enrich_join(spark, sf_dir):
    raw = synthetic.raw_events(_events(spark, sf_dir))
    parsed = parse_events(raw, config=QUERY_CONFIG, keep=("event_id",))
    return enrich(parsed, _lookup(spark, sf_dir)).select("event_id", "wiki", "wiki_label", "language")


def q_totals_rollup(spark, sf_dir):
    return _text(totals_rollup(_parsed(spark, sf_dir), _lookup(spark, sf_dir), QUERY_CONFIG), "window_end")


def q_actions_rollup(spark, sf_dir):
    return _text(actions_rollup(_parsed(spark, sf_dir), _lookup(spark, sf_dir), QUERY_CONFIG), "window_end")


def q_totals_from_actions(spark, sf_dir):
    actions = actions_rollup(_parsed(spark, sf_dir), _lookup(spark, sf_dir), QUERY_CONFIG)
    return _text(totals_from_actions(actions, QUERY_CONFIG), "window_end")


def q_contract_violations(spark, sf_dir):
    actions = actions_rollup(_parsed(spark, sf_dir), _lookup(spark, sf_dir), QUERY_CONFIG)
    return contract_violations(actions, QUERY_CONFIG.with_(max_wiki_len=1, max_event_type_len=5))


# ---- sinks and the warehouse ----------------------------------------------------------

def _upsert_versions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Batch 0 = rollup of even event_id only (written twice: a retry),
    batch 1 = rollup of all events; then the current view."""
    ev = _events(spark, sf_dir)
    lookup = prepare_lookup(_lookup(spark, sf_dir))
    build = totals_rollup if kind == "totals" else actions_rollup

    def rollup(events: DataFrame) -> DataFrame:
        parsed = parse_events(synthetic.raw_events(events, keep_id=False), config=QUERY_CONFIG)
        return build(parsed, lookup, QUERY_CONFIG, lookup_checked=True)

    path = scratch_path(spark, "upsert", kind)
    run_id = "r0"
    even = _materialised(spark, rollup(ev.filter(F.col("event_id") % 2 == 0)))  # written twice
    for batch_id, frame in ((0, even), (0, even), (1, rollup(ev))):
        stamp = F.col("window_end") + F.expr(f"INTERVAL {2 + batch_id} MINUTES")
        write_batch(frame, path, run_id, batch_id, updated_at=stamp)
    view = current_view(read_rollup(spark, path, kind))
    return _all_ts_text(view.drop("window_end_ts", "ds", "hr", "run_id"))


def q_current_incremental(spark, sf_dir):
    """K2 / K3: three batches merged into the current table: the older half of the time range, all events, and a late
    batch of older versions for the first days, which changes nothing there."""
    from ..sinks.current_table import create_current_table, merge_batch
    from ..sources.warehouse import drop_table

    path, name = scratch_path(spark, "current"), f"tidemark_current_{uuid.uuid4().hex[:10]}"
    lookup = prepare_lookup(_lookup(spark, sf_dir))
    events = _events(spark, sf_dir)
    micros = synthetic.epoch_micros(events)
    half = micros < events.agg(F.percentile_approx(micros, 0.5)).scalar()
    create_current_table(spark, name, path, "totals")
    try:
        for batch_id, (keep, minutes) in enumerate(((half, 2), (F.lit(True), 4), (half & (F.col("event_id") % 2 == 0), 3))):
            parsed = parse_events(synthetic.raw_events(events.where(keep), keep_id=False), config=QUERY_CONFIG)
            rollup = totals_rollup(parsed, lookup, QUERY_CONFIG, lookup_checked=True)
            write_batch(rollup, f"{path}/versions", "r0", batch_id, updated_at=F.col("window_end") + F.expr(f"INTERVAL {minutes} MINUTES"))
            versions = read_rollup(spark, f"{path}/versions", "totals").where(F.col("batch_id") == batch_id)
            merge_batch(spark, name, path, versions)
        return _materialised(spark, _all_ts_text(spark.table(name).select(*TOTALS_COLUMNS, "updated_at", "batch_id")))
    finally:
        drop_table(spark, name)


def _stored(spark: SparkSession, sf_dir: str) -> WarehousePaths:
    """The warehouse the reports read: an early batch over the even events, superseded by one over all.

    It is built once per application and input (its files and their times) and then only read,
    as reports do.
    """
    files = table(spark, sf_dir, "events").select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    key = (spark.sparkContext.applicationId, *sorted(str(tuple(r)) for r in files.collect()))
    if key not in _STORED:
        paths = WarehousePaths(scratch_path(spark, "stored"))
        lookup = prepare_lookup(_lookup(spark, sf_dir))
        for batch_id, keep in ((0, F.col("event_id") % 2 == 0), (1, F.lit(True))):
            raw = synthetic.raw_events(_events(spark, sf_dir).filter(keep), keep_id=False)
            stamp = F.col("window_end") + F.expr(f"INTERVAL {1 + batch_id} MINUTES")
            config = QUERY_CONFIG.with_(partition_stats=True)
            run_backfill(spark, raw, lookup, paths, "stored", config, batch_id=batch_id, updated_at=stamp)
        _STORED[key] = paths
    return _STORED[key]


_STORED: dict[tuple, WarehousePaths] = {}


def q_upsert_latest_totals(spark, sf_dir):
    return _upsert_versions(spark, sf_dir, "totals")


def q_upsert_latest_actions(spark, sf_dir):
    return _upsert_versions(spark, sf_dir, "actions")


def _backfilled(spark: SparkSession, sf_dir: str) -> WarehousePaths:
    paths = WarehousePaths(scratch_path(spark, "backfill"))
    raw = synthetic.raw_events(_events(spark, sf_dir), keep_id=False)
    stamp = F.col("window_end") + F.expr(UPDATED_AFTER)
    return run_backfill(spark, raw, _lookup(spark, sf_dir), paths, "all-events", QUERY_CONFIG, updated_at=stamp)


def q_backfill_totals(spark, sf_dir):
    return _totals_out(current_totals(spark, _backfilled(spark, sf_dir)))


def q_backfill_actions(spark, sf_dir):
    return _actions_out(current_actions(spark, _backfilled(spark, sf_dir)))


def q_warehouse_scan(spark, sf_dir):
    """The warehouse registered as a partitioned catalog table and scanned."""
    paths = _backfilled(spark, sf_dir)
    name = f"tidemark_wh_{uuid.uuid4().hex[:10]}"
    from ..sources.warehouse import drop_table, register_totals_table

    register_totals_table(spark, name, paths.totals)
    try:
        rows = spark.table(name).select(
            "window_end_ts", "wiki", "wiki_label", "edit_count", "bot_count", "human_count", "language",
            "anomaly_flag", "ds", "hr",
        )
        return _materialised(spark, rows)
    finally:
        drop_table(spark, name)


def _streamed(spark: SparkSession, sf_dir: str, raw: DataFrame, paths: WarehousePaths, config: PipelineConfig = QUERY_CONFIG):
    """Run the streaming job on ``raw`` to the end of its input; the ended query."""
    from ..streaming.rollup_stream import start_pipeline

    query = start_pipeline(
        spark, raw, lambda: _lookup(spark, sf_dir), paths, f"{paths.root}/_checkpoint", run_id="stream",
        config=config, available_now=True,
    )
    return _ended(query)


def _ended(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def q_parse_drops(spark, sf_dir):
    """ST10 / P5 / P8: the streaming job's rows read and rows dropped by reason, from its progress events."""
    from ..streaming.monitor import parse_drops, sum_drops

    paths = WarehousePaths(scratch_path(spark, "stream"))
    query = _streamed(spark, sf_dir, _perturbed_raw(events_table_stream(spark, sf_dir)).select("raw"), paths)
    drops = sum_drops(parse_drops(progress) for progress in query.recentProgress)
    return spark.createDataFrame(sorted(drops.items()), "reason string, n long")


def _totals_out(view: DataFrame) -> DataFrame:
    return _text(view.select(*TOTALS_COLUMNS), "window_end")


def _actions_out(view: DataFrame) -> DataFrame:
    return _text(view.select(*ACTIONS_COLUMNS), "window_end")


def q_stream_totals(spark, sf_dir):
    """ST1-ST9: the streaming job run to completion (availableNow) over the
    events file, then its totals table read back through the current view."""
    paths = WarehousePaths(scratch_path(spark, "stream"))
    _streamed(spark, sf_dir, events_stream(spark, sf_dir), paths)
    return _totals_out(current_totals(spark, paths))


def q_stream_actions(spark, sf_dir):
    """The same run's actions table."""
    paths = WarehousePaths(scratch_path(spark, "stream"))
    _streamed(spark, sf_dir, events_stream(spark, sf_dir), paths)
    return _actions_out(current_actions(spark, paths))


def _event_files(spark: SparkSession, sf_dir: str, folder: str, first: int, last: int) -> str:
    """The raw events as text files of a stream, one folder per part and one file in each.

    Part 0 has the first half of the time range, part 1 the second half, part 2 the late rows:
    every seventh event of the first half, which part 0 leaves out.  Parts ``first`` to ``last`` are
    written, each after the one before, so the file source takes them in this order.
    """
    events = table(spark, sf_dir, "events")
    seconds = F.floor(synthetic.epoch_micros(events) / 1_000_000)
    bounds = events.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi")).first()
    early = seconds < (bounds["lo"] + bounds["hi"]) // 2
    late = early & (F.col("event_id") % 7 == 0)
    parts = (early & ~late, ~early, late)
    for at in range(first, last + 1):
        part = synthetic.raw_events(events.filter(parts[at]), keep_id=False)
        part.coalesce(1).write.mode("overwrite").text(f"{folder}/part={at}")
        time.sleep(1.1)  # the file source orders files by modification time, which counts in seconds on some stores
    return folder


def _text_parts(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", "1").schema("value string")
    return reader.text(folder).select(F.col("value").alias("raw"))


def q_stream_multi_batch(spark, sf_dir):
    """ST4: three files, one per trigger; rows of the third in windows that the first file's watermark closed are dropped."""
    paths = WarehousePaths(scratch_path(spark, "stream"))
    folder = _event_files(spark, sf_dir, f"{paths.root}/_input", 0, 2)
    _streamed(spark, sf_dir, _text_parts(spark, folder), paths)
    return _totals_out(current_totals(spark, paths))


def q_stream_restart(spark, sf_dir):
    """ST6: stopped after the first file and started again on the same checkpoint with the second."""
    paths = WarehousePaths(scratch_path(spark, "stream"))
    for at in (0, 1):
        folder = _event_files(spark, sf_dir, f"{paths.root}/_input", at, at)
        _streamed(spark, sf_dir, _text_parts(spark, folder), paths)
    return _totals_out(current_totals(spark, paths))


def _flushed(spark: SparkSession, sf_dir: str, paths: WarehousePaths, config: PipelineConfig = QUERY_CONFIG) -> None:
    from ..streaming.flush import flush_open_windows

    flush_open_windows(spark, f"{paths.root}/_checkpoint", _lookup(spark, sf_dir), paths, "stream", config)


def q_stream_flushed(spark, sf_dir):
    """ST3 / S2: the two halves of the time range in two starts, the open windows flushed after each: every window is there once."""
    paths = WarehousePaths(scratch_path(spark, "stream"))
    events = table(spark, sf_dir, "events")
    early = synthetic.epoch_micros(events) < events.agg(F.percentile_approx(synthetic.epoch_micros(events), 0.5)).scalar()
    for at, half in enumerate((early, ~early)):
        synthetic.raw_events(events.where(half), keep_id=False).write.text(f"{paths.root}/_input/part={at}")
        _streamed(spark, sf_dir, text_stream(spark, f"{paths.root}/_input"), paths)
        _flushed(spark, sf_dir, paths)
    return _totals_out(current_totals(spark, paths))


def q_stream_dedup(spark, sf_dir):
    """Every seventh message comes again in a later batch and counts once; messages without a key all stay.

    Every 50th event has lost its ids, so its second copy counts.  The delay spans the whole time range: no copy is late.
    """
    paths = WarehousePaths(scratch_path(spark, "stream"))
    config = QUERY_CONFIG.with_(drop_repeats=True, watermark="400 days")
    events = table(spark, sf_dir, "events")
    raw = synthetic.raw_events_some_without_key(events)
    for at, part in enumerate((raw, raw.where(F.col("event_id") % 7 == 0))):
        part.select("raw").write.text(f"{paths.root}/_input/part={at}")
        _streamed(spark, sf_dir, text_stream(spark, f"{paths.root}/_input"), paths, config)
    _flushed(spark, sf_dir, paths, config)
    return _totals_out(current_totals(spark, paths))


def q_stream_late_rows(spark, sf_dir):
    """ST4 / ST10: the events that come after their window closed, each with its window and the watermark it missed."""
    from ..streaming.late_rows import late_rows, start_late_split

    path = scratch_path(spark, "late")
    folder = _event_files(spark, sf_dir, f"{path}/_input", 0, 2)
    _ended(start_late_split(spark, _text_parts(spark, folder), path, f"{path}/_checkpoint", QUERY_CONFIG, available_now=True))
    rows = late_rows(spark, path).withColumn("event_id", F.get_json_object("raw", "$.id").cast("bigint"))
    return _all_ts_text(rows.select("event_id", "wiki", "event_type", "window_end", "watermark", F.col("batch_id").cast("bigint").alias("batch_id")))


def _landed(spark: SparkSession, sf_dir: str, path: str) -> tuple[str, int]:
    """The raw events landed as a log of three partitions (event_id modulo 3), and a cap that gives some four batches."""
    events = table(spark, sf_dir, "events")
    rows = synthetic.raw_events(events).select(
        (F.col("event_id") % 3).cast("int").alias("log_partition"), F.floor(F.col("event_id") / 3).cast("long").alias("log_offset"),
        F.col("raw").alias("value"),
    )
    landed = land_segments(rows, f"{path}/log", segment_rows=1000).agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    return f"{path}/log", max(1, -(-landed // 4))


def _logged(stream: DataFrame) -> DataFrame:
    """Landed messages with their key and event id."""
    keyed = with_message_key(stream.withColumnRenamed("value", "raw"))
    return keyed.select("log_partition", "log_offset", "message_key", F.get_json_object("raw", "$.id").cast("bigint").alias("event_id"))


_LOGGED = "log_partition int, log_offset long, message_key string, event_id long"


def q_segment_replay(spark, sf_dir):
    """Landed segments read to their end, a quarter of all offsets at a time: from the earliest offset, and from given ones."""
    path = scratch_path(spark, "segments")
    log, cap = _landed(spark, sf_dir, path)
    for run, start in (("earliest", "earliest"), ("offsets", json.dumps({"0": 700, "1": 40}))):
        stream = segment_stream(spark, log, startingOffsets=start, maxOffsetsPerTrigger=cap, positionPath=f"{path}/position-{run}")
        query = deliver_stream(_logged(stream), f"{path}/out", f"{path}/checkpoint-{run}", run)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    rows = delivered(spark, f"{path}/out", _LOGGED)
    return rows.select(F.col("run_id").alias("run"), "log_partition", "log_offset", "event_id")


def q_delivered_once(spark, sf_dir):
    """K6 / K7: batch 1 fails once after it became visible, batch 2 once before; each message is delivered once."""
    path = scratch_path(spark, "delivered")
    log, cap = _landed(spark, sf_dir, path)
    for _ in range(3):  # two starts end with the failure
        stream = segment_stream(spark, log, maxOffsetsPerTrigger=cap, positionPath=f"{path}/position")
        query = deliver_stream(_logged(stream), f"{path}/out", f"{path}/checkpoint", "run", CrashingSink, after=1, before=2, marks=f"{path}/marks")
        try:
            query.processAllAvailable()
        except StreamingQueryException as failed:
            if CRASH not in str(failed):
                raise
        finally:
            query.stop()
    rows = delivered(spark, f"{path}/out", _LOGGED)
    return rows.groupBy("event_id", "message_key").agg(F.count("*").alias("n"))


def q_backfill_two_inputs(spark, sf_dir):
    """Two backfills over inputs that share hours but no wiki; both stay."""
    paths = WarehousePaths(scratch_path(spark, "backfill"))
    stamp = F.col("window_end") + F.expr(UPDATED_AFTER)
    for run_id, half in (("low", F.col("user_id") % 40 < 20), ("high", F.col("user_id") % 40 >= 20)):
        raw = synthetic.raw_events(_events(spark, sf_dir).filter(half), keep_id=False)
        run_backfill(spark, raw, _lookup(spark, sf_dir), paths, run_id, QUERY_CONFIG, updated_at=stamp)
    return _totals_out(current_totals(spark, paths))


def q_contract_kept_rows(spark, sf_dir):
    """K5: wiki '3' has a label of 600 characters; its rows stay in the warehouse and are listed beside it."""
    paths = WarehousePaths(scratch_path(spark, "backfill"))
    label = F.when(F.col("lk_wiki_key") == "3", F.rpad("lk_wiki_label", 600, "x")).otherwise(F.col("lk_wiki_label"))
    lookup = _lookup(spark, sf_dir).withColumn("lk_wiki_label", label)
    raw = synthetic.raw_events(_events(spark, sf_dir), keep_id=False)
    run_backfill(spark, raw, lookup, paths, "long-label", QUERY_CONFIG,
                 updated_at=F.col("window_end") + F.expr(UPDATED_AFTER))
    listed = spark.read.parquet(paths.violations).groupBy("window_end", "wiki").agg(F.min("contract_reason").alias("rule"))
    totals = current_totals(spark, paths).join(listed, ["window_end", "wiki"], "left")
    return _text(totals.select("window_end", "wiki", F.char_length("wiki_label").alias("label_length"),
                               "edit_count", "rule"), "window_end")


def q_delivery_actions(spark, sf_dir):
    """Types with white space around them and types that are equal once clipped, delivered as one key."""
    eid = F.col("event_id")
    odd = (
        F.when(eid % 5 == 1, F.concat(F.col("event_type"), F.lit("\n")))
        .when(eid % 5 == 2, F.lit("\t"))
        .when(eid % 5 == 3, F.concat(F.rpad("event_type", 64, "x"), (eid % 3).cast("string")))
        .when(eid % 5 == 4, F.concat(F.lit("\u3000"), F.col("event_type")))
        .otherwise(F.col("event_type"))
    )
    raw = synthetic.raw_events_with_type(_events(spark, sf_dir), odd)
    actions = actions_rollup(parse_events(raw, config=QUERY_CONFIG), _lookup(spark, sf_dir), QUERY_CONFIG)
    rows, _ = deliverable(delivery_actions(actions, QUERY_CONFIG), QUERY_CONFIG)
    return _text(rows, "window_end")


def q_publish_payload(spark, sf_dir):
    """K6: keys and values as they would be published, and the rejects with their reason."""
    path = scratch_path(spark, "publish")
    lines = synthetic.feed_lines(_events(spark, sf_dir))
    write_files(lines.select("event", "data"), f"{path}/messages", f"{path}/rejects")
    value = F.col("value").cast("string")
    messages = spark.read.parquet(f"{path}/messages").select(
        F.col("key").cast("string").alias("message_key"),
        F.regexp_extract(value, r'.*"id":([0-9]+)', 1).cast("bigint").alias("value_id"),
        (value.startswith("{") & value.endswith("}")).alias("whole"),
    )
    sent = messages.groupBy(*messages.columns).agg(F.count("*").alias("n"))
    rejects = spark.read.parquet(f"{path}/rejects").groupBy("reject_reason").agg(F.count("*").alias("n"))
    return sent.unionByName(rejects, allowMissingColumns=True)


def q_lookup_csv(spark, sf_dir):
    """The dimension written as a CSV with its columns in another order, then read by header."""
    path = scratch_path(spark, "lookup")
    dim = _lookup(spark, sf_dir).select(*[F.col(ours).alias(name) for name, ours in reversed(LOOKUP_HEADER.items())])
    dim.write.csv(path, header=True)
    ensure_lookup_readable(spark, path)
    return read_lookup_csv(spark, path)


# ---- read-side reports ---------------------------------------------------------------

def q_table_stats(spark, sf_dir):
    return _shown(reports.table_stats(_total_versions(spark, sf_dir)))


def q_lookback_totals(spark, sf_dir):
    t = _totals(spark, sf_dir)
    return _shown(reports.in_order(reports.lookback(t, _max_window(_total_versions(spark, sf_dir)), LOOKBACK_MINUTES)))


def q_latest_totals(spark, sf_dir):
    rows = newest.latest_rows(spark, _stored(spark, sf_dir).totals, "totals", QUERY_CONFIG.latest_rows)
    return _shown(rows.select(*TOTALS_COLUMNS, "updated_at"))


def q_lookback_actions(spark, sf_dir):
    a = _actions(spark, sf_dir)
    return _shown(reports.in_order(reports.lookback(a, _max_window(_total_versions(spark, sf_dir)), LOOKBACK_MINUTES)))


def q_latest_actions(spark, sf_dir):
    rows = newest.latest_rows(spark, _stored(spark, sf_dir).actions, "actions", QUERY_CONFIG.latest_rows)
    return _shown(rows.select(*ACTIONS_COLUMNS, "updated_at"))


def _seven(spark: SparkSession, sf_dir: str, rows: DataFrame, shift: str) -> DataFrame:
    as_of = _max_window(_total_versions(spark, sf_dir)) + F.expr(shift)
    view, used_fallback = reports.lookback_or_latest(rows, as_of, LOOKBACK_MINUTES, QUERY_CONFIG.latest_rows)
    return _shown(view.withColumn("used_fallback", F.lit(used_fallback)))


def q_lookback_or_latest(spark, sf_dir):
    """Q7, the look-back empty: the latest rows."""
    return _seven(spark, sf_dir, _totals(spark, sf_dir), FALLBACK_SHIFT)


def q_lookback_present(spark, sf_dir):
    """Q7, the look-back not empty: its rows."""
    return _seven(spark, sf_dir, _totals(spark, sf_dir), "INTERVAL 0 DAYS")


def q_lookback_no_rows(spark, sf_dir):
    """Q7 over a view without rows (a wiki that no event has): nothing, and no fallback."""
    return _seven(spark, sf_dir, _totals(spark, sf_dir).filter(F.col("wiki") == "no such wiki"), "INTERVAL 0 DAYS")


def q_recent_rows(spark, sf_dir):
    rows = newest.recent_rows(spark, _stored(spark, sf_dir).totals, "totals", 150)
    return _shown(rows.select(*TOTALS_COLUMNS, "updated_at"))


def q_recent_actions(spark, sf_dir):
    rows = newest.recent_rows(spark, _stored(spark, sf_dir).actions, "actions", 200)
    return _shown(rows.select(*ACTIONS_COLUMNS, "updated_at"))


def q_row_estimate(spark, sf_dir):
    """Q2: the rows of the totals, not their versions, from the merged sketches of the stored batches."""
    return estimates(spark, _stored(spark, sf_dir).totals).select("estimated_rows")


def q_top_wikis(spark, sf_dir):
    return reports.top_wikis(_totals(spark, sf_dir), 15)


def q_bot_vs_human(spark, sf_dir):
    return reports.bot_vs_human(_totals(spark, sf_dir), 10)


def q_volume_pivot(spark, sf_dir):
    return _shown(reports.volume_pivot_long(_totals(spark, sf_dir), 6))


def q_burst_windows(spark, sf_dir):
    return _shown(reports.burst_windows(_totals(spark, sf_dir), 20))


def q_event_mix(spark, sf_dir):
    return _shown(reports.event_mix_long(_actions(spark, sf_dir)))


def q_type_totals(spark, sf_dir):
    return reports.type_totals(_actions(spark, sf_dir))


def q_minor_share(spark, sf_dir):
    # the test events have no 'edit' type: 'view' plays its part
    return _shown(reports.minor_share(_actions(spark, sf_dir), edit_type="view"))


def q_log_share(spark, sf_dir):
    # 'error' plays 'log' and 'view' plays 'edit'
    return reports.log_share(_actions(spark, sf_dir), log_type="error", edit_type="view", n=12)


def q_staleness(spark, sf_dir):
    t = _total_versions(spark, sf_dir)
    return _shown(reports.staleness(t, _max_window(t) + F.expr(STALENESS_SHIFT), QUERY_CONFIG.stale_minutes))


def q_view_last_update(spark, sf_dir):
    t = _totals(spark, sf_dir)
    return _shown(reports.view_last_update(reports.lookback(t, _max_window(_total_versions(spark, sf_dir)), LOOKBACK_MINUTES)))


def _in_utc(query: QueryFn) -> QueryFn:
    """The query on the caller's session, or on a sibling in UTC; the caller's settings stay."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(utc_session(spark, QUERY_CONFIG), sf_dir)

    return run


_ALL: dict[str, QueryFn] = {
    # sources, parsing, scalar functions
    "event_parse": q_event_parse,
    "minor_flag": q_minor_flag,
    "required_fields": q_required_fields,
    "epoch_normalise": q_epoch_normalise,
    "type_normalise": q_type_normalise,
    "partition_cols": q_partition_cols,
    "message_key": q_message_key,
    "message_key_forms": q_message_key_forms,
    "feed_clean": q_feed_clean,
    "publish_payload": q_publish_payload,
    "lookup_csv": q_lookup_csv,
    "lookup_dim": q_lookup_dim,
    "lookup_dup_keys": q_lookup_dup_keys,
    # join and aggregations
    "enrich_join": q_enrich_join,
    "totals_rollup": q_totals_rollup,
    "actions_rollup": q_actions_rollup,
    "totals_from_actions": q_totals_from_actions,
    "contract_violations": q_contract_violations,
    # sinks, warehouse, backfill, streaming
    "upsert_latest_totals": q_upsert_latest_totals,
    "upsert_latest_actions": q_upsert_latest_actions,
    "current_incremental": q_current_incremental,
    "backfill_totals": q_backfill_totals,
    "backfill_actions": q_backfill_actions,
    "warehouse_scan": q_warehouse_scan,
    "backfill_two_inputs": q_backfill_two_inputs,
    "contract_kept_rows": q_contract_kept_rows,
    "delivery_actions": q_delivery_actions,
    "stream_totals": q_stream_totals,
    "stream_actions": q_stream_actions,
    "stream_multi_batch": q_stream_multi_batch,
    "stream_restart": q_stream_restart,
    "stream_flushed": q_stream_flushed,
    "stream_dedup": q_stream_dedup,
    "stream_late_rows": q_stream_late_rows,
    "parse_drops": q_parse_drops,
    "segment_replay": q_segment_replay,
    "delivered_once": q_delivered_once,
    # read-side reports
    "table_stats": q_table_stats,
    "lookback_totals": q_lookback_totals,
    "latest_totals": q_latest_totals,
    "lookback_actions": q_lookback_actions,
    "latest_actions": q_latest_actions,
    "lookback_or_latest": q_lookback_or_latest,
    "lookback_present": q_lookback_present,
    "lookback_no_rows": q_lookback_no_rows,
    "recent_rows": q_recent_rows,
    "recent_actions": q_recent_actions,
    "row_estimate": q_row_estimate,
    "top_wikis": q_top_wikis,
    "bot_vs_human": q_bot_vs_human,
    "volume_pivot": q_volume_pivot,
    "burst_windows": q_burst_windows,
    "event_mix": q_event_mix,
    "type_totals": q_type_totals,
    "minor_share": q_minor_share,
    "log_share": q_log_share,
    "staleness": q_staleness,
    "view_last_update": q_view_last_update,
}

QUERIES: dict[str, QueryFn] = {name: _in_utc(query) for name, query in _ALL.items()}
