"""ST1-ST9: the streaming job.

One stateful query (the reference ran two, each reading and parsing the feed):

    raw -> parse/clean -> watermark -> window x wiki x event_type counts
        -> foreachBatch: enrich (broadcast, size-checked), write actions,
           derive totals from the written actions, write totals

In append mode every group of a window is evicted by the same watermark in
the same micro-batch, so each batch holds all action rows of each window it
closes and the derived totals are exact.  Both sinks are keyed by
``(run_id, batch_id)`` with dynamic partition overwrite, so a replayed batch
replaces its own output (exactly-once results on an at-least-once sink).

The number of shuffle partitions is fixed into the checkpoint at the first
run of a stateful query; size ``shuffle_partitions`` for the target cluster
before the first start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, PipelineConfig
from ..functions.parse import parse_events
from ..operators.enrich import enrich, prepare_lookup
from ..operators.rollups import aggregate_actions, finish_actions, totals_rollup_enriched
from ..plans.backfill import WarehousePaths, check_contract, write_rollups
from ..session import job_settings
from ..sinks.warehouse import write_batch
from .dedup import once_per_message
from .monitor import PARSE_METRICS

LATE_POLICY_CONF = "spark.sql.streaming.statefulOperator.allowMultiple"
QUERY_ID_PROPERTY = "sql.streaming.queryId"  # set by Spark on the micro-batch thread


def set_late_policy(spark: SparkSession, strict: bool) -> None:
    """ST4: strict=True filters late rows by the current batch's watermark
    (a row late by it is dropped); the default filters by the previous one."""
    spark.conf.set(LATE_POLICY_CONF, "false" if strict else "true")


def watermarked_events(raw_stream: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """ST1: parsed events with the event-time watermark; with ``drop_repeats`` each message once."""
    if config.drop_repeats:
        return once_per_message(raw_stream, config)
    return parse_events(raw_stream, config=config, observe=PARSE_METRICS).withWatermark("event_ts", config.watermark)


def windowed_actions(raw_stream: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """ST2: the single stateful aggregate (un-enriched action grain)."""
    return aggregate_actions(watermarked_events(raw_stream, config), config)


def batch_writer(
    spark: SparkSession,
    lookup_loader: Callable[[], DataFrame],
    paths: WarehousePaths,
    run_id: str | None,
    config: PipelineConfig = DEFAULT,
    lookup_version: Callable[[], object] | None = None,
) -> Callable[[DataFrame, int], None]:
    """ST8/ST9: per-batch multi-sink callback; skips empty batches.

    The lookup is re-read every batch, so edits to the dimension file show up
    without a restart.  With ``lookup_version`` (a cheap look at the file's
    time and length) it is measured and checked only when that changes.  Without an explicit ``run_id`` the streaming query's
    id is used: Spark keeps it in the checkpoint, so it is stable across
    restarts and new for a new checkpoint (whose batch ids restart at 0).
    """

    known: dict = {}

    def prepared() -> DataFrame:
        version = lookup_version() if lookup_version else None
        if version is None or known.get("version") != version:
            known.update(version=version, lookup=prepare_lookup(lookup_loader(), config.lookup_broadcast_max_rows))
        return known["lookup"]

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch = batch_df.persist()
        try:
            if batch.isEmpty():
                return
            run = run_id or batch_df.sparkSession.sparkContext.getLocalProperty(QUERY_ID_PROPERTY)
            if not run:
                raise RuntimeError("no run_id given and no streaming query id available")
            actions = finish_actions(enrich(batch, prepared(), checked=True))
            write_rollups(spark, actions, paths, run, batch_id, config)
        finally:
            batch.unpersist()

    return write


def start_pipeline(
    spark: SparkSession,
    raw_stream: DataFrame,
    lookup_loader: Callable[[], DataFrame],
    paths: WarehousePaths,
    checkpoint: str,
    run_id: str | None = None,
    config: PipelineConfig = DEFAULT,
    available_now: bool = False,
    query_name: str = "tidemark_rollups",
    lookup_version: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Start the one-query pipeline (ST3 append, ST5 trigger, ST6 checkpoint).

    ``run_id`` keys the sink partitions; it must be fixed for the life of
    ``checkpoint`` and new for a new checkpoint.  Leave it None to use the
    query id, which has exactly that lifetime.
    """
    writer = (
        windowed_actions(raw_stream, config)
        .writeStream.queryName(query_name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(spark, lookup_loader, paths, run_id, config, lookup_version))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=config.trigger)
    return _start_with_job_conf(spark, writer, config)


def _start_with_job_conf(spark: SparkSession, writer, config: PipelineConfig) -> StreamingQuery:
    """Start with the job's settings, without changing the caller's session: a
    query runs on a clone of the session taken at start.  The shuffle width is
    set only if configured (it is fixed into a new checkpoint)."""
    settings = dict(job_settings(config))
    if config.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(config.shuffle_partitions)
    if config.late_policy == "current":
        settings[LATE_POLICY_CONF] = "false"
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_two_queries(
    spark: SparkSession,
    raw_stream_factory: Callable[[], DataFrame],
    lookup: DataFrame,
    paths: WarehousePaths,
    checkpoint_root: str,
    run_id: str | None = None,
    config: PipelineConfig = DEFAULT,
    available_now: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """ST7 parity mode: two named queries as in the original job -- totals at
    the enriched grain (stream-static broadcast join before the aggregate) and
    actions -- each with its own checkpoint and source read."""
    checked = prepare_lookup(lookup, config.lookup_broadcast_max_rows)

    def enriched_stream() -> DataFrame:
        return enrich(watermarked_events(raw_stream_factory(), config), checked, checked=True)

    totals = totals_rollup_enriched(enriched_stream(), config)
    actions = finish_actions(aggregate_actions(enriched_stream(), config, ("wiki_label", "language")))

    def _run(df: DataFrame) -> str:
        return run_id or df.sparkSession.sparkContext.getLocalProperty(QUERY_ID_PROPERTY)

    def totals_sink(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            write_batch(df, paths.totals, _run(df), batch_id, write_partitions=config.write_partitions,
                        table=config.totals_table)

    def actions_sink(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            check_contract(df, paths, _run(df), batch_id, config)
            write_batch(df, paths.actions, _run(df), batch_id, write_partitions=config.write_partitions,
                        table=config.actions_table)

    queries = []
    for name, frame, sink in (("totals", totals, totals_sink), ("actions", actions, actions_sink)):
        w = (
            frame.writeStream.queryName(f"tidemark_{name}")
            .outputMode("append")
            .option("checkpointLocation", f"{checkpoint_root}/{name}")
            .foreachBatch(sink)
        )
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=config.trigger)
        queries.append(_start_with_job_conf(spark, w, config))
    return queries[0], queries[1]


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until any active query ends (either failing ends the job)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
