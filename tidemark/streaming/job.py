"""The streaming job as a program: ``python -m tidemark.streaming.job``.

Environment (all optional): KAFKA_BOOTSTRAP_SERVERS, KAFKA_TOPIC,
KAFKA_STARTING_OFFSETS, KAFKA_MAX_OFFSETS_PER_TRIGGER, TIDEMARK_TRIGGER,
TIDEMARK_WATERMARK, TIDEMARK_WINDOW, TIDEMARK_BURST_THRESHOLD,
TIDEMARK_WAREHOUSE, TIDEMARK_CHECKPOINT, TIDEMARK_LOOKUP_CSV, TIDEMARK_RUN_ID
(default: the streaming query id, which lives exactly as long as the checkpoint),
TIDEMARK_TOTALS_TABLE / TIDEMARK_ACTIONS_TABLE (catalog tables kept in step),
TIDEMARK_CREATE_TABLES=1 to create those that are missing (without it a missing table
ends the start), SPARK_SQL_SHUFFLE_PARTITIONS, TIDEMARK_RAW_DIR to read JSON lines from a
directory instead of Kafka (TIDEMARK_MAX_FILES_PER_TRIGGER bounds a batch),
and TIDEMARK_AVAILABLE_NOW=1 to process what is there and stop (replay /
catch-up runs).

Steps: session -> preflight (lookup readable, V2; tables exist, V1) -> one
stateful query -> foreachBatch sinks -> wait until any query ends (a failure
ends the job).  Closed hours of the catalog tables are compacted once an hour
and at the end of a catch-up run.
"""

from __future__ import annotations

import logging
import os
import time

from pyspark.sql import SparkSession

from ..config import PipelineConfig
from ..plans.backfill import WarehousePaths
from ..session import build_session, checkpoint_root
from ..sources.files import text_stream
from ..sources.kafka import kafka_raw
from ..operators.checks import ensure_table
from ..sinks.compaction import compact_day, open_days
from ..sources.lookup import ensure_lookup_readable, lookup_version, read_lookup_csv
from ..sinks.warehouse import _stored_schema
from ..sources.warehouse import current_of, register_table
from .monitor import attach, heartbeat
from .rollup_stream import await_any, start_pipeline

log = logging.getLogger("tidemark")


def compact(spark: SparkSession, tables: list[tuple[str, str, str]]) -> None:
    """Compact every closed hour that still has per-batch partitions: those before the newest hour written."""
    for table, path, _ in tables:
        for ds, before in open_days(spark, table):
            dropped = compact_day(spark, table, path, ds, before)
            log.info("compacted %s of %s: %d partitions dropped", ds, table, dropped)


def preflight(spark: SparkSession, table: str, kind: str) -> None:
    """V1: the catalog table has to exist with the columns the job writes; nothing is created."""
    ensure_table(spark, table)
    missing = [f.name for f in _stored_schema(kind).fields if f.name not in spark.table(table).columns]
    if missing:
        raise RuntimeError(f"table {table!r} lacks the columns {', '.join(missing)}")
    current_of(spark, table, kind)


def main() -> None:
    logging.basicConfig(level=os.environ.get("TIDEMARK_LOG_LEVEL", "INFO"),
                        format="%(asctime)s %(levelname)s %(message)s")
    config = PipelineConfig.from_env()
    spark = build_session(app_name="tidemark-stream", config=config)
    root = checkpoint_root(spark)
    warehouse = config.warehouse_path or f"{root}/tidemark/warehouse"
    checkpoint = config.checkpoint_path or f"{root}/tidemark/checkpoints/rollups"
    if not config.lookup_path:
        raise SystemExit("TIDEMARK_LOOKUP_CSV is required (header wiki_key,wiki_label,language)")
    ensure_lookup_readable(spark, config.lookup_path)
    paths = WarehousePaths(warehouse)
    tables = [(table, path, kind) for table, path, kind in ((config.totals_table, paths.totals, "totals"),
                                                            (config.actions_table, paths.actions, "actions")) if table]
    for table, path, kind in tables:
        if os.environ.get("TIDEMARK_CREATE_TABLES", "").lower() in ("1", "true", "yes"):
            register_table(spark, table, path, kind)  # lists the location once, when the table is new
        preflight(spark, table, kind)
    raw_dir = os.environ.get("TIDEMARK_RAW_DIR")
    raw = text_stream(spark, raw_dir, config.max_files_per_trigger) if raw_dir else kafka_raw(spark, config)
    run_id = os.environ.get("TIDEMARK_RUN_ID") or None  # default: the query id kept in the checkpoint
    available_now = os.environ.get("TIDEMARK_AVAILABLE_NOW", "").lower() in ("1", "true", "yes")
    recorder = attach(spark)
    query = start_pipeline(
        spark, raw, lambda: read_lookup_csv(spark, config.lookup_path), paths,
        checkpoint, run_id, config, available_now=available_now,
        lookup_version=lambda: lookup_version(spark, config.lookup_path),
    )
    log.info("started query id=%s run_id=%s warehouse=%s checkpoint=%s", query.id, run_id, warehouse, checkpoint)
    if available_now:
        query.awaitTermination()
        log.info(heartbeat(recorder, str(query.id)))
        compact(spark, tables)
        return
    hour = time.time() // 3600
    while not await_any(spark, timeout=60):
        log.info(heartbeat(recorder, str(query.id)))
        if time.time() // 3600 > hour:
            hour = time.time() // 3600
            compact(spark, tables)
        if recorder.stalled(str(query.id), limit_seconds=15 * 60):
            log.warning("no input rows for 15 minutes (query %s)", query.id)


if __name__ == "__main__":
    main()
