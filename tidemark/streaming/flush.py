"""ST3 / S2: the windows that are still open when a bounded run ends.

In append mode a window leaves the state only when the watermark passes its end, so a catch-up run
over a finished input leaves the newest windows unwritten.  ``open_windows`` reads them from the
checkpoint with the ``statestore`` source, as of the last committed batch; ``flush_open_windows``
writes them like a batch, under a run id of its own.

The state itself is not touched.  When the stream goes on, the window is written again when it
closes, with all its events and a newer ``updated_at``: the current view then has that version
only.  Another flush replaces the one before it, hour by hour.  So rows are neither repeated nor
lost over any sequence of runs and flushes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators.enrich import enrich, prepare_lookup
from ..operators.rollups import finish_actions
from ..plans.backfill import WarehousePaths, write_rollups

OPEN_SUFFIX = "-open"
#: The aggregate's operator name in the state's metadata, and its buffers in the order of the aggregate's columns.
_AGGREGATE = "stateStoreSave"
_COUNTS = "struct<event_count: bigint, bot_count: bigint, minor_count: bigint>"


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Un-enriched action rows (window_end, wiki, event_type and counts) of every window in state."""
    operators = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == _AGGREGATE)
    found = operators.select("operatorId").distinct().collect()  # one row: the pipeline has one aggregate
    if len(found) != 1:
        raise ValueError(f"{checkpoint} holds {len(found)} aggregates; one is expected")
    state = spark.read.format("statestore").option("operatorId", found[0][0]).load(checkpoint)
    # the three buffers have the same name, so they are taken by position
    rows = state.select("key", F.col("value").cast(_COUNTS).alias("value"))
    return rows.select(F.col("key.window.end").alias("window_end"), "key.wiki", "key.event_type", "value.*")


def flush_open_windows(
    spark: SparkSession,
    checkpoint: str,
    lookup: DataFrame,
    paths: WarehousePaths,
    run_id: str,
    config: PipelineConfig = DEFAULT,
    updated_at: Column | None = None,
) -> int:
    """Write the open windows of a stopped query as run ``<run_id>-open``; returns the number of action rows."""
    checked = prepare_lookup(lookup, config.lookup_broadcast_max_rows)
    actions = finish_actions(enrich(open_windows(spark, checkpoint), checked, checked=True)).persist()
    try:
        rows = actions.count()
        if rows:
            write_rollups(spark, actions, paths, f"{run_id}{OPEN_SUFFIX}", 0, config, updated_at)
        return rows
    finally:
        actions.unpersist()
