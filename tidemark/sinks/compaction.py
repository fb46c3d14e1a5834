"""Compaction of closed hours in the catalog tables (small-file control).

Each micro-batch adds one ``ds/hr/run_id/batch_id`` partition per hour it
touches.  ``compact_day`` rewrites one day's closed hours as their current
view -- one ``run_id=compacted`` partition per hour, rebalanced into few
files -- then drops the per-batch partitions of those hours from the
catalog.  Only catalog metadata is dropped (external table): readers of the
table see the compacted files only, readers of the raw path still get the same
values from the current view (the copies carry the original ``updated_at``).
Re-running is idempotent; a later batch for a compacted hour simply wins by
its newer ``updated_at``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.current import current_view
from ..sources.warehouse import PARTITIONS_PER_STATEMENT, _quote, add_partitions

COMPACTED_RUN = "compacted"


def _partitions_of_day(spark: SparkSession, table: str, ds: str) -> list[dict]:
    rows = spark.sql(f"SHOW PARTITIONS {table} PARTITION (ds = {_quote(ds)})").collect()
    out = []
    for r in rows:
        spec = dict(part.split("=", 1) for part in r[0].split("/"))
        out.append(spec)
    return out


def open_days(spark: SparkSession, table: str) -> list[tuple[str, _dt.datetime]]:
    """(day, time before which its hours are closed) of each day with per-batch partitions.

    The newest hour written may still get windows; all hours before it are closed, for a window is
    written once, when the watermark passes it.
    """
    specs = [dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    if not specs:
        return []
    newest = max(_dt.datetime.fromisoformat(f"{p['ds']}T{p['hr']}:00:00") for p in specs)
    return [(ds, newest) for ds in sorted({p["ds"] for p in specs if p["run_id"] != COMPACTED_RUN})]


def compact_day(spark: SparkSession, table: str, path: str, ds: str, before: _dt.datetime | None = None) -> int:
    """Compact the hours of day ``ds`` whose windows all end before ``before``
    (default: the whole day).  Returns the number of partitions dropped.

    An hour that was compacted before and got a later batch is compacted into a new generation
    (``batch_id``), so no partition is read and replaced at once.
    """
    parts = _partitions_of_day(spark, table, ds)
    hours = sorted({p["hr"] for p in parts if p["run_id"] != COMPACTED_RUN})
    if before is not None:
        hours = [h for h in hours if _dt.datetime.fromisoformat(f"{ds}T{h}:00:00") + _dt.timedelta(hours=1) <= before]
    stale = [p for p in parts if p["hr"] in hours]
    if not stale:
        return 0
    generation = 1 + max((int(p["batch_id"]) for p in stale if p["run_id"] == COMPACTED_RUN), default=-1)
    rows = spark.table(table).filter((F.col("ds") == F.lit(ds)) & F.col("hr").isin(hours))
    compacted = current_view(rows).withColumn("run_id", F.lit(COMPACTED_RUN))
    compacted = compacted.withColumn("batch_id", F.lit(generation).cast("bigint"))
    (
        compacted.hint("rebalance", "ds", "hr").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy("ds", "hr", "run_id", "batch_id").parquet(path)
    )
    add_partitions(spark, table, [(ds, h) for h in hours], COMPACTED_RUN, generation)
    specs = [
        f"PARTITION (ds = {_quote(p['ds'])}, hr = {_quote(p['hr'])}, run_id = {_quote(p['run_id'])}, "
        f"batch_id = {int(p['batch_id'])})"
        for p in stale
    ]
    for at in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[at:at + PARTITIONS_PER_STATEMENT])}")
    return len(stale)
