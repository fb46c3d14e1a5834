"""K1/K4: idempotent partitioned Parquet sink for rollup batches.

Each write is keyed by ``(run_id, batch_id)`` and lands in
``ds=/hr=/run_id=/batch_id=`` partitions with dynamic partition overwrite, so
a retried micro-batch (or a re-run backfill batch) replaces exactly its own
files instead of appending duplicates.  ``run_id`` is fixed per checkpoint:
a new checkpoint restarts ``batch_id`` at 0 and must not overwrite older runs.
``updated_at`` stamps the write (``current_timestamp()`` unless given) and
orders versions in the current view.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.timefmt import partition_columns
from ..schemas import ACTIONS_COLUMNS, BATCH_PARTITION_COLUMNS, TOTALS_COLUMNS, TOTALS_SCHEMA
from .partition_stats import write_stats

STORED_EXTRA = ("window_end_ts", "updated_at")


def _stored_schema(kind: str) -> StructType:
    if kind == "totals":
        fields = list(TOTALS_SCHEMA.fields)
    else:
        fields = [
            StructField("window_end", TimestampType()),
            StructField("wiki", StringType()),
            StructField("wiki_label", StringType()),
            StructField("language", StringType()),
            StructField("event_type", StringType()),
            StructField("event_count", LongType()),
            StructField("bot_count", LongType()),
            StructField("human_count", LongType()),
            StructField("minor_count", LongType()),
        ]
    fields += [
        StructField("window_end_ts", StringType()),
        StructField("updated_at", TimestampType()),
        StructField("ds", StringType()),
        StructField("hr", StringType()),
        StructField("run_id", StringType()),
        StructField("batch_id", LongType()),
    ]
    return StructType(fields)


def write_batch(
    df: DataFrame,
    path: str,
    run_id: str,
    batch_id: int,
    updated_at: Column | None = None,
    write_partitions: int | None = None,
    table: str | None = None,
    stats: bool = False,
) -> None:
    """Write one batch; with ``table``, register exactly the partitions it
    wrote in that catalog table (readers then prune through the catalog and
    never list the whole warehouse).  With ``stats``, statistics of the hours it
    wrote go beside the table, and the hours are known from them."""
    kind = "actions" if "event_type" in df.columns else "totals"
    cols = ACTIONS_COLUMNS if kind == "actions" else TOTALS_COLUMNS
    parts = partition_columns("window_end")
    if stats and updated_at is None:  # the rows and their statistics are two jobs: one stamp for both
        updated_at = F.lit(_dt.datetime.now(_dt.timezone.utc))
    out = df.select(
        *cols,
        parts["window_end_ts"].alias("window_end_ts"),
        (updated_at if updated_at is not None else F.current_timestamp()).alias("updated_at"),
        parts["ds"].alias("ds"),
        parts["hr"].alias("hr"),
        F.lit(str(run_id)).alias("run_id"),
        F.lit(int(batch_id)).cast("bigint").alias("batch_id"),
    )
    hours = write_stats(out, path, run_id, batch_id) if stats else None
    # Cluster rows by directory so each (ds, hr) gets few files, through the
    # rebalance hint: AQE splits a skewed (hot) hour across several writers and
    # merges small ones, where a plain repartition(ds, hr) would hand a hot
    # hour to a single task.
    out = out.coalesce(write_partitions) if write_partitions else out.hint("rebalance", "ds", "hr")
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*BATCH_PARTITION_COLUMNS)
        .parquet(path)
    )
    if table:
        from ..sources.warehouse import add_partitions

        if hours is None:
            # the hours of the files just written, never a second run of the batch's plan
            written = read_rollup(df.sparkSession, path, kind)
            mine = written.filter((F.col("run_id") == F.lit(str(run_id))) & (F.col("batch_id") == F.lit(int(batch_id))))
            hours = [(r["ds"], r["hr"]) for r in mine.select("ds", "hr").distinct().toLocalIterator()]
        add_partitions(df.sparkSession, table, hours, run_id, batch_id)


def read_rollup(spark: SparkSession, path: str, kind: str = "totals") -> DataFrame:
    """All stored versions (partition columns typed by the stored schema)."""
    return spark.read.schema(_stored_schema(kind)).parquet(path)
