"""Q1 / Q2 / Q4 / Q6 / Q8: statistics of the stored partitions, written with each batch and merged on read.

A batch leaves one row per hour it wrote, beside its table: rows, a sketch of their keys, and the
bounds of their times.  A later version of a key falls into the same sketch bucket, so the union of
all sketches estimates current rows, whatever the number of versions.  Readers merge the rows and
never open the data.  Rows are keyed by run and batch, as the batch's files are: a retried batch
replaces its statistics.

The sketch (HyperLogLog, 2^16 buckets) has a relative standard error of 0.4 %; up to about 6,000 keys it
keeps them as a set and the estimate is exact.  It takes 4 bytes a key at first and 64 KB at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACTIONS_KEY, TOTALS_KEY

SKETCH_BUCKETS_LOG2 = 16
SCHEMA = (
    "ds string, hr string, rows bigint, keys binary, oldest_window timestamp, newest_window timestamp, "
    "oldest_update timestamp, newest_update timestamp, run_id string, batch_id bigint"
)


def stats_path(path: str) -> str:
    return f"{path}_stats"


def partition_stats(rows: DataFrame) -> DataFrame:
    """One row of statistics per hour of the rows of one batch."""
    key = ACTIONS_KEY if "event_type" in rows.columns else TOTALS_KEY
    # a null is a value of its own, and no text of one column can pass for another's
    parts = [F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("null")) for c in (F.col(k).cast("string") for k in key)]
    return rows.groupBy("ds", "hr", "run_id", "batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(F.concat(*parts), SKETCH_BUCKETS_LOG2).alias("keys"),
        F.min("window_end").alias("oldest_window"), F.max("window_end").alias("newest_window"),
        F.min("updated_at").alias("oldest_update"), F.max("updated_at").alias("newest_update"),
    )


def write_stats(rows: DataFrame, path: str, run_id: str, batch_id: int) -> list[tuple[str, str]]:
    """Write a batch's statistics; its (ds, hr) list."""
    folder = f"{stats_path(path)}/run_id={run_id}/batch_id={int(batch_id)}"
    partition_stats(rows).drop("run_id", "batch_id").write.mode("overwrite").parquet(folder)
    written = rows.sparkSession.read.schema("ds string, hr string").parquet(folder)
    return [(r["ds"], r["hr"]) for r in written.collect()]  # the hours of one batch


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(stats_path(path))


def hours(spark: SparkSession, path: str) -> DataFrame:
    """(ds, hr, newest_update) of every stored hour."""
    return read_stats(spark, path).groupBy("ds", "hr").agg(F.max("newest_update").alias("newest_update"))


def estimates(spark: SparkSession, path: str) -> DataFrame:
    """One row: estimated_rows (current rows, not versions), stored_rows, last_upsert, newest_window_end."""
    merged = read_stats(spark, path).agg(
        F.hll_union_agg("keys").alias("keys"), F.sum("rows").alias("stored_rows"),
        F.max("newest_update").alias("last_upsert"), F.max("newest_window").alias("newest_window_end"),
    )
    # the union over no rows is an empty sketch, whose estimate is 0
    return merged.select(
        F.coalesce(F.hll_sketch_estimate("keys"), F.lit(0)).cast("bigint").alias("estimated_rows"),
        F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"), "last_upsert", "newest_window_end",
    )
