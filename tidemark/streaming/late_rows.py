"""ST4 / ST10: late rows kept aside, with an exact count.

Spark's dropped-row metric counts what the state operator drops, which after partial aggregation
are groups and not events, and the rows themselves are gone.  ``start_late_split`` is a query of
its own over the same input: it judges every event by the rule the rollup uses under
``late_policy="current"`` (late when its window ends at or before the greatest event time of
all earlier batches, less the watermark delay), keeps each late event with its window and
payload, and counts on-time and late events per batch.

The greatest event time is carried from batch to batch in a one-row file keyed by batch id, so a
repeated batch is judged as the first time, a restart goes on where it stopped, and no batch lists
what earlier ones wrote.  Batches are those of the source's limits: with the same limit per
trigger the rollup sees the same ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, PipelineConfig
from ..functions.parse import parse_events


def _replace(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def _reached(spark: SparkSession, path: str, batch_id: int):
    """Greatest event time of all batches before ``batch_id``; null before the first."""
    if batch_id == 0:
        return None
    before = spark.read.schema("reached timestamp").parquet(f"{path}/reached/batch_id={batch_id - 1}")
    return before.select(F.max("reached")).scalar()


def split_batch(path: str, config: PipelineConfig = DEFAULT) -> Callable[[DataFrame, int], None]:
    """Per-batch callback on parsed events that still have their ``raw`` text."""

    def write(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        window = F.window("event_ts", config.window)
        reached = _reached(spark, path, batch_id)
        watermark = F.lit(None).cast("timestamp") if reached is None else reached - F.expr(f"INTERVAL {config.watermark}")
        judged = events.select("*", window["start"].alias("window_start"), window["end"].alias("window_end"), watermark.alias("watermark"))
        judged = judged.withColumn("late", F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))).persist()
        try:
            _replace(judged.where("late").drop("late"), f"{path}/late", batch_id)
            counts = judged.agg(F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))
            _replace(counts, f"{path}/counts", batch_id)
            here = judged.agg(F.max("event_ts").alias("reached"))
            if reached is not None:
                here = here.select(F.greatest("reached", reached).alias("reached"))
            _replace(here, f"{path}/reached", batch_id)  # last: the batch is whole once this is there
        finally:
            judged.unpersist()

    return write


def start_late_split(
    spark: SparkSession,
    raw_stream: DataFrame,
    path: str,
    checkpoint: str,
    config: PipelineConfig = DEFAULT,
    available_now: bool = False,
    query_name: str = "tidemark_late_rows",
) -> StreamingQuery:
    """Start the split of ``raw_stream``; ``path`` must be new for a new checkpoint, whose batch ids restart at 0."""
    events = parse_events(raw_stream, config=config, keep=("raw",))
    writer = events.writeStream.queryName(query_name).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(split_batch(path, config))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=config.trigger)
    return writer.start()


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every late event with its window, the watermark it missed and its payload."""
    return spark.read.parquet(f"{path}/late")


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, on_time, late)."""
    return spark.read.parquet(f"{path}/counts")
