"""K6: keyed publish of cleaned feed lines.

``publish_stream`` writes each batch's ``(key, value)`` messages to Kafka with the
configured producer options and its rejected lines to a quarantine table; with
``file_path`` the same messages go to files.  The value is the stripped text as it
came, which the feed sends compact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, PipelineConfig
from ..sources.feed import flag_feed
from ..sources.kafka import kafka_payload, sink_options


def publish_batch(quarantine_path: str, config: PipelineConfig = DEFAULT, file_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """A batch parsed once: messages to Kafka or files, rejects with their reason to the quarantine.

    Files and quarantine rows are replaced by batch id when a batch is retried; Kafka gets a
    retried batch again, keyed as before.
    """

    def write(lines: DataFrame, batch_id: int) -> None:
        flagged = flag_feed(lines).persist()
        try:
            messages = kafka_payload(flagged.filter(F.col("reject_reason").isNull()))
            rejects = flagged.filter(F.col("reject_reason").isNotNull())
            _replace(rejects, quarantine_path, batch_id)
            if file_path:
                _replace(messages, file_path, batch_id)
            else:
                messages.write.format("kafka").options(**sink_options(config)).save()
        finally:
            flagged.unpersist()

    return write


def _replace(rows: DataFrame, path: str, batch_id: int) -> None:
    writer = rows.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def publish_stream(lines: DataFrame, checkpoint: str, quarantine_path: str, config: PipelineConfig = DEFAULT,
                   file_path: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Publish a stream of feed lines (columns ``event`` and ``data``)."""
    writer = lines.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(publish_batch(quarantine_path, config, file_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_files(lines: DataFrame, path: str, quarantine_path: str | None = None) -> None:
    """The messages of a static read as files, and its rejects if a path is given; parsed once."""
    flagged = flag_feed(lines).persist()
    try:
        kafka_payload(flagged.filter(F.col("reject_reason").isNull())).write.mode("overwrite").parquet(path)
        if quarantine_path:
            flagged.filter(F.col("reject_reason").isNotNull()).write.mode("overwrite").parquet(quarantine_path)
    finally:
        flagged.unpersist()
