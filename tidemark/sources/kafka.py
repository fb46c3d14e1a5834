"""S1-S4 Kafka source and K6 option builders.

The Kafka connector jar is not bundled with this build; these functions
assemble the public ``format("kafka")`` options so a cluster that provides the
connector runs the same code.  Tests use the file stand-ins in ``files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.parse import raw_text


def source_options(config: PipelineConfig = DEFAULT) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.kafka_bootstrap,
        "subscribe": config.kafka_topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(config.max_offsets_per_trigger),
        "fetchOffset.numRetries": str(config.fetch_offset_num_retries),
        "fetchOffset.retryIntervalMs": str(config.fetch_offset_retry_interval_ms),
        "kafka.session.timeout.ms": str(config.kafka_session_timeout_ms),
        "kafka.request.timeout.ms": str(config.kafka_request_timeout_ms),
        "kafka.max.poll.records": str(config.kafka_max_poll_records),
    }


def batch_options(config: PipelineConfig = DEFAULT, ending_offsets: str = "latest") -> dict[str, str]:
    """Replay (S2) as a bounded batch read; stream-only options are dropped."""
    opts = source_options(config.with_(starting_offsets="earliest" if config.starting_offsets == "latest"
                                       else config.starting_offsets))
    opts.pop("maxOffsetsPerTrigger")
    opts["endingOffsets"] = ending_offsets
    return opts


def kafka_raw(spark: SparkSession, config: PipelineConfig = DEFAULT) -> DataFrame:
    """Streaming ``raw STRING`` from the topic."""
    df = spark.readStream.format("kafka").options(**source_options(config)).load()
    return df.select(raw_text("value").alias("raw"))


def kafka_raw_batch(spark: SparkSession, config: PipelineConfig = DEFAULT) -> DataFrame:
    df = spark.read.format("kafka").options(**batch_options(config)).load()
    return df.select(raw_text("value").alias("raw"))


def sink_options(config: PipelineConfig = DEFAULT, checkpoint: str | None = None) -> dict[str, str]:
    """K6: keyed publish options (acks=all, snappy, retries, idempotent, in-flight 1)."""
    opts = {"kafka.bootstrap.servers": config.kafka_bootstrap, "topic": config.kafka_topic}
    opts.update(config.kafka_producer_options)
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def kafka_payload(messages: DataFrame) -> DataFrame:
    """``(key, value)`` binary columns for the Kafka sink from ``(message_key, raw)``."""
    return messages.select(
        F.col("message_key").cast("binary").alias("key"), F.col("raw").cast("binary").alias("value")
    )
