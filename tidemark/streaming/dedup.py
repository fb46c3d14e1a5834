"""A message that the feed sends again counts once.

A producer that retries sends a message twice; both copies have the same key (``meta.id``, else
``id``) and event time.  ``dropDuplicatesWithinWatermark`` keeps a key in state until the
watermark has passed its event time by the delay, so state is bounded by the open time range, and
a copy that comes later still is late and is dropped as late rows are.

A message without a key cannot be told from another, so all of them stay: each gets a key of its
own, which also keeps them from meeting in one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.keys import with_message_key
from ..functions.parse import parse_events
from .monitor import PARSE_METRICS

_ONCE = "_message"


def once_per_message(raw_stream: DataFrame, config: PipelineConfig = DEFAULT, raw: str = "raw") -> DataFrame:
    """Parsed events with the event-time watermark, each message key once.

    On a static input every key counts once whatever its distance in time.
    """
    keyed = with_message_key(raw_stream.select(F.col(raw).alias("raw")))
    events = parse_events(keyed, config=config, keep=("message_key",), observe=PARSE_METRICS if raw_stream.isStreaming else None)
    key = F.coalesce(F.concat(F.lit("key:"), "message_key"), F.concat(F.lit("row:"), F.uuid()))
    events = events.withColumn(_ONCE, key).drop("message_key")
    if not events.isStreaming:
        return events.dropDuplicates([_ONCE]).drop(_ONCE)
    return events.withWatermark("event_ts", config.watermark).dropDuplicatesWithinWatermark([_ONCE]).drop(_ONCE)
