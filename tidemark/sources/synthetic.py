"""Adapters that turn the given ``events`` table into the job's inputs.

The change feed itself is not available here, so raw JSON events, feed lines
and message payloads are derived row by row from ``events`` with built-in
expressions (``to_json`` over a struct); nothing is generated on the driver.
The mapping (fixed values):

  wiki      = user_id % 40, as text (keys 0-24 hit the nation lookup, 25-39 miss)
  type      = event_type
  bot       = event_id % 5 = 0
  timestamp = epoch of ts in milliseconds when event_id is even, in seconds when odd
  minor     = event_id % 3 = 0
  meta.id   = 'u-' || event_id; '' when event_id % 7 = 0; absent when event_id % 11 = 0
  id        = event_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

WIKI_MODULUS = 40


def epoch_micros(df: DataFrame, col: str = "ts") -> Column:
    """Microseconds since the epoch, independent of the session time zone."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def event_struct(df: DataFrame) -> Column:
    micros = epoch_micros(df)
    eid = F.col("event_id")
    epoch = F.when(eid % 2 == 0, micros / F.lit(1000.0)).otherwise(micros / F.lit(1_000_000.0))
    meta_id = (
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
        .when(eid % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("u-"), eid.cast("string")))
    )
    return F.struct(
        (F.col("user_id") % WIKI_MODULUS).cast("string").alias("wiki"),
        F.col("event_type").alias("type"),
        (eid % 5 == 0).alias("bot"),
        epoch.alias("timestamp"),
        (eid % 3 == 0).alias("minor"),
        F.struct(meta_id.alias("id")).alias("meta"),
        eid.alias("id"),
    )


def raw_events(events: DataFrame, keep_id: bool = True) -> DataFrame:
    """``events`` -> ``raw`` JSON text (plus ``event_id`` when ``keep_id``)."""
    raw = F.to_json(event_struct(events)).alias("raw")
    cols = [F.col("event_id"), raw] if keep_id else [raw]
    return events.select(*cols)


def raw_events_with_type(events: DataFrame, type_col: Column) -> DataFrame:
    """Raw events whose ``type`` field is replaced by ``type_col`` (null omits it)."""
    base = event_struct(events)
    return events.select(
        "event_id", F.to_json(base.withField("type", type_col)).alias("raw")
    )


def raw_events_some_without_key(events: DataFrame) -> DataFrame:
    """``(event_id, raw)`` where every 50th event has neither ``meta`` nor ``id``: its message has no key."""
    whole = event_struct(events)
    raw = F.when(F.col("event_id") % 50 == 0, F.to_json(whole.dropFields("meta", "id"))).otherwise(F.to_json(whole))
    return events.select("event_id", raw.alias("raw"))


def id_forms(events: DataFrame) -> DataFrame:
    """``(event_id, raw)``: payload texts whose id takes each JSON form in turn (event_id % 12).

    0 a float, 1 a large float, 2 a 50-digit integer, 3 a repeated name, 4 the string "0",
    5 zero, 6 true, 7 false, 8 NaN in another field, 9 a string meta, 10 an empty object, 11 a small float.
    """
    eid = F.col("event_id").cast("string")
    texts = [
        F.concat(F.lit('{"id":'), eid, F.lit(".0}")),
        F.concat(F.lit('{"id":'), (F.col("event_id") % 9 + 1).cast("string"), F.lit("e20}")),
        F.concat(F.lit('{"id":'), F.rpad(F.concat(F.lit("9"), eid), 50, "7"), F.lit("}")),
        F.concat(F.lit('{"id":"first","id":"r'), eid, F.lit('"}')),
        F.lit('{"id":"0"}'),
        F.lit('{"meta":{"id":0},"id":0.0}'),
        F.lit('{"id":true}'),
        F.concat(F.lit('{"meta":{"id":false},"id":"f'), eid, F.lit('"}')),
        F.concat(F.lit('{"x":NaN,"id":"n'), eid, F.lit('"}')),
        F.concat(F.lit('{"meta":"text","id":'), eid, F.lit("}")),
        F.lit('{"id":{}}'),
        F.concat(F.lit('{"id":'), (F.col("event_id") % 9 + 1).cast("string"), F.lit("e-7}")),
    ]
    raw = F.lit(None).cast("string")
    for form, text in enumerate(texts):
        raw = F.when(F.col("event_id") % len(texts) == form, text).otherwise(raw)
    return events.select("event_id", raw.alias("raw"))


def feed_lines(events: DataFrame) -> DataFrame:
    """Server-sent feed lines ``(event_id, event, data)``; later rules win.

    event = 'message'; '' when event_id % 4 = 0; 'ping' when event_id % 9 = 0.
    data  = raw JSON; '[DONE]' when event_id % 10 = 0; '{bad' when event_id % 13 = 0;
            a payload with a repeated name when event_id % 16 = 1, one with NaN when % 16 = 3,
            the end marker in no-break spaces when % 16 = 5, a payload in them when % 16 = 7,
            a payload with text after it when % 16 = 9, an array when % 16 = 11.
    """
    eid = F.col("event_id")
    event = F.when(eid % 9 == 0, "ping").when(eid % 4 == 0, "").otherwise("message")
    data = (
        F.when(eid % 13 == 0, "{bad")
        .when(eid % 10 == 0, "[DONE]")
        .when(eid % 16 == 1, F.concat(F.lit('{"id":1,"id":'), eid.cast("string"), F.lit("}")))
        .when(eid % 16 == 3, F.concat(F.lit('{"id":'), eid.cast("string"), F.lit(',"x":NaN}')))
        .when(eid % 16 == 5, F.lit("\u00a0[DONE]\u2003"))
        .when(eid % 16 == 7, F.concat(F.lit('\u00a0{"id":'), eid.cast("string"), F.lit("}\u00a0")))
        .when(eid % 16 == 9, F.lit('{"id":1} rest'))
        .when(eid % 16 == 11, F.lit("[1, 2]"))
        .otherwise(F.to_json(event_struct(events)))
    )
    return events.select("event_id", event.alias("event"), data.alias("data"))
