"""Cleaning of raw feed lines before publishing.

Kept: event name (stripped) '' or 'message', non-blank data other than
'[DONE]', data that is one JSON value.  Everything else is kept aside with the
first rule it failed, instead of being dropped silently.  White space is what
Unicode knows as such.  (Fixed values: accepted event names '' and 'message';
end marker '[DONE]'.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import is_json, with_message_key
from ..functions.parse import strip_text

ACCEPTED_EVENT_NAMES = ("", "message")
END_MARKER = "[DONE]"


def flag_feed(lines: DataFrame, event: str = "event", data: str = "data") -> DataFrame:
    """Adds ``raw`` (stripped data), ``message_key`` and ``reject_reason``; JSON that is not an object is ``not_object``.

    Each text is stripped once and each payload parsed once, behind Generates; only a
    payload that is no object is looked at again, to tell other JSON from none.
    """
    parts = F.struct(
        strip_text(F.coalesce(F.col(event), F.lit(""))).alias("_name"), strip_text(F.coalesce(F.col(data), F.lit(""))).alias("raw")
    )
    stripped = lines.select("*", F.inline(F.array(parts)))
    keyed = with_message_key(stripped, "raw", "message_key", "_valid")
    reason = (
        F.when(~F.col("_name").isin(*ACCEPTED_EVENT_NAMES), F.lit("event"))
        .when(F.col("raw") == "", F.lit("blank"))
        .when(F.col("raw") == END_MARKER, F.lit("done"))
        .when(~F.col("_valid"), F.when(is_json(F.col("raw")), F.lit("not_object")).otherwise("bad_json"))
    )
    return keyed.withColumn("reject_reason", reason).drop("_name", "_valid")


def clean_feed(lines: DataFrame, event: str = "event", data: str = "data") -> DataFrame:
    """Adds ``raw``, ``accepted`` and ``reject_reason``; any JSON value is accepted."""
    flagged = flag_feed(lines, event, data).drop("message_key")
    flagged = flagged.withColumn("reject_reason", F.when(F.col("reject_reason") != "not_object", F.col("reject_reason")))
    return flagged.withColumn("accepted", F.col("reject_reason").isNull())


def publishable(lines: DataFrame, event: str = "event", data: str = "data") -> tuple[DataFrame, DataFrame]:
    """(messages, quarantine): accepted lines with their message key, and the
    rest -- including JSON that is not an object, which cannot carry a key."""
    flagged = flag_feed(lines, event, data)
    return flagged.filter(F.col("reject_reason").isNull()), flagged.filter(F.col("reject_reason").isNotNull())
