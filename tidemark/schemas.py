"""Schemas, key lists and output column orders."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fields read from the raw JSON event.  Fixed, all nullable, never inferred;
# everything else stays in the raw text (the minor flag is read by JSON path).
RAW_EVENT_SCHEMA = StructType(
    [
        StructField("wiki", StringType(), True),
        StructField("type", StringType(), True),
        StructField("bot", BooleanType(), True),
        StructField("timestamp", DoubleType(), True),
    ]
)

# What the pipeline parses, in one pass: the four fields plus the minor flag
# read as text.  A string field takes any JSON value as its text (true, 1,
# "TRUE ", {...}), the same text a JSON-path read of ``$.minor`` returns.
PARSE_SCHEMA = StructType(list(RAW_EVENT_SCHEMA.fields) + [StructField("minor", StringType(), True)])

# Header names of the lookup CSV (all text) and the names they get here.
LOOKUP_HEADER = {"wiki_key": "lk_wiki_key", "wiki_label": "lk_wiki_label", "language": "lk_language"}

TOTALS_COLUMNS = (
    "window_end",
    "wiki",
    "wiki_label",
    "language",
    "edit_count",
    "bot_count",
    "human_count",
    "anomaly_flag",
)

ACTIONS_COLUMNS = (
    "window_end",
    "wiki",
    "wiki_label",
    "language",
    "event_type",
    "event_count",
    "bot_count",
    "human_count",
    "minor_count",
)

TOTALS_KEY = ("window_end", "wiki")
ACTIONS_KEY = ("window_end", "wiki", "event_type")

BATCH_PARTITION_COLUMNS = ("ds", "hr", "run_id", "batch_id")

TOTALS_SCHEMA = StructType(
    [
        StructField("window_end", TimestampType(), True),
        StructField("wiki", StringType(), True),
        StructField("wiki_label", StringType(), True),
        StructField("language", StringType(), True),
        StructField("edit_count", LongType(), False),
        StructField("bot_count", LongType(), True),
        StructField("human_count", LongType(), True),
        StructField("anomaly_flag", BooleanType(), True),
    ]
)
