"""Column-level cleaning of raw change events (batch and stream agnostic).

Every function here is a built-in Spark expression chain: they stay inside
whole-stage codegen and work the same on a static or a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import DEFAULT, PipelineConfig
from ..schemas import PARSE_SCHEMA, RAW_EVENT_SCHEMA

# Fixed values that decide results (must stay as they are):
#   epoch values strictly greater than 1e12 are milliseconds, else seconds;
#   event time is kept only between 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC;
#   a minor flag counts when its JSON text, trimmed and lower-cased, is "true" or "1";
#   a blank or absent type becomes "unknown".
MILLIS_CUTOFF = 1_000_000_000_000.0
MIN_EPOCH_SECONDS = -62_135_596_800.0
MAX_EPOCH_SECONDS = 253_402_300_799.0
MINOR_TRUE_TEXTS = ("true", "1")
UNKNOWN_TYPE = "unknown"
# White space as Unicode knows it, for a regular expression's class.
WHITE_SPACE = "\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def raw_text(value: Column | str = "value") -> Column:
    """Kafka ``value`` bytes (or any binary) as UTF-8 text."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("string")


def parse_fields(raw: Column | str = "raw") -> Column:
    """Permissive parse with the fixed four-field schema.

    Malformed text, JSON null, arrays and truncated objects give a struct of
    nulls; a mistyped field nulls only that field.
    """
    col = F.col(raw) if isinstance(raw, str) else raw
    return F.from_json(col, RAW_EVENT_SCHEMA)


def parsed_columns(df: DataFrame, raw: str = "raw", keep: tuple[str, ...] = (), schema=PARSE_SCHEMA) -> DataFrame:
    """``keep`` columns plus the parsed fields as columns, the text parsed once.

    The one-element ``inline`` is a Generate node, which filters and field
    extractions cannot be pushed below; without it Catalyst substitutes the
    parse into every later reference and the JSON is re-read once per use.
    """
    return df.select(*[F.col(c) for c in keep], F.inline(F.array(F.from_json(F.col(raw), schema))))


def minor_text_flag(text: Column | str) -> Column:
    """P4 rule on the flag's JSON text: trimmed, lower-cased "true" or "1"."""
    col = F.col(text) if isinstance(text, str) else text
    return F.lower(F.trim(F.coalesce(col, F.lit("")))).isin(*MINOR_TRUE_TEXTS)


def minor_flag(raw: Column | str = "raw") -> Column:
    """``$.minor`` read as text; JSON true, 1 and "TRUE " all count."""
    col = F.col(raw) if isinstance(raw, str) else raw
    return minor_text_flag(F.get_json_object(col, "$.minor"))


def epoch_seconds(epoch: Column | str = "event_unix_ts") -> Column:
    """Values above 1e12 (strictly) are milliseconds."""
    col = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.when(col > F.lit(MILLIS_CUTOFF), col / F.lit(1000.0)).otherwise(col)


def event_time(seconds: Column | str = "event_unix_sec") -> Column:
    """Whole-second event time, sub-second part truncated toward zero.

    Values outside years 0001-9999, NaN and infinities give null instead of an
    overflow (ANSI mode) or a far-future time that would drag the watermark.
    """
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    in_range = col.between(F.lit(MIN_EPOCH_SECONDS), F.lit(MAX_EPOCH_SECONDS))
    return F.when(in_range, F.timestamp_seconds(col.cast("bigint")))


def normalise_type(type_col: Column | str = "type") -> Column:
    """P10: trim spaces, blank or absent -> "unknown".  Types keep their length;
    the clip of the keyed tables belongs to delivery (P15)."""
    col = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(UNKNOWN_TYPE))


def strip_text(col: Column) -> Column:
    """Both ends without white space as Unicode knows it (what text stripping in the feed client removes)."""
    return F.regexp_replace(col, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def delivered_type(type_col: Column | str, max_len: int) -> Column:
    """All white space stripped, blank -> "unknown", clipped to the keyed table's column."""
    col = F.col(type_col) if isinstance(type_col, str) else type_col
    stripped = strip_text(F.coalesce(col, F.lit(UNKNOWN_TYPE)))
    return F.substring(F.coalesce(F.nullif(stripped, F.lit("")), F.lit(UNKNOWN_TYPE)), 1, max_len)


def parse_events(df: DataFrame, raw: str = "raw", config: PipelineConfig = DEFAULT, keep: tuple[str, ...] = (),
                 observe: str | None = None) -> DataFrame:
    """Raw JSON text -> typed, cleaned event rows.

    Output: ``wiki, bot, event_unix_ts, event_unix_sec, event_ts, is_minor,
    event_type`` plus any ``keep`` columns passed through.  Rows with a null
    wiki, null timestamp or unusable event time are dropped; an empty wiki is
    kept.  With ``observe`` the dropped rows are counted by reason, as observed
    metrics of that name.
    """
    if observe:
        flagged = flag_events(df, raw, keep).observe(observe, *drop_counts())
        fields = flagged.filter(F.col("drop_reason").isNull())
    else:
        fields = parsed_columns(df, raw, keep)
    # the raw text is not carried past this projection
    projected = fields.select(
        *[F.col(c) for c in keep],
        F.col("wiki"),
        F.col("type"),
        F.col("bot"),
        F.col("timestamp").alias("event_unix_ts"),
        minor_text_flag("minor").alias("is_minor"),
    )
    cleaned = (
        projected.filter(F.col("wiki").isNotNull() & F.col("event_unix_ts").isNotNull())
        .withColumn("event_unix_sec", epoch_seconds("event_unix_ts"))
        .withColumn("event_ts", event_time("event_unix_sec"))
        .filter(F.col("event_ts").isNotNull())
        .withColumn("bot", F.coalesce(F.col("bot"), F.lit(False)))
        .withColumn("event_type", normalise_type("type"))
        .drop("type")
    )
    if config.max_future:
        horizon = F.current_timestamp() + F.expr(f"INTERVAL {config.max_future}")
        cleaned = cleaned.filter(F.col("event_ts") <= horizon)
    return cleaned.select(
        *keep, "wiki", "bot", "event_unix_ts", "event_unix_sec", "event_ts", "is_minor", "event_type"
    )


#: Why parsing drops a row, in the order the rules apply.
DROP_REASONS = ("malformed", "no_wiki", "no_timestamp", "bad_time")
_CORRUPT = "_corrupt_record"


def flag_events(df: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every raw row with its parsed fields and ``drop_reason``, null for the rows that ``parse_events`` keeps.

    ``malformed`` is a text that gives none of the fields and is no object of this schema, null included;
    ``bad_time`` an event time outside the years 0001-9999.  The text is parsed once.
    """
    schema = StructType([*PARSE_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    read = F.from_json(F.col(raw), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    fields = df.select(*[F.col(c) for c in dict.fromkeys((*keep, raw))], F.inline(F.array(read)))
    seconds = epoch_seconds("timestamp")
    nothing = F.coalesce(*[F.col(f.name).cast("string") for f in PARSE_SCHEMA.fields]).isNull()
    not_object = ~F.coalesce(F.ltrim(F.col(raw)).startswith("{"), F.lit(False))
    empty = nothing & (not_object | F.col(_CORRUPT).isNotNull())
    reason = (
        F.when(empty, F.lit("malformed"))
        .when(F.col("wiki").isNull(), F.lit("no_wiki"))
        .when(F.col("timestamp").isNull(), F.lit("no_timestamp"))
        .when(event_time(seconds).isNull(), F.lit("bad_time"))
    )
    return fields.withColumn("drop_reason", reason)


def drop_counts() -> list[Column]:
    """Aggregates over ``drop_reason``: rows read, and rows dropped for each reason."""
    counts = [F.count_if(F.col("drop_reason").eqNullSafe(F.lit(r))).alias(r) for r in DROP_REASONS]
    return [F.count(F.lit(1)).alias("rows"), *counts]
