"""Column expressions: parsing, cleaning, time formatting, message keys."""

from .parse import (
    epoch_seconds,
    event_time,
    minor_flag,
    normalise_type,
    parse_events,
    parse_fields,
    raw_text,
)
from .timefmt import partition_columns, window_end_text
from .keys import with_message_key

__all__ = [
    "epoch_seconds",
    "event_time",
    "with_message_key",
    "minor_flag",
    "normalise_type",
    "parse_events",
    "parse_fields",
    "partition_columns",
    "raw_text",
    "window_end_text",
]
