"""Time formatting for the warehouse layout.

All formatting runs in the session time zone, which the job pins to UTC
(``session.job_settings``); event time is never converted through
driver-side Python datetimes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the warehouse table: window end text, day and hour partitions.
WINDOW_END_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"


def window_end_text(col: Column | str = "window_end") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c.cast("timestamp"), WINDOW_END_FORMAT)


def partition_columns(col: Column | str = "window_end") -> dict[str, Column]:
    """``window_end_ts``, ``ds`` and ``hr`` derived from the window end."""
    c = (F.col(col) if isinstance(col, str) else col).cast("timestamp")
    return {
        "window_end_ts": F.date_format(c, WINDOW_END_FORMAT),
        "ds": F.date_format(c, DAY_FORMAT),
        "hr": F.date_format(c, HOUR_FORMAT),
    }
