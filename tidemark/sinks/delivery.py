"""K7's projection: rollup rows as the keyed tables take them.

The warehouse keeps what the feed said.  A keyed table has sized columns, so on delivery an
event type loses all white space around it, falls back to "unknown" when nothing is left and is
clipped; types that are equal then are one key, whose counts are summed.  A null language is
delivered as the empty text.  Rows that still break the contract are rejected with their rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.parse import delivered_type
from ..operators.checks import split_contract
from ..schemas import ACTIONS_COLUMNS, TOTALS_COLUMNS


def _language(df: DataFrame) -> DataFrame:
    return df.withColumn("language", F.coalesce("language", F.lit("")))


def delivery_actions(actions: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per key of the actions table."""
    typed = _language(actions).withColumn("event_type", delivered_type("event_type", config.max_event_type_len))
    keys = ["window_end", "wiki", "wiki_label", "language", "event_type"]
    counts = [F.sum(c).alias(c) for c in ("event_count", "bot_count", "human_count", "minor_count")]
    return typed.groupBy(*keys).agg(*counts).select(*ACTIONS_COLUMNS)


def delivery_totals(totals: DataFrame) -> DataFrame:
    return _language(totals).select(*TOTALS_COLUMNS)


def deliverable(rows: DataFrame, config: PipelineConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(rows to deliver, rejected rows with ``contract_reason``)."""
    return split_contract(rows, config)
