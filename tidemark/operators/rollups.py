"""A1-A4: tumbling event-time window rollups.

Windows are epoch-aligned ``[start, end)`` and a row is labelled by its end.
All counts are ``count``/``count_if`` so Spark runs a partial (map-side)
aggregate before the shuffle: a hot wiki contributes one partial row per
input partition, never its raw events, to the reducer that owns it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..schemas import ACTIONS_COLUMNS, TOTALS_COLUMNS
from .enrich import enrich


def _window(config: PipelineConfig):
    return F.window(F.col("event_ts"), config.window).alias("window")


def aggregate_totals(events: DataFrame, config: PipelineConfig = DEFAULT, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per (window, wiki, *extra_keys); ``window_end`` kept as timestamp."""
    return (
        events.groupBy(_window(config), F.col("wiki"), *[F.col(k) for k in extra_keys])
        .agg(F.count(F.lit(1)).alias("edit_count"), F.count_if(F.col("bot")).alias("bot_count"))
        .select(F.col("window.end").alias("window_end"), "wiki", *extra_keys, "edit_count", "bot_count")
    )


def aggregate_actions(events: DataFrame, config: PipelineConfig = DEFAULT, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per (window, wiki, *extra_keys, event_type), minors of every type."""
    return (
        events.groupBy(_window(config), F.col("wiki"), *[F.col(k) for k in extra_keys], F.col("event_type"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("bot")).alias("bot_count"),
            F.count_if(F.col("is_minor")).alias("minor_count"),
        )
        .select(
            F.col("window.end").alias("window_end"), "wiki", *extra_keys, "event_type",
            "event_count", "bot_count", "minor_count",
        )
    )


def finish_totals(df: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """P12 + P14: human count and the inclusive burst flag, final column order."""
    return (
        df.withColumn("human_count", F.col("edit_count") - F.col("bot_count"))
        .withColumn("anomaly_flag", F.col("edit_count") >= F.lit(config.burst_threshold))
        .select(*TOTALS_COLUMNS)
    )


def finish_actions(df: DataFrame) -> DataFrame:
    return df.withColumn("human_count", F.col("event_count") - F.col("bot_count")).select(*ACTIONS_COLUMNS)


def totals_rollup(events: DataFrame, lookup: DataFrame, config: PipelineConfig = DEFAULT,
                  lookup_checked: bool = False) -> DataFrame:
    """A1: totals per (window_end, wiki, wiki_label, language) from parsed events."""
    return finish_totals(enrich(aggregate_totals(events, config), lookup, checked=lookup_checked), config)


def actions_rollup(events: DataFrame, lookup: DataFrame, config: PipelineConfig = DEFAULT,
                   lookup_checked: bool = False) -> DataFrame:
    """A2: totals split by event_type with a minor count (no burst flag)."""
    return finish_actions(enrich(aggregate_actions(events, config), lookup, checked=lookup_checked))


def totals_from_actions(actions: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """A4: totals re-derived from action rows; the flag is computed after the sum."""
    summed = actions.groupBy("window_end", "wiki", "wiki_label", "language").agg(
        F.sum("event_count").alias("edit_count"), F.sum("bot_count").alias("bot_count")
    )
    return finish_totals(summed, config)


def totals_rollup_enriched(enriched: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """A1 at the original grain: enriched events grouped with label and language."""
    return finish_totals(aggregate_totals(enriched, config, ("wiki_label", "language")), config)


def actions_rollup_enriched(enriched: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    return finish_actions(aggregate_actions(enriched, config, ("wiki_label", "language")))
