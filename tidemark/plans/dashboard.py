"""One dashboard refresh as Spark plans (S7 + Q1-Q18 together).

The dashboard fetched the look-back rows of both tables once per refresh and
derived every chart from them.  ``refresh`` does the same on Spark: each
look-back view (or its latest-rows fallback) is persisted once, and every
report is a DataFrame over it; ``release`` lets the views go, and nothing is
left on the shared folder.  A lost executor only makes Spark compute its part
of a view again from the stored tables.  Nothing is collected here except the
handful of pivot labels; callers collect the small results they display.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..config import DEFAULT, PipelineConfig
from . import reports


@dataclass
class Dashboard:
    totals: DataFrame            # look-back rows (or the latest-rows fallback)
    totals_fallback: bool
    stats: DataFrame             # Q1 over the whole table
    staleness: DataFrame         # Q17
    view_last_update: DataFrame  # Q18
    recent_totals: DataFrame     # Q8 (150)
    top_wikis: DataFrame         # Q9
    bot_vs_human: DataFrame      # Q10
    volume_pivot: DataFrame      # Q11 (wide)
    bursts: DataFrame            # Q12
    actions: DataFrame
    actions_fallback: bool
    event_mix: DataFrame         # Q13 (long)
    type_totals: DataFrame       # Q14
    minor_share: DataFrame       # Q15
    log_share: DataFrame         # Q16
    recent_actions: DataFrame    # Q8 (200)

    def release(self) -> None:
        """Frees the persisted views; the reports can no longer be read cheaply."""
        self.totals.unpersist()
        self.actions.unpersist()


def refresh(
    spark: SparkSession,
    totals_table: DataFrame,
    actions_table: DataFrame,
    as_of: Column | _dt.datetime,
    config: PipelineConfig = DEFAULT,
    totals_versions: DataFrame | None = None,
) -> Dashboard:
    """``totals_table`` / ``actions_table`` are the current views (K2/K3).

    ``totals_versions`` is the stored totals with all versions: Q1 and Q17 read it instead of
    the current view, which costs a sort of the whole history for the same numbers.
    """
    totals, t_fallback = _view(totals_table, as_of, config)
    actions, a_fallback = _view(actions_table, as_of, config)
    versions = totals_table if totals_versions is None else totals_versions
    return Dashboard(
        totals=totals,
        totals_fallback=t_fallback,
        stats=reports.table_stats(versions),
        staleness=reports.staleness(versions, as_of, config.stale_minutes),
        view_last_update=reports.view_last_update(totals),
        recent_totals=reports.recent_rows(totals, 150),
        top_wikis=reports.top_wikis(totals, 15),
        bot_vs_human=reports.bot_vs_human(totals, 10),
        volume_pivot=reports.volume_pivot_wide(totals, 6),
        bursts=reports.burst_windows(totals, 20),
        actions=actions,
        actions_fallback=a_fallback,
        event_mix=reports.event_mix_long(actions),
        type_totals=reports.type_totals(actions),
        minor_share=reports.minor_share(actions),
        log_share=reports.log_share(actions),
        recent_actions=reports.recent_rows(actions, 200),
    )


def _view(table: DataFrame, as_of: Column | _dt.datetime, config: PipelineConfig) -> tuple[DataFrame, bool]:
    """The persisted look-back, or the persisted latest rows when it is empty and the table is not."""
    view = reports.lookback(table, as_of, config.lookback_minutes).persist()
    if not view.isEmpty():
        return view, False
    view.unpersist()
    newest = reports.latest(table, config.latest_rows).persist()
    return newest, not newest.isEmpty()
