"""Q1-Q18: the read-side report library over the rollup tables.

Every report is a DataFrame -> DataFrame function; aggregation happens in
Spark and only the final (small, limited) result is meant to be collected.
Ties are broken by the label / key as the last sort column so results are
deterministic.  ``as_of`` replaces the database clock and may be a literal
timestamp or a Column (for example a scalar subquery).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..schemas import ACTIONS_KEY, TOTALS_KEY

def _as_of(as_of: Column | _dt.datetime | str) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def _key_for(df: DataFrame) -> tuple[str, ...]:
    return ACTIONS_KEY if "event_type" in df.columns else TOTALS_KEY


def _no_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


# ---- Q1 / Q17 / Q18: freshness ------------------------------------------------

def table_stats(rollup: DataFrame) -> DataFrame:
    """Q1: row count, last update and newest window (one row).

    Over stored versions or their current view alike: rows are counted by key, and the newest
    version has the latest times, so no version has to be picked first.
    """
    per_key = rollup.groupBy(*_key_for(rollup)).agg(F.max("updated_at").alias("updated_at"))
    return per_key.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max("updated_at").alias("last_upsert"),
        F.max("window_end").alias("newest_window_end"),
    )


def staleness(rollup: DataFrame, as_of, stale_minutes: float = DEFAULT.stale_minutes) -> DataFrame:
    """Q17: minutes since the last update, floored at 0; stale when above the limit.

    Null age (and null ``is_stale``) when the table has no rows.
    """
    last = F.max("updated_at")
    # greatest() skips nulls, so the empty-table case is kept null explicitly
    age = F.when(last.isNotNull(), F.greatest(
        F.lit(0.0),
        (F.unix_micros(_as_of(as_of)) - F.unix_micros(last)).cast("double") / F.lit(60_000_000.0),
    ))
    return rollup.agg(last.alias("last_upsert"), age.alias("age_minutes")).withColumn(
        "is_stale", F.col("age_minutes") > F.lit(float(stale_minutes))
    )


def view_last_update(view: DataFrame) -> DataFrame:
    """Q18: last update inside an already filtered view."""
    return view.agg(F.max("updated_at").alias("view_last_update"))


# ---- Q3-Q8: look-back and latest rows -----------------------------------------

def lookback(rollup: DataFrame, as_of, minutes: int = DEFAULT.lookback_minutes) -> DataFrame:
    """Q3/Q5: rows with ``window_end >= as_of - minutes`` (inclusive); ``in_order`` sorts them for display.

    On the warehouse layout the same bound is repeated on the ``ds`` partition
    column so Spark prunes whole day directories before reading.
    """
    start = _as_of(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    out = rollup.filter(F.col("window_end") >= start)
    if "ds" in rollup.columns:
        out = out.filter(F.col("ds") >= F.date_format(start, "yyyy-MM-dd"))
    return out


def in_order(view: DataFrame) -> DataFrame:
    """Look-back rows as they are shown: by window, then key."""
    return view.orderBy(F.col("window_end").asc(), *[F.col(k).asc() for k in _key_for(view)[1:]])


def latest(rollup: DataFrame, n: int = DEFAULT.latest_rows) -> DataFrame:
    """Q4/Q6: newest ``n`` rows by update time (top-k, no full sort)."""
    return rollup.orderBy(F.col("updated_at").desc(), *[F.col(k).asc() for k in _key_for(rollup)]).limit(n)


def lookback_or_latest(rollup: DataFrame, as_of, minutes: int = DEFAULT.lookback_minutes,
                       n: int = DEFAULT.latest_rows) -> tuple[DataFrame, bool]:
    """Q7: the look-back, or the latest ``n`` rows when the look-back is empty
    but the table is not.  Returns (rows, used_fallback)."""
    view = lookback(rollup, as_of, minutes)
    if not view.isEmpty():
        return view, False
    if rollup.isEmpty():
        return view, False
    return latest(rollup, n), True


def recent_rows(rollup: DataFrame, n: int = 150) -> DataFrame:
    """Q8: newest ``n`` rows by window (150 totals / 200 actions in the dashboard)."""
    return rollup.orderBy(F.col("window_end").desc(), *[F.col(k).asc() for k in _key_for(rollup)[1:]]).limit(n)


# ---- Q9-Q12: totals reports ---------------------------------------------------

def top_wikis(totals: DataFrame, n: int = 15) -> DataFrame:
    """Q9: labels by summed volume."""
    return (
        _no_null(totals, "wiki_label")
        .groupBy("wiki_label")
        .agg(F.sum("edit_count").alias("edit_count"))
        .orderBy(F.col("edit_count").desc(), F.col("wiki_label").asc())
        .limit(n)
    )


def bot_vs_human(totals: DataFrame, n: int = 10) -> DataFrame:
    """Q10: bot and human sums per label, top ``n`` by human count."""
    return (
        _no_null(totals, "wiki_label")
        .groupBy("wiki_label")
        .agg(F.sum("bot_count").alias("bot_count"), F.sum("human_count").alias("human_count"))
        .orderBy(F.col("human_count").desc(), F.col("wiki_label").asc())
        .limit(n)
    )


def _pivot_sum(df: DataFrame, index: str, column: str, value: str, values: list) -> DataFrame:
    """Wide pivot with 0 for missing cells; every index value keeps a row.

    Output columns after the index are positional (``values`` order) so labels
    that differ only in case do not clash on name resolution.
    """
    wide = df.groupBy(index).pivot(column, values).agg(F.sum(value)).na.fill(0)
    return wide.toDF(index, *[f"_p{i}" for i in range(len(values))])


def _pivot_long(wide: DataFrame, index: str, column: str, value: str, values: list) -> DataFrame:
    if not values:
        return wide.select(F.col(index), F.lit(None).cast("string").alias(column),
                           F.lit(None).cast("bigint").alias(value)).limit(0)
    cells = F.array(*[
        F.struct(F.lit(v).alias(column), F.col(f"_p{i}").cast("bigint").alias(value)) for i, v in enumerate(values)
    ])
    return wide.select(index, F.inline(cells))


def volume_pivot(totals: DataFrame, n: int = 6) -> tuple[DataFrame, list]:
    """Q11: window x label volume for the ``n`` largest labels, 0-filled.

    The ``n`` labels are ranked first (Q9), so only ``n`` values are pivoted.
    Returns (wide frame with positional columns, label list).
    """
    labels = [r["wiki_label"] for r in top_wikis(totals, n).collect()]
    clean = _no_null(totals, "window_end", "wiki_label")
    if not labels:
        return clean.select("window_end").distinct(), labels
    # Rows of other labels still form their window's group, so every window
    # keeps a (zero-filled) row without a join against the window list.
    return _pivot_sum(clean, "window_end", "wiki_label", "edit_count", labels), labels


def volume_pivot_long(totals: DataFrame, n: int = 6) -> DataFrame:
    wide, labels = volume_pivot(totals, n)
    return _pivot_long(wide, "window_end", "wiki_label", "edit_count", labels)


def volume_pivot_wide(totals: DataFrame, n: int = 6) -> DataFrame:
    wide, labels = volume_pivot(totals, n)
    return wide.toDF("window_end", *labels) if labels else wide


def burst_windows(totals: DataFrame, n: int = 20) -> DataFrame:
    """Q12: flagged rows, largest first (empty when nothing is flagged)."""
    return (
        totals.filter(F.col("anomaly_flag"))
        .orderBy(F.col("edit_count").desc(), F.col("window_end").asc(), F.col("wiki").asc())
        .limit(n)
    )


# ---- Q13-Q16: action reports --------------------------------------------------

def event_mix_long(actions: DataFrame) -> DataFrame:
    """Q13: sums per window and event type, one row per pair that occurs.

    Types are free text of the feed, so their number has no bound: the long form takes one
    aggregate however many there are.  ``event_mix_wide`` fills the missing pairs with 0.
    """
    clean = _no_null(actions, "window_end", "event_type")
    return clean.groupBy("window_end", "event_type").agg(F.sum("event_count").alias("event_count"))


def event_mix_wide(actions: DataFrame, types: list) -> DataFrame:
    """Q13 for display: window x the given types, 0-filled, positional columns in the order of ``types``."""
    clean = _no_null(actions, "window_end", "event_type")
    return _pivot_sum(clean, "window_end", "event_type", "event_count", types)


def type_totals(actions: DataFrame) -> DataFrame:
    """Q14: summed events per type, descending."""
    return (
        _no_null(actions, "event_type")
        .groupBy("event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.col("event_count").desc(), F.col("event_type").asc())
    )


def minor_share(actions: DataFrame, edit_type: str = "edit") -> DataFrame:
    """Q15: minor share of edits per window; the type test is case-insensitive."""
    edits = actions.filter(F.lower(F.coalesce(F.col("event_type"), F.lit(""))) == F.lit(edit_type.lower()))
    return (
        _no_null(edits, "window_end")
        .groupBy("window_end")
        .agg(F.sum("minor_count").alias("minor_count"), F.sum("event_count").alias("event_count"))
        .withColumn(
            "minor_share",
            F.col("minor_count").cast("double") / F.greatest(F.col("event_count"), F.lit(1)).cast("double"),
        )
        .orderBy("window_end")
    )


def log_share(actions: DataFrame, log_type: str = "log", edit_type: str = "edit", n: int = 12) -> DataFrame:
    """Q16: labels with the highest ``log / max(log + edit, 1)``; case-sensitive.

    Shown only when both types occur somewhere in the view; labels with
    neither type stay with share 0.
    """
    clean = _no_null(actions, "wiki_label", "event_type")
    is_log = F.col("event_type") == F.lit(log_type)
    is_edit = F.col("event_type") == F.lit(edit_type)
    both_present = clean.agg((F.max(is_log.cast("int")) == 1) & (F.max(is_edit.cast("int")) == 1)).scalar()
    per_label = clean.groupBy("wiki_label").agg(
        F.sum(F.when(is_log, F.col("event_count")).otherwise(F.lit(0))).alias("log_count"),
        F.sum(F.when(is_edit, F.col("event_count")).otherwise(F.lit(0))).alias("edit_count"),
    )
    return (
        per_label.withColumn(
            "log_share",
            F.col("log_count").cast("double")
            / F.greatest(F.col("log_count") + F.col("edit_count"), F.lit(1)).cast("double"),
        )
        .filter(F.coalesce(both_present, F.lit(False)))
        .orderBy(F.col("log_share").desc(), F.col("wiki_label").asc())
        .limit(n)
    )


# ---- Q2: catalog row estimate ----------------------------------------------------

def row_estimate(spark, table_name: str) -> int | None:
    """Q2: row count from catalog statistics (``ANALYZE TABLE ... COMPUTE
    STATISTICS``); None when the table is missing or was never analysed."""
    if not spark.catalog.tableExists(table_name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").filter(F.col("col_name") == "Statistics").collect()
    if not rows:
        return None
    text = rows[0]["data_type"] or ""
    for part in text.split(","):
        part = part.strip()
        if part.endswith(" rows"):
            return int(part[: -len(" rows")].strip())
    return None
