"""Q1-Q18 branches the oracle suite does not reach."""

import datetime as dt
import os


from conftest import SF_SMALL, plan_text
from tidemark.plans import reports, suite

SCHEMA = ("window_end timestamp, wiki string, wiki_label string, language string, edit_count long, "
          "bot_count long, human_count long, anomaly_flag boolean, updated_at timestamp")
ASCHEMA = ("window_end timestamp, wiki string, wiki_label string, language string, event_type string, "
           "event_count long, bot_count long, human_count long, minor_count long, updated_at timestamp")


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def test_lookback_inclusive_and_fallback(spark):
    df = spark.createDataFrame(
        [(_t(1), "a", "A", "x", 1, 0, 1, False, _t(2)), (_t(3), "a", "A", "x", 2, 0, 2, False, _t(4))], SCHEMA
    )
    view = reports.lookback(df, _t(5), minutes=240)  # 01:00 is exactly 240 minutes before 05:00
    assert [r["edit_count"] for r in view.collect()] == [1, 2]
    rows, used = reports.lookback_or_latest(df, _t(5), minutes=60, n=1)
    assert used is True and [r["edit_count"] for r in rows.collect()] == [2]
    rows, used = reports.lookback_or_latest(df, _t(5), minutes=180, n=1)
    assert used is False and rows.count() == 1
    empty = df.limit(0)
    rows, used = reports.lookback_or_latest(empty, _t(5), minutes=60)
    assert used is False and rows.count() == 0


def test_staleness_null_on_empty_and_stale_flag(spark):
    df = spark.createDataFrame([(_t(1), "a", "A", "x", 1, 0, 1, False, _t(2))], SCHEMA)
    r = reports.staleness(df, _t(3), 15).first()
    assert r["age_minutes"] == 60.0 and r["is_stale"] is True
    r = reports.staleness(df, _t(1), 15).first()
    assert r["age_minutes"] == 0.0 and r["is_stale"] is False  # floored at 0
    r = reports.staleness(df.limit(0), _t(3), 15).first()
    assert r["age_minutes"] is None and r["is_stale"] is None


def test_volume_pivot_wide_keeps_every_window(spark):
    df = spark.createDataFrame(
        [
            (_t(1), "a", "A", "x", 5, 0, 5, False, _t(2)),
            (_t(1), "b", "B", "x", 1, 0, 1, False, _t(2)),
            (_t(2), "b", "B", "x", 2, 0, 2, False, _t(3)),
            (_t(3), "c", "C", "x", 1, 0, 1, False, _t(4)),
        ],
        SCHEMA,
    )
    wide = reports.volume_pivot_wide(df, n=2)
    assert wide.columns == ["window_end", "A", "B"]
    got = {r["window_end"]: (r["A"], r["B"]) for r in wide.collect()}
    assert got == {_t(1): (5, 1), _t(2): (0, 2), _t(3): (0, 0)}


def test_event_mix_case_distinct_types(spark):
    df = spark.createDataFrame(
        [(_t(1), "a", "A", "x", "edit", 2, 0, 2, 0, _t(2)), (_t(1), "a", "A", "x", "Edit", 3, 0, 3, 0, _t(2)),
         (_t(2), "a", "A", "x", "log", 1, 0, 1, 0, _t(3))],
        ASCHEMA,
    )
    got = {(r["window_end"], r["event_type"]): r["event_count"] for r in reports.event_mix_long(df).collect()}
    assert got == {(_t(1), "Edit"): 3, (_t(1), "edit"): 2, (_t(2), "log"): 1}
    wide = reports.event_mix_wide(df, ["Edit", "edit", "log"]).orderBy("window_end").collect()
    assert [tuple(r) for r in wide] == [(_t(1), 3, 2, 0), (_t(2), 0, 0, 1)]


def test_event_mix_of_many_types(spark):
    from pyspark.sql import functions as F

    types = spark.range(12_000).select(
        F.lit(_t(1)).alias("window_end"), F.concat(F.lit("t"), "id").alias("event_type"), F.lit(2).cast("long").alias("event_count")
    )
    assert reports.event_mix_long(types.union(types)).filter("event_count = 4").count() == 12_000


def test_log_share_needs_both_types(spark):
    only_edit = spark.createDataFrame([(_t(1), "a", "A", "x", "edit", 2, 0, 2, 0, _t(2))], ASCHEMA)
    assert reports.log_share(only_edit).count() == 0
    both = only_edit.union(spark.createDataFrame([(_t(1), "b", "B", "x", "log", 3, 0, 3, 0, _t(2)),
                                                  (_t(1), "c", "C", "x", "new", 3, 0, 3, 0, _t(2))], ASCHEMA))
    got = {r["wiki_label"]: r["log_share"] for r in reports.log_share(both).collect()}
    assert got == {"B": 1.0, "A": 0.0, "C": 0.0}


def test_minor_share_is_case_insensitive(spark):
    df = spark.createDataFrame(
        [(_t(1), "a", "A", "x", "EDIT", 4, 0, 4, 1, _t(2)), (_t(1), "b", "B", "x", "edit", 0, 0, 0, 0, _t(2))],
        ASCHEMA,
    )
    r = reports.minor_share(df).first()
    assert (r["minor_count"], r["event_count"], r["minor_share"]) == (1, 4, 0.25)


def test_table_row_estimate_from_catalog(spark, tmp_dir):  # Q2
    t = suite._totals(spark, SF_SMALL)
    t.write.mode("overwrite").parquet(f"{tmp_dir}/t")
    spark.sql(f"CREATE TABLE q2_totals USING PARQUET LOCATION '{tmp_dir}/t'")
    spark.sql("ANALYZE TABLE q2_totals COMPUTE STATISTICS")
    assert reports.row_estimate(spark, "q2_totals") == t.count()
    assert reports.row_estimate(spark, "no_such_table") is None


def _files_under(spark):
    from tidemark.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    return sum(len(files) for _, _, files in os.walk(root))


def test_dashboard_refresh_from_warehouse(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tidemark.plans.backfill import WarehousePaths, current_actions, current_totals, run_backfill
    from tidemark.plans.dashboard import refresh
    from tidemark.sinks.warehouse import read_rollup
    from tidemark.sources import synthetic

    cfg = suite.QUERY_CONFIG
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    paths = run_backfill(spark, synthetic.raw_events(events, keep_id=False), suite._lookup(spark, SF_SMALL),
                         WarehousePaths(tmp_dir), "all", cfg)
    totals, actions = current_totals(spark, paths), current_actions(spark, paths)
    as_of = totals.agg(F.max("window_end")).first()[0]
    before = _files_under(spark)
    d = refresh(spark, totals, actions, as_of, cfg, read_rollup(spark, paths.totals))
    assert d.totals_fallback is False and d.actions_fallback is False
    n_view = d.totals.count()
    assert 0 < n_view <= totals.count()
    assert d.top_wikis.count() == 15 and d.recent_totals.count() == min(150, n_view)
    assert sum(r["edit_count"] for r in d.top_wikis.collect()) <= d.totals.agg(F.sum("edit_count")).first()[0]
    assert d.volume_pivot.count() == d.totals.select("window_end").distinct().count()
    assert d.stats.first()["total_rows"] == totals.count()
    assert "Window" not in plan_text(d.stats) and "Window" not in plan_text(d.staleness)
    assert _files_under(spark) == before  # a refresh leaves nothing on the shared folder
    d.release()
    # far in the future: the look-back is empty, the latest rows are shown instead
    later = refresh(spark, totals, actions, as_of + dt.timedelta(days=60), cfg)
    assert later.totals_fallback is True and later.totals.count() == min(cfg.latest_rows, totals.count())
    # updated_at is the real write time (after as_of): the age is floored at 0
    assert later.staleness.first()["age_minutes"] == 0.0 and later.staleness.first()["is_stale"] is False
