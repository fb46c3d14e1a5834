"""Statistics per partition, newest rows by walking hours, the current table kept batch by batch, start and preflight."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.current import current_view
from tidemark.plans import newest, reports
from tidemark.sinks.current_table import _location, create_current_table, merge_batch, remove_superseded
from tidemark.sinks.partition_stats import estimates, hours, read_stats
from tidemark.sinks.warehouse import read_rollup, write_batch
from tidemark.sources.warehouse import drop_table, register_table
from tidemark.streaming.job import preflight

SCHEMA = "window_end timestamp, wiki string, wiki_label string, language string, edit_count long, bot_count long, human_count long, anomaly_flag boolean"
DAY = dt.datetime(2024, 1, 1)


def _rows(spark, cells):
    """(hour, wiki, count) -> totals rows."""
    made = [(DAY + dt.timedelta(hours=h), w, w, "x", n, 0, n, False) for h, w, n in cells]
    return spark.createDataFrame(made, SCHEMA)


def _at(minutes):
    return F.lit(DAY + dt.timedelta(days=9, minutes=minutes))


def _history(spark, path):
    """60 hours of three wikis, then a late batch that rewrites one old hour."""
    write_batch(_rows(spark, [(h, w, h) for h in range(60) for w in "abc"]), path, "r", 0,
                updated_at=F.col("window_end") + F.expr("INTERVAL 2 MINUTES"), stats=True)
    write_batch(_rows(spark, [(3, "a", 77), (3, "d", 1)]), path, "r", 1, updated_at=_at(0), stats=True)
    return read_rollup(spark, path)


# ---- statistics ---------------------------------------------------------------

def test_estimates_count_rows_and_not_versions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    _history(spark, path)
    write_batch(_rows(spark, [(3, "a", 78)]), path, "r", 2, updated_at=_at(1), stats=True)
    write_batch(_rows(spark, [(3, "a", 78)]), path, "r", 2, updated_at=_at(1), stats=True)  # retried
    row = estimates(spark, path).first()
    assert row["stored_rows"] == read_rollup(spark, path).count() == 183
    assert row["estimated_rows"] == current_view(read_rollup(spark, path)).count() == 181
    assert row["last_upsert"] == DAY + dt.timedelta(days=9, minutes=1) and row["newest_window_end"] == DAY + dt.timedelta(hours=59)
    assert hours(spark, path).count() == 60


def test_estimate_error_is_within_two_percent(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    many = spark.range(40_000).select(
        F.lit(DAY).alias("window_end"), F.col("id").cast("string").alias("wiki"), F.lit("l").alias("wiki_label"), F.lit("x").alias("language"),
        F.lit(1).cast("long").alias("edit_count"), F.lit(0).cast("long").alias("bot_count"), F.lit(1).cast("long").alias("human_count"), F.lit(False).alias("anomaly_flag"))
    for batch in range(2):
        write_batch(many, path, "r", batch, stats=True)
    row = estimates(spark, path).first()
    assert row["stored_rows"] == 80_000 and abs(row["estimated_rows"] - 40_000) < 800
    stamps = {r[0] for r in read_rollup(spark, path).select("updated_at").distinct().collect()}
    assert {r["newest_update"] for r in read_stats(spark, path).collect()} == stamps  # rows and statistics share the stamp


def test_empty_batch_and_null_keys(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_batch(_rows(spark, []), path, "r", 0, stats=True)
    assert tuple(estimates(spark, path).first()) == (0, 0, None, None)
    assert newest.latest_rows(spark, path).collect() == [] and newest.recent_rows(spark, path).collect() == []
    write_batch(_rows(spark, [(0, None, 1), (0, "null", 1)]), path, "r", 1, stats=True)
    assert estimates(spark, path).first()["estimated_rows"] == 2


# ---- newest rows ------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 30, 181, 500])
def test_newest_rows_equal_the_whole_view(spark, tmp_dir, n):
    path = f"{tmp_dir}/t"
    view = current_view(_history(spark, path))
    assert newest.latest_rows(spark, path, "totals", n).collect() == reports.latest(view, n).select(*newest.latest_rows(spark, path, "totals", n).columns).collect()
    assert newest.recent_rows(spark, path, "totals", n).collect() == reports.recent_rows(view, n).select(*view.columns).collect()


def test_few_hours_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    _history(spark, path)
    rows = newest.latest_rows(spark, path, "totals", 4)
    read = {f.split("ds=")[1].split("/run_id")[0] for f in rows.inputFiles()}
    assert "2024-01-01/hr=03" in read and len(read) == newest.FIRST_HOURS
    assert len({f.split("ds=")[1].split("/run_id")[0] for f in newest.recent_rows(spark, path, "totals", 6).inputFiles()}) == newest.FIRST_HOURS


def test_equal_update_times_are_read_to_the_end(spark, tmp_dir):
    """All hours have one update time: no hour can be left out, and ties are broken by key."""
    path = f"{tmp_dir}/t"
    write_batch(_rows(spark, [(h, "a", h) for h in range(30)]), path, "r", 0, updated_at=_at(0), stats=True)
    assert [r["edit_count"] for r in newest.latest_rows(spark, path, "totals", 3).collect()] == [0, 1, 2]


# ---- the current table -----------------------------------------------------------------

@pytest.fixture()
def name(spark):
    table = f"cur_{uuid.uuid4().hex[:8]}"
    yield table
    drop_table(spark, table)


def _merge(spark, name, tmp_dir, batch, cells, minutes):
    versions = f"{tmp_dir}/versions"
    write_batch(_rows(spark, cells), versions, "r", batch, updated_at=_at(minutes))
    return merge_batch(spark, name, f"{tmp_dir}/current", read_rollup(spark, versions).where(F.col("batch_id") == batch))


def test_only_touched_hours_are_rewritten(spark, tmp_dir, name):
    create_current_table(spark, name, f"{tmp_dir}/current")
    assert len(_merge(spark, name, tmp_dir, 0, [(h, w, h) for h in range(5) for w in "ab"], 0)) == 5
    before = {h: _location(spark, name, "2024-01-01", f"0{h}") for h in range(5)}
    assert _merge(spark, name, tmp_dir, 1, [(2, "a", 50), (2, "c", 51), (7, "a", 52)], 1) == [("2024-01-01", "02"), ("2024-01-01", "07")]
    after = {h: _location(spark, name, "2024-01-01", f"0{h}") for h in range(5)}
    assert {h for h in range(5) if before[h] != after[h]} == {2}
    assert _merge(spark, name, tmp_dir, 1, [(2, "a", 50), (2, "c", 51), (7, "a", 52)], 1) == []  # repeated
    assert _merge(spark, name, tmp_dir, 2, [(2, "a", 1), (4, "b", 1)], -5) == []  # late and older than what is there
    table = spark.table(name)
    want = current_view(read_rollup(spark, f"{tmp_dir}/versions")).select(*table.columns)
    assert table.exceptAll(want).isEmpty() and want.exceptAll(table).isEmpty()
    assert _merge(spark, name, tmp_dir, 3, [], 3) == []


def test_superseded_files_go_after_the_retention(spark, tmp_dir, name):
    create_current_table(spark, name, f"{tmp_dir}/current")
    for batch in range(3):
        _merge(spark, name, tmp_dir, batch, [(1, "a", batch), (batch + 4, "b", batch)], batch)
    rows = sorted(map(str, spark.table(name).collect()))
    assert remove_superseded(spark, name, f"{tmp_dir}/current", 3600) == 0
    assert remove_superseded(spark, name, f"{tmp_dir}/current", -60) == 2
    spark.catalog.refreshTable(name)
    assert sorted(map(str, spark.table(name).collect())) == rows and len(rows) == 4


# ---- start and preflight -----------------------------------------------------------------

def test_second_start_keeps_compaction(spark, tmp_dir, name):
    from tidemark.sinks.compaction import compact_day

    path = f"{tmp_dir}/t"
    for batch in range(3):
        write_batch(_rows(spark, [(1, "a", batch), (2, "b", batch)]), path, "r", batch)
    register_table(spark, name, path)
    compact_day(spark, name, path, "2024-01-01")
    partitions = spark.sql(f"SHOW PARTITIONS {name}").count()
    register_table(spark, name, path)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == partitions == 2
    assert spark.table(f"{name}_current").count() == 2
    register_table(spark, name, path, rebuild=True)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 8


def test_preflight_can_fail(spark, tmp_dir, name):
    with pytest.raises(RuntimeError, match="missing"):
        preflight(spark, name, "totals")
    spark.sql(f"CREATE TABLE {name} (window_end timestamp, wiki string) USING PARQUET LOCATION '{tmp_dir}/odd'")
    with pytest.raises(RuntimeError, match="lacks the columns"):
        preflight(spark, name, "totals")
    spark.sql(f"DROP TABLE {name}")
    register_table(spark, name, f"{tmp_dir}/t")
    preflight(spark, name, "totals")
