"""K1-K4 idempotent sink + current view, S6 warehouse table, S2 backfill."""

import datetime as dt
import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.current import current_view
from tidemark.plans import suite
from tidemark.plans.backfill import WarehousePaths, current_totals, run_backfill
from tidemark.sinks.warehouse import read_rollup, write_batch
from tidemark.sources import synthetic
from tidemark.sources.warehouse import register_table
from tidemark.schemas import TOTALS_COLUMNS

SCHEMA = ("window_end timestamp, wiki string, wiki_label string, language string, edit_count long, "
          "bot_count long, human_count long, anomaly_flag boolean")


def _totals(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_retry_replaces_and_current_view_picks_latest(spark, tmp_dir):
    w = dt.datetime(2024, 1, 1, 0, 1)
    b0 = _totals(spark, [(w, "a", "a", "x", 1, 0, 1, False), (w, "b", "b", "x", 2, 0, 2, False)])
    b1 = _totals(spark, [(w, "a", "a", "x", 5, 1, 4, False)])
    path = f"{tmp_dir}/totals"
    write_batch(b0, path, "r", 0, updated_at=F.lit(dt.datetime(2024, 1, 1, 0, 2)))
    write_batch(b0, path, "r", 0, updated_at=F.lit(dt.datetime(2024, 1, 1, 0, 2)))  # retried batch
    write_batch(b1, path, "r", 1, updated_at=F.lit(dt.datetime(2024, 1, 1, 0, 3)))
    stored = read_rollup(spark, path)
    assert stored.count() == 3
    cur = {r["wiki"]: r for r in current_view(stored).collect()}
    assert len(cur) == 2 and cur["a"]["edit_count"] == 5 and cur["a"]["batch_id"] == 1
    assert cur["b"]["batch_id"] == 0
    assert cur["a"]["window_end_ts"] == "2024-01-01 00:01:00" and cur["a"]["ds"] == "2024-01-01"


def test_new_run_does_not_overwrite_old_run(spark, tmp_dir):
    w = dt.datetime(2024, 1, 1, 0, 1)
    path = f"{tmp_dir}/totals"
    write_batch(_totals(spark, [(w, "a", "a", "x", 1, 0, 1, False)]), path, "run1", 0)
    write_batch(_totals(spark, [(w, "b", "b", "x", 1, 0, 1, False)]), path, "run2", 0)
    assert read_rollup(spark, path).count() == 2


def test_warehouse_table_partitions_and_pruning(spark, tmp_dir):
    w1, w2 = dt.datetime(2024, 1, 1, 5, 1), dt.datetime(2024, 1, 2, 7, 1)
    path = f"{tmp_dir}/totals"
    write_batch(_totals(spark, [(w1, "a", "a", "x", 1, 0, 1, False), (w2, "a", "a", "x", 2, 0, 2, False)]),
                path, "r", 0)
    register_table(spark, "wh_test", path)
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS wh_test").collect())
    assert parts == ["ds=2024-01-01/hr=05/run_id=r/batch_id=0", "ds=2024-01-02/hr=07/run_id=r/batch_id=0"]
    pruned = spark.table("wh_test").filter(F.col("ds") >= "2024-01-02")
    assert [r["edit_count"] for r in pruned.collect()] == [2]
    from conftest import plan_text

    assert "PartitionFilters: [isnotnull(ds" in plan_text(pruned)
    assert spark.table("wh_test_current").count() == 2


def test_backfill_equals_batch_rollup(spark, tmp_dir):
    cfg = suite.QUERY_CONFIG
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lookup = suite._lookup(spark, SF_SMALL)
    paths = run_backfill(spark, synthetic.raw_events(events, keep_id=False), lookup, WarehousePaths(tmp_dir), "all", cfg)
    stored = current_totals(spark, paths).select(*TOTALS_COLUMNS)
    direct = suite.totals_rollup(suite._parsed(spark, SF_SMALL), lookup, cfg)
    assert stored.exceptAll(direct).count() == 0 and direct.exceptAll(stored).count() == 0
    # a re-run of the same batch replaces itself
    run_backfill(spark, synthetic.raw_events(events, keep_id=False), lookup, paths, "all", cfg)
    assert read_rollup(spark, paths.totals).count() == direct.count()


def test_stored_window_end_independent_of_os_zone(tmp_dir):  # B1
    code = f"""
import sys, datetime as dt
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from tidemark.session import build_session
from tidemark.sinks.warehouse import write_batch, read_rollup
spark = build_session("local[1]")
df = spark.sql("SELECT TIMESTAMP'2024-01-01 12:00:00' AS window_end, 'a' AS wiki, 'a' AS wiki_label, "
               "'x' AS language, 1L AS edit_count, 0L AS bot_count, 1L AS human_count, false AS anomaly_flag")
write_batch(df, {tmp_dir!r} + "/t", "r", 0)
r = read_rollup(spark, {tmp_dir!r} + "/t").first()
print("RESULT", r["window_end_ts"], r["ds"], r["hr"])
"""
    env = dict(os.environ, TZ="America/Chicago")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "RESULT 2024-01-01 12:00:00 2024-01-01 12" in out.stdout, out.stderr[-2000:]


def test_two_backfills_of_one_hour_both_stay(spark, tmp_dir):  # S2
    from tidemark.config import DEFAULT
    from tidemark.plans.backfill import input_run_id

    lookup = spark.createDataFrame([("ok", "OK", "en")], "lk_wiki_key string, lk_wiki_label string, lk_language string")
    paths = WarehousePaths(tmp_dir)
    for run_id, wikis in (("one", "ac"), ("two", "d"), ("two", "d")):
        raw = spark.createDataFrame([(f'{{"wiki":"{w}","timestamp":60}}',) for w in wikis], "raw string")
        run_backfill(spark, raw, lookup, paths, run_id, DEFAULT)
    assert sorted(r["wiki"] for r in current_totals(spark, paths).collect()) == ["a", "c", "d"]
    assert read_rollup(spark, paths.totals).count() == 3
    assert input_run_id(["b", "a"]) == input_run_id(["a", "b"]) != input_run_id(["a"])


def test_contract_rows_stay_and_are_listed(spark, tmp_dir):  # K5 per batch
    from tidemark.config import DEFAULT

    rows = ['{"wiki":"' + "w" * 300 + '","timestamp":60}', '{"wiki":"ok","timestamp":60}']
    raw = spark.createDataFrame([(r,) for r in rows], "raw string")
    lookup = spark.createDataFrame([("ok", "OK", "en")], "lk_wiki_key string, lk_wiki_label string, lk_language string")
    paths = run_backfill(spark, raw, lookup, WarehousePaths(tmp_dir), "r", DEFAULT)
    assert sorted(r["wiki"] for r in current_totals(spark, paths).collect()) == ["ok", "w" * 300]
    q = spark.read.parquet(paths.violations).collect()
    assert len(q) == 1 and q[0]["contract_reason"] == "wiki_too_long"
    from tidemark.plans.backfill import current_actions
    from tidemark.sinks.delivery import deliverable, delivery_actions

    good, bad = deliverable(delivery_actions(current_actions(spark, paths)))
    assert [r["wiki"] for r in good.collect()] == ["ok"] and bad.count() == 1
    import pytest

    with pytest.raises(ValueError, match="wiki_too_long"):
        run_backfill(spark, raw, lookup, WarehousePaths(tmp_dir + "/f"), "r", DEFAULT.with_(contract_mode="fail"))


def test_batches_register_their_partitions(spark, tmp_dir):  # S6 without MSCK at scale
    from tidemark.config import DEFAULT
    from tidemark.plans.backfill import write_rollups

    spark.sql("DROP TABLE IF EXISTS wh_reg_totals")
    spark.sql("DROP TABLE IF EXISTS wh_reg_actions")
    paths = WarehousePaths(tmp_dir)
    acts = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 5, 1), "a", "A", "x", "edit", 2, 0, 2, 1)],
        "window_end timestamp, wiki string, wiki_label string, language string, event_type string, "
        "event_count long, bot_count long, human_count long, minor_count long",
    )
    cfg = DEFAULT.with_(totals_table="wh_reg_totals", actions_table="wh_reg_actions")
    # tables are declared before the first batch lands (V1)
    register_table(spark, "wh_reg_totals", paths.totals, "totals")
    register_table(spark, "wh_reg_actions", paths.actions, "actions")
    write_rollups(spark, acts, paths, "run", 7, cfg)
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS wh_reg_totals").collect()]
    assert parts == ["ds=2024-01-01/hr=05/run_id=run/batch_id=7"]
    assert [r["edit_count"] for r in spark.table("wh_reg_totals_current").collect()] == [2]
    assert spark.table("wh_reg_actions").count() == 1


def test_compaction_keeps_current_view(spark, tmp_dir):
    from tidemark.sinks.compaction import compact_day

    spark.sql("DROP TABLE IF EXISTS wh_compact")
    path = f"{tmp_dir}/t"
    register_table(spark, "wh_compact", path)
    w1, w2 = dt.datetime(2024, 1, 1, 5, 1), dt.datetime(2024, 1, 1, 6, 1)
    write_batch(_totals(spark, [(w1, "a", "a", "x", 1, 0, 1, False), (w2, "b", "b", "x", 1, 0, 1, False)]), path, "r",
                0, updated_at=F.lit(dt.datetime(2024, 1, 1, 7)), table="wh_compact")
    write_batch(_totals(spark, [(w1, "a", "a", "x", 5, 0, 5, False)]), path, "r", 1,
                updated_at=F.lit(dt.datetime(2024, 1, 1, 8)), table="wh_compact")
    before = sorted((r["wiki"], r["edit_count"]) for r in spark.table("wh_compact_current").collect())
    assert before == [("a", 5), ("b", 1)]
    dropped = compact_day(spark, "wh_compact", path, "2024-01-01")
    assert dropped == 3
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS wh_compact").collect())
    assert parts == ["ds=2024-01-01/hr=05/run_id=compacted/batch_id=0", "ds=2024-01-01/hr=06/run_id=compacted/batch_id=0"]
    after = sorted((r["wiki"], r["edit_count"]) for r in spark.table("wh_compact_current").collect())
    assert after == before and spark.table("wh_compact").count() == 2
    by_path = sorted((r["wiki"], r["edit_count"]) for r in current_view(read_rollup(spark, path)).collect())
    assert by_path == before
    assert compact_day(spark, "wh_compact", path, "2024-01-01") == 0  # idempotent
    assert sorted((r["wiki"], r["edit_count"]) for r in spark.table("wh_compact_current").collect()) == before


def test_many_batches_one_partition_per_hour(spark, tmp_dir):
    """As the job does it: closed hours end as one partition each; the newest hour stays open."""
    from tidemark.streaming.job import compact

    spark.sql("DROP TABLE IF EXISTS wh_many")
    path = f"{tmp_dir}/t"
    register_table(spark, "wh_many", path)

    def batch(batch_id, hour, minute):
        end = dt.datetime(2024, 1, 1, hour, minute)
        write_batch(_totals(spark, [(end, "a", "a", "x", batch_id, 0, batch_id, False)]), path, "r", batch_id, table="wh_many")

    def per_hour():
        hours = [r[0].split("/")[1] for r in spark.sql("SHOW PARTITIONS wh_many").collect()]
        return {h: hours.count(h) for h in sorted(set(hours))}

    for i in range(9):
        batch(i, 5 + i // 4, 1 + i % 4)
    assert per_hour() == {"hr=05": 4, "hr=06": 4, "hr=07": 1}
    compact(spark, [("wh_many", path, "totals")])
    assert per_hour() == {"hr=05": 1, "hr=06": 1, "hr=07": 1}
    batch(9, 5, 1)  # a replay of a closed window
    compact(spark, [("wh_many", path, "totals")])
    assert per_hour() == {"hr=05": 1, "hr=06": 1, "hr=07": 1}
    rows = {r["window_end_ts"]: r["edit_count"] for r in spark.table("wh_many").collect()}
    assert len(rows) == 9 and rows["2024-01-01 05:01:00"] == 9


def test_lookup_measured_once_per_version(spark, tmp_dir, monkeypatch):
    from tidemark.sources.lookup import lookup_version, read_lookup_csv
    from tidemark.streaming import rollup_stream

    file = f"{tmp_dir}/l.csv"
    calls = []
    real = rollup_stream.prepare_lookup
    monkeypatch.setattr(rollup_stream, "prepare_lookup", lambda *a: calls.append(1) or real(*a))
    events = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 5, 1), "a", "edit", 1, 0, 0)],
        "window_end timestamp, wiki string, event_type string, event_count long, bot_count long, minor_count long",
    )
    paths = WarehousePaths(f"{tmp_dir}/wh")
    write = rollup_stream.batch_writer(spark, lambda: read_lookup_csv(spark, file), paths, "r",
                                       lookup_version=lambda: lookup_version(spark, file))
    for batch_id, label in enumerate(["A", "A", "Longer"]):
        with open(file, "w") as f:
            f.write(f"wiki_key,wiki_label,language\na,{label},x\n")
        os.utime(file, (1_700_000_000, 1_700_000_000))  # the length tells the versions apart
        write(events, batch_id)
    assert len(calls) == 2
    assert [r["wiki_label"] for r in current_totals(spark, paths).collect()] == ["Longer"]
