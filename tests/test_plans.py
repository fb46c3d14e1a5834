"""Plan-shape assertions: the physical plans we want at scale."""

import re

from conftest import SF_SMALL, plan_text
from tidemark.plans import suite
from tidemark.streaming.rollup_stream import windowed_actions
from tidemark.sources.files import text_stream


def _count(pattern, text):
    return len(re.findall(pattern, text))


def test_totals_plan_shape(spark):
    text = plan_text(suite.q_totals_rollup(spark, SF_SMALL))
    # the JSON text is parsed exactly once, behind a Generate
    assert _count(r"from_json\(", text.split("== Physical Plan ==")[-1].split("\n(1)")[0] + text) >= 1
    assert "Generate" in text and "inline(array(from_json" in text
    # partial + final hash aggregation around one shuffle on the event side
    assert _count(r"HashAggregate \(", text) >= 2
    assert "hashpartitioning(window" in text
    # enrichment after the aggregate, as a broadcast hash join
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    # column pruning at the scan: only the four columns the mapping reads
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_filters_stay_above_the_parse(spark):
    text = plan_text(suite.q_totals_rollup(spark, SF_SMALL), "extended")
    physical = text.split("== Physical Plan ==")[-1]
    # no predicate re-derives the JSON: exactly one from_json in the physical plan
    assert _count(r"from_json\(", physical) == 1


def test_lookback_on_warehouse_prunes_partitions(spark, tmp_dir):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.plans import reports
    from tidemark.sinks.warehouse import read_rollup, write_batch

    rows = suite._totals(spark, SF_SMALL).drop("updated_at", "ds")
    write_batch(rows, f"{tmp_dir}/t", "r", 0)
    stored = read_rollup(spark, f"{tmp_dir}/t")
    view = reports.lookback(stored, dt.datetime(2024, 1, 31), 10_080)
    text = plan_text(view)
    assert "PartitionFilters: [isnotnull(ds" in text and "(ds#" in text
    assert "PushedFilters: [IsNotNull(window_end), GreaterThanOrEqual(window_end" in text
    assert view.filter(F.col("window_end") < F.lit(dt.datetime(2024, 1, 24))).count() == 0


def test_streaming_plan_is_one_stateful_aggregate(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    stream = windowed_actions(text_stream(spark, f"{tmp_dir}/in"), suite.QUERY_CONFIG)
    assert stream.isStreaming
    text = plan_text(stream, "extended")
    assert _count(r"EventTimeWatermark", text) >= 1
    assert "Join" not in text.split("== Physical Plan ==")[-1]  # enrichment happens per batch, after the state


def test_lookback_over_current_view_prunes_partitions(spark, tmp_dir):
    import datetime as dt

    from tidemark.operators.current import current_view
    from tidemark.plans import reports
    from tidemark.sinks.warehouse import read_rollup, write_batch

    write_batch(suite._totals(spark, SF_SMALL).drop("updated_at"), f"{tmp_dir}/t", "r", 0)
    view = reports.lookback(current_view(read_rollup(spark, f"{tmp_dir}/t")), dt.datetime(2024, 1, 31), 10_080)
    text = plan_text(view)
    assert re.search(r"PartitionFilters: \[isnotnull\(ds#\d+\), \(ds#\d+ >= 2024-01-24\)\]", text)
    assert "WindowGroupLimit" in text  # best version per key kept before the shuffle
