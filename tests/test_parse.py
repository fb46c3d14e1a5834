"""Cell-level rules D1-D10 and the epoch/window fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import raw_df
from tidemark.config import DEFAULT
from tidemark.functions.parse import event_time, minor_flag, parse_events
from tidemark.functions.timefmt import partition_columns


def _parse(spark, rows):
    df = raw_df(spark, rows).withColumn("i", F.monotonically_increasing_id())
    out = parse_events(df, config=DEFAULT, keep=("raw",))
    return {r["raw"]: r for r in out.collect()}


def test_typed_row(spark):
    raw = '{"wiki":"enwiki","type":"edit","bot":true,"timestamp":1700000000,"minor":true}'
    r = _parse(spark, [raw])[raw]
    assert r["wiki"] == "enwiki" and r["bot"] is True and r["is_minor"] is True
    assert r["event_type"] == "edit"
    assert r["event_ts"] == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_mistyped_bot_is_false_minor_counts(spark):  # D2, D8
    raw = '{"wiki":"enwiki","type":"edit","bot":1,"timestamp":1700000000,"minor":1}'
    r = _parse(spark, [raw])[raw]
    assert r["bot"] is False and r["is_minor"] is True


def test_string_timestamp_dropped(spark):  # D3
    raw = '{"wiki":"enwiki","bot":"true","timestamp":"1700000000","minor":"TRUE "}'
    assert _parse(spark, [raw]) == {}


def test_coerced_wiki_and_type_ms_truncation(spark):  # D5, D6
    raw = '{"wiki":5,"type":{"a":1},"timestamp":1700000000123}'
    r = _parse(spark, [raw])[raw]
    assert r["wiki"] == "5" and r["event_type"] == '{"a":1}'
    assert r["event_ts"] == dt.datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize("raw", ["not json", "null", "[1]", '[{"wiki":"arr","timestamp":1}]', '{"wiki":"t"', None])
def test_unparseable_dropped(spark, raw):  # D1
    assert _parse(spark, [raw]) == {}


def test_case_sensitive_and_duplicate_keys(spark):  # D4
    a = '{"WIKI":"w","timestamp":1}'
    b = '{"wiki":"a","wiki":"b","timestamp":1}'
    got = _parse(spark, [a, b])
    assert a not in got and got[b]["wiki"] == "b"


def test_empty_wiki_kept_and_defaults(spark):  # D1, D7, D8
    raw = '{"wiki":"","timestamp":1e3,"minor":null}'
    r = _parse(spark, [raw])[raw]
    assert r["wiki"] == "" and r["is_minor"] is False and r["event_type"] == "unknown"
    assert r["bot"] is False


@pytest.mark.parametrize("raw", ['{"wiki":"w","timestamp":NaN}', '{"wiki":"w","timestamp":"NaN"}',
                                 '{"wiki":"w","timestamp":1.7e15}', '{"wiki":"w","timestamp":1e300}'])
def test_unusable_epoch_dropped_not_failed(spark, raw):  # B5, B6 (ANSI on)
    assert _parse(spark, [raw]) == {}


@pytest.mark.parametrize("type_value,expected", [('"  edit "', "edit"), ('"   "', "unknown"), (None, "unknown"),
                                                 ('"Edit"', "Edit")])
def test_type_normalisation(spark, type_value, expected):  # D7
    raw = '{"wiki":"w","timestamp":1' + (f',"type":{type_value}' if type_value else "") + "}"
    assert _parse(spark, [raw])[raw]["event_type"] == expected


def test_type_keeps_its_length_until_delivery(spark):  # P15 / B4
    from tidemark.functions.parse import delivered_type

    long_type = "x" * 80
    raw = '{"wiki":"w","timestamp":1,"type":"' + long_type + '"}'
    assert _parse(spark, [raw])[raw]["event_type"] == long_type
    types = ["x" * 80, "edit\n", "\t", "\u3000log\u00a0", None, "a b"]
    df = spark.createDataFrame([(t,) for t in types], "event_type string")
    got = [r[0] for r in df.select(delivered_type("event_type", 64)).collect()]
    assert got == ["x" * 64, "edit", "unknown", "log", "unknown", "a b"]


def test_minor_json_path_rule(spark):  # D8
    rows = ['{"minor":true}', '{"minor":1}', '{"minor":"TRUE "}', '{"minor":false}', '{"minor":"yes"}', '{}']
    got = [r[0] for r in raw_df(spark, rows).select(minor_flag("raw")).collect()]
    assert got == [True, True, True, False, False, False]


def test_epoch_boundaries(spark):  # D5, D6, P7
    df = spark.createDataFrame(
        [(1700000000.987,), (-5.5,), (float("nan"),), (float("inf"),), (9e14,), (None,)], "s double"
    )
    got = [r[0] for r in df.select(event_time("s")).collect()]
    assert got[0] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert got[1] == dt.datetime(1969, 12, 31, 23, 59, 55)
    assert got[2:] == [None, None, None, None]


def test_millis_cutoff_is_strict(spark):  # D5
    a = '{"wiki":"w","timestamp":1000000000000}'
    b = '{"wiki":"w","timestamp":1000000000001}'
    got = _parse(spark, [a, b])
    assert a not in got  # 1e12 seconds: beyond year 9999 -> dropped
    assert got[b]["event_unix_sec"] == pytest.approx(1000000000.001)


def test_window_boundaries(spark):  # D11
    from tidemark.operators.rollups import aggregate_totals

    rows = [
        '{"wiki":"w","timestamp":1700049600}',      # 12:00:00
        '{"wiki":"w","timestamp":1700049659999}',   # 12:00:59.999 (ms)
        '{"wiki":"w","timestamp":1700049660}',      # 12:01:00
    ]
    agg = aggregate_totals(parse_events(raw_df(spark, rows)), DEFAULT)
    got = {r["window_end"]: r["edit_count"] for r in agg.collect()}
    assert got == {dt.datetime(2023, 11, 15, 12, 1): 2, dt.datetime(2023, 11, 15, 12, 2): 1}


def test_partition_text(spark):  # P17
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "window_end timestamp")
    parts = partition_columns("window_end")
    r = df.select(*[v.alias(k) for k, v in parts.items()]).first()
    assert (r["window_end_ts"], r["ds"], r["hr"]) == ("2024-01-02 03:04:05", "2024-01-02", "03")


def test_max_future_guard(spark):  # B6: one far-future event must not drag the watermark
    rows = ['{"wiki":"w","timestamp":1700000000}', '{"wiki":"w","timestamp":4102444800}']  # 2023, 2100
    df = raw_df(spark, rows)
    assert parse_events(df, config=DEFAULT).count() == 2
    guarded = parse_events(df, config=DEFAULT.with_(max_future="1 day"))
    assert [r["event_ts"].year for r in guarded.collect()] == [2023]
