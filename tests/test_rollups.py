"""Rollup semantics and invariants on the given events."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, raw_df
from tidemark.config import DEFAULT
from tidemark.functions.parse import parse_events
from tidemark.operators.checks import contract_violations, lookup_dup_keys
from tidemark.operators.enrich import enrich, prepare_lookup
from tidemark.operators.rollups import (
    actions_rollup,
    actions_rollup_enriched,
    totals_from_actions,
    totals_rollup,
    totals_rollup_enriched,
)
from tidemark.plans import suite

CFG = suite.QUERY_CONFIG


def _lookup(spark, rows):
    return spark.createDataFrame(rows, "lk_wiki_key string, lk_wiki_label string, lk_language string")


def test_invariants_on_events(spark):
    parsed = suite._parsed(spark, SF_SMALL)
    lookup = suite._lookup(spark, SF_SMALL)
    totals = totals_rollup(parsed, lookup, CFG)
    actions = actions_rollup(parsed, lookup, CFG)
    assert totals.filter(F.col("bot_count") + F.col("human_count") != F.col("edit_count")).count() == 0
    assert actions.filter(F.col("minor_count") > F.col("event_count")).count() == 0
    derived = totals_from_actions(actions, CFG)
    assert derived.exceptAll(totals).count() == 0 and totals.exceptAll(derived).count() == 0
    assert totals.groupBy("window_end", "wiki").count().filter("count > 1").count() == 0
    n_events = parsed.count()
    assert totals.agg(F.sum("edit_count")).first()[0] == n_events


def test_aggregate_then_enrich_equals_reference_grain(spark):
    parsed = suite._parsed(spark, SF_SMALL)
    lookup = suite._lookup(spark, SF_SMALL)
    enriched = enrich(parsed, lookup)
    a = totals_rollup(parsed, lookup, CFG)
    b = totals_rollup_enriched(enriched, CFG)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = actions_rollup(parsed, lookup, CFG)
    d = actions_rollup_enriched(enriched, CFG)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_lookup_miss_and_null_cells(spark):  # D10
    rows = ['{"wiki":"enwiki","timestamp":60}', '{"wiki":"xxwiki","timestamp":60}', '{"wiki":"dewiki","timestamp":60}']
    lookup = _lookup(spark, [("enwiki", "English Wikipedia", "en"), ("dewiki", None, None)])
    out = {r["wiki"]: r for r in enrich(parse_events(raw_df(spark, rows)), lookup).collect()}
    assert (out["enwiki"]["wiki_label"], out["enwiki"]["language"]) == ("English Wikipedia", "en")
    assert (out["xxwiki"]["wiki_label"], out["xxwiki"]["language"]) == ("xxwiki", "unknown")
    assert (out["dewiki"]["wiki_label"], out["dewiki"]["language"]) == ("dewiki", "unknown")


def test_duplicate_lookup_keys_do_not_fan_out(spark):  # B3, V3
    lookup = _lookup(spark, [("enwiki", "B label", "en"), ("enwiki", "A label", "en"), (None, "x", "y")])
    assert [r["lk_wiki_key"] for r in lookup_dup_keys(lookup).collect()] == ["enwiki"]
    rows = ['{"wiki":"enwiki","timestamp":60}'] * 3
    totals = totals_rollup(parse_events(raw_df(spark, rows)), lookup, DEFAULT).collect()
    assert len(totals) == 1 and totals[0]["edit_count"] == 3 and totals[0]["wiki_label"] == "A label"


def test_labelled_row_beats_one_without(spark):  # B3
    from tidemark.sources.lookup import dedupe_lookup

    rows = [("a", None, "x"), ("a", "English", "en"), ("a", "English", None), ("b", None, None)]
    got = {r[0]: (r[1], r[2]) for r in dedupe_lookup(_lookup(spark, rows)).collect()}
    assert got == {"a": ("English", "en"), "b": (None, None)}


def test_threshold_inclusive_and_minor_all_types(spark):  # D9, D12
    rows = ['{"wiki":"w","timestamp":60,"type":"edit","minor":true}'] * 2 + [
        '{"wiki":"w","timestamp":61,"type":"log","minor":true,"bot":true}'
    ]
    lookup = _lookup(spark, [("enwiki", "English Wikipedia", "en")])
    parsed = parse_events(raw_df(spark, rows))
    t = totals_rollup(parsed, lookup, DEFAULT.with_(burst_threshold=3)).first()
    assert (t["edit_count"], t["bot_count"], t["human_count"], t["anomaly_flag"]) == (3, 1, 2, True)
    assert t["window_end"] == dt.datetime(1970, 1, 1, 0, 2)
    acts = {r["event_type"]: r for r in actions_rollup(parsed, lookup, DEFAULT).collect()}
    assert acts["log"]["minor_count"] == 1 and acts["edit"]["minor_count"] == 2


def test_contract_violations_rules(spark):
    df = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1), "ab", "l", "x", "edit", 1, 0, 1, 0),
            (dt.datetime(2024, 1, 1), "ab", "l", "x", "edit", 1, 0, 1, 0),
            (None, "a", "l", "x", "edit", 1, 0, 1, 0),
        ],
        "window_end timestamp, wiki string, wiki_label string, language string, event_type string, "
        "event_count long, bot_count long, human_count long, minor_count long",
    )
    got = {r["rule"]: r["violations"] for r in contract_violations(df, DEFAULT.with_(max_wiki_len=1)).collect()}
    assert got == {"null_key": 1, "wiki_too_long": 2, "duplicate_key": 1}


def test_prepare_lookup_broadcast_bound(spark):
    lookup = _lookup(spark, [(str(i), f"L{i}", "x") for i in range(50)])
    small = prepare_lookup(lookup, max_rows=100)
    big = prepare_lookup(lookup, max_rows=10)
    df = spark.createDataFrame([("1",)], "wiki string")
    plan_small = plan_text(df.join(small, F.col("wiki") == F.col("lk_wiki_key"), "left"), "extended")
    plan_big = plan_text(df.join(big, F.col("wiki") == F.col("lk_wiki_key"), "left"), "extended")
    assert "strategy=broadcast" in plan_small.lower()
    assert "strategy=broadcast" not in plan_big.lower()
