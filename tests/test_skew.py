"""A hot key (a third of all rows) and the shuffle-join fallback."""

import re

from pyspark.sql import functions as F

from conftest import SF_MID, plan_text
from tidemark.functions.parse import parse_events
from tidemark.operators.enrich import enrich, prepare_lookup
from tidemark.operators.rollups import totals_rollup
from tidemark.plans import suite
from tidemark.sources import synthetic


def _hot_raw(spark):
    """Events where every third row belongs to one wiki ('0')."""
    events = spark.read.parquet(f"{SF_MID}/events.parquet")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return hot, synthetic.raw_events(hot, keep_id=False)


def test_hot_wiki_counts_exact_with_partial_aggregation(spark):
    hot, raw = _hot_raw(spark)
    parsed = parse_events(raw, config=suite.QUERY_CONFIG)
    totals = totals_rollup(parsed, suite._lookup(spark, SF_MID), suite.QUERY_CONFIG)
    got = totals.filter(F.col("wiki") == "0").agg(F.sum("edit_count")).first()[0]
    want = hot.filter((F.col("user_id") % 40) == 0).count()
    assert got == want and got >= hot.count() // 3
    text = plan_text(totals, "simple")
    # map-side partial aggregate right below the only event-side shuffle
    assert re.search(r"Exchange hashpartitioning\(window#\d+, wiki#\d+, \d+\).*\n[\s:]*\+- HashAggregate\(keys=\[window#\d+, "
                     r"wiki#\d+\], functions=\[partial_count", text)


def test_enrich_shuffle_join_path_matches_broadcast(spark):
    parsed = suite._parsed(spark, SF_MID)
    lookup = suite._lookup(spark, SF_MID)
    small = enrich(parsed, prepare_lookup(lookup, max_rows=1_000), checked=True)
    big = enrich(parsed, prepare_lookup(lookup, max_rows=1), checked=True)  # bound exceeded: no broadcast hint
    assert "strategy=broadcast" not in plan_text(big, "extended").lower()
    cols = ["wiki", "event_ts", "event_type", "wiki_label", "language"]
    a, b = small.select(*cols), big.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
