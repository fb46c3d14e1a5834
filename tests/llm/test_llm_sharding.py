"""Jump consistent hashing against the published loop."""

import hashlib
import zlib

import pytest
from llm_tables import EDGE_DOCS, write
from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.llm.queries import op9_jump_shards


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def seed(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("shards", [1, 2, 40, 41, 3000])
def test_equals_the_loop(spark, shards):
    rows = spark.range(400).select("id", sharding.jump(F.col("id"), shards).alias("s")).collect()
    assert all(r.s == jump(seed(r.id), shards) for r in rows)


def test_walk_that_outlasts_the_short_one(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SHORT_WALK", 2)
    rows = spark.range(200).select("id", sharding.jump(F.col("id"), 500).alias("s")).collect()
    assert all(r.s == jump(seed(r.id), 500) for r in rows)


def test_whole_table(spark):
    rows = op9_jump_shards(spark, "/root/testdata/sf0.001").collect()
    for r in rows:
        assert r.shard == jump(seed(r.doc_id), 40) and r.grown_shard in (r.shard, 40)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_slots_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RUN", 7)
    df = spark.range(500).select((F.col("id") % 3).alias("doc_id"), F.lit("t").alias("text")).repartition(5)
    rows = sharding.shard_table(df, 4).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 500 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_edges(spark, tmp_dir):
    rows = op9_jump_shards(spark, write(tmp_dir, EDGE_DOCS)).collect()
    got = sorted((str(r.doc_id), r.size, r.text_crc32, r.law, r.shard) for r in rows)
    want = [(str(d[0]), len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode()), "key", jump(seed(d[0]), 40)) for d in EDGE_DOCS]
    assert got == sorted(want)
    assert op9_jump_shards(spark, write(tmp_dir)).collect() == []
    with pytest.raises(ValueError):
        sharding.jump(F.lit(1), 0)
