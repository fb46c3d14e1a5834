"""Mixing: targets by the rule's own rounds, takes near the targets, reruns, edges."""

import hashlib
import re

import numpy as np
import pytest
from llm_tables import EDGE_DOCS, write
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import op3_mixing


def brute_targets(sizes, weights=(5, 2, 1), limit=3.0):
    """Deal by weight, stop at the limit, deal the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = float(sum(sizes.values())), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(limit * sizes[s] for s in full)
        target = {s: limit * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in rest) for s in names}
        above = {s for s in rest if target[s] > limit * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(10 ** rng.uniform(0, 5)) for i in range(int(rng.integers(1, 12)))}
    sizes |= {None: 37, "Ä": 500, "empty": 0}
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source for r in rows} == set(want)
    for r in rows:
        assert r.target == pytest.approx(want[r.source], rel=1e-9)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = op3_mixing(spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    taken, size, target = {}, {}, {}
    for r in rows:
        s = docs[r.doc_id].source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[s], size[s] = taken.get(s, 0) + r.taken, size.get(s, 0) + r.size
        target[s] = r.target
    assert all(r.source_size == size[docs[r.doc_id].source] for r in rows)
    assert target == pytest.approx(brute_targets(size))
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in taken)
    again = op3_mixing(spark, folder).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_inclusion_follows_the_weights(spark):
    """Over many seeds documents are taken as often as their expected copies say."""
    sizes = [10] * 40 + [160] * 10
    docs = spark.createDataFrame([(i, i, " ".join(["w"] * n), "b" if i % 2 else "a") for i, n in enumerate(sizes)], "_row long, doc_id long, text string, source string")
    total = np.zeros(len(sizes))
    for seed in range(12):
        for r in mixing.mix(docs, "_row", weights=(1,), seed=str(seed)).select("_row", "copies").collect():
            total[r[0]] += r.copies
    short, long = total[:40].mean() / 12, total[40:].mean() / 12
    assert 1.3 < short / long < 3.2  # the fourth root of 16 is 2


def test_fill_goes_on_until_nothing_fits(spark):
    """Each round takes one document and is ended by the next, so the gap falls to 0.4 of itself: eight rounds to the tolerance."""
    gap, sizes = 20_000, []
    while gap > 15:
        take = gap * 6 // 10
        sizes += [take, gap // 2]
        gap -= take
    total = 20_000 * 8 // 3  # the third of three equal sources gets 3/8 of its size
    sizes.append(total - sum(sizes))
    ids = sorted(range(len(sizes)), key=lambda i: hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest())
    docs = [(i, "w " * n, "c") for i, n in zip(ids, sizes)] + [(100, "w " * total, "a"), (101, "w " * total, "b")]
    table = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "_row long, doc_id long, text string, source string")
    rows = mixing.mix(table, "_row", inclusion=lambda size: F.lit(1.0)).where("source_size > 0").collect()
    rows = [r for r in rows if r.doc_id < 100]
    assert 0 <= rows[0].target - sum(r.taken for r in rows) <= mixing.TOLERANCE * rows[0].target


def test_edges(spark, tmp_dir):
    rows = op3_mixing(spark, write(tmp_dir, EDGE_DOCS)).collect()
    assert len(rows) == len(EDGE_DOCS)
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 3 * r.size for r in rows)
    assert op3_mixing(spark, write(tmp_dir)).collect() == []


def test_rows_are_repeated(spark, tmp_dir):
    docs = [(i, " ".join(["w"] * 9), "a" if i < 30 else "b", "x") for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, n string").withColumn("_row", F.col("doc_id")).write.parquet(f"{tmp_dir}/d")
    table = spark.read.parquet(f"{tmp_dir}/d")
    out = mixing.repeat_rows(table, "_row")
    assert out.columns == table.columns
    counts = {r[0]: r[1] for r in out.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.copies for r in mixing.mix(table, "_row").collect() if r.copies}
    assert counts == want and max(want.values()) <= 3
