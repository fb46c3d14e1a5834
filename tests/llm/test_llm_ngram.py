"""The n-gram Jaccard join against all pairs."""

import re

import numpy as np
import pytest
from llm_tables import CLASHES, EDGE_DOCS, thue_morse, words, write

from tidemark.llm import ngram_join
from tidemark.llm.queries import op2_ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(docs, k, num, den):
    sets = [shingles(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and den * both >= num * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def found(spark, docs, k, num, den):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in ngram_join.link_components(df, k, num, den).collect()), key=str)


def corpus(seed):
    """Copies, edits of several strengths, a large group of near copies, a passage that many share."""
    rng = np.random.default_rng(seed)
    docs, passage = [], words(rng, 60)
    for _ in range(25):
        base = words(rng, int(rng.integers(3, 150)))
        docs.append(base)
        for _ in range(int(rng.integers(0, 5))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = "edit%d" % rng.integers(99)
            docs.append(copy)
    base = words(rng, 200)
    for i in range(45):  # more than RARE: their tokens are frequent
        copy = list(base)
        for p in rng.integers(0, 200, int(rng.integers(0, 7))):
            copy[p] = f"own{i}x{p}"
        docs.append(copy)
    for i in range(30):
        docs.append(passage + words(rng, int(rng.integers(0, 40))))
    docs += [passage, passage[:-1], ["a"], ["a", "b"], ["A", "B"], []]
    order = rng.permutation(len(docs))
    return [(int(i), " ".join(docs[i])) for i in order]


@pytest.mark.parametrize("seed,k,num,den", [(1, 3, 90, 100), (2, 5, 80, 100)])
def test_components_equal_all_pairs(spark, seed, k, num, den):
    docs = corpus(seed)
    assert found(spark, docs, k, num, den) == brute(docs, k, num, den)


def test_chain_that_no_hub_joins(spark, monkeypatch):
    """A chain of sets: neighbours link, ends do not; without hub rounds only the block join finds the links."""
    rng = np.random.default_rng(5)
    text, step = words(rng, 420, 10**6), 10
    docs = [(i, " ".join(text[i * step : i * step + 220])) for i in range(20)] + [(100 + i, " ".join(text[:220] + [f"z{i}"])) for i in range(30)]
    want = brute(docs, 3, 90, 100)
    assert len({c for _, _, c in want}) == 1
    assert found(spark, docs, 3, 90, 100) == want
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(ngram_join, "RARE", 2)
    assert found(spark, docs, 3, 90, 100) == want


def test_prefix_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, int(rng.integers(1, 50)))) for _ in range(120)]
    sets += [np.delete(s, 0) for s in sets if len(s) > 1] + sets[:5]
    tree = ngram_join.PrefixTree(sets)
    for probe in sets[::7]:
        want = [i for i, s in enumerate(sets) if 10 * len(np.intersect1d(s, probe)) >= 8 * len(np.union1d(s, probe))]
        assert sorted(tree.probe(probe, 8, 10)) == want


def test_edges(spark, tmp_dir):
    rows = op2_ngram_join(spark, write(tmp_dir, EDGE_DOCS)).collect()
    got = sorted((tuple(r) for r in rows), key=str)
    assert got == brute([r[:2] for r in EDGE_DOCS], 3, 90, 100)
    assert op2_ngram_join(spark, write(tmp_dir)).collect() == []


def test_words_of_one_structure_are_told_apart(spark):
    docs = [(1, thue_morse(0)), (2, thue_morse(1)), (3, thue_morse(1))]
    assert found(spark, docs, 3, 90, 100) == [(1, 1, 1), (2, 1, 2), (3, 1, 2)]


def test_stages_leave_clashing_columns_alone(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.decontaminate import drop_leaks

    df = spark.createDataFrame([(1, "a b c d e f g h i"), (1, "a b c d e f g h i"), (2, "a b c d e f g h i"), (3, "other words")], "doc_id long, text string")
    df = df.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    kept = ngram_join.keep_one(df, 5, 80, 100)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    items = spark.createDataFrame([(1, "other words")], "item_id long, text string")
    left = drop_leaks(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 1, 2]


def test_one_of_each_group_stays(spark):
    docs = corpus(4)
    docs += [docs[0], docs[0], (500, None), (500, None), (None, "some words of nobody at all here"), (None, "some words of nobody at all here")]
    df = spark.createDataFrame([(d, t, r) for r, (d, t) in enumerate(docs)], "doc_id long, text string, _text long").repartition(3)
    rows = ngram_join.keep_one(df, 5, 80, 100).collect()
    kept = [r[0] for r in rows if (r[1] or "").strip()]
    assert sorted(kept, key=str) == sorted({c for _, n, c in brute(docs, 5, 80, 100) if n}, key=str)
    assert len(rows) == len(kept) + sum(not (t or "").strip() for _, t in docs)
