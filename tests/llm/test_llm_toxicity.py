"""Toxicity: held-out accuracy, calibration, inputs, edges."""

import zlib

import numpy as np
import pytest
from llm_tables import EDGE_DOCS, write

from tidemark.llm import toxicity
from tidemark.llm.queries import op1_toxicity


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op1_toxicity(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [(rows[r.doc_id].score, r.toxic) for r in labels if rows[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([s >= 0.7 for s in toxic]) >= 0.7 and np.mean([s < 0.7 for s in clean]) >= 0.99


def corpus(rng, n=400):
    docs, labels = [], []
    for i in range(n):
        w = [f"w{x}" for x in rng.integers(0, 500, 60)]
        bad = i % 5 == 0
        if bad:
            for p in rng.integers(0, 60, 6):
                w[p] = str(rng.choice(["vilest", "nasty", "n4sty", "VILE!!"]))
        docs.append((i, " ".join(w), "en", "a", 1))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_planted_words(spark, tmp_dir):
    docs, labels = corpus(np.random.default_rng(1))
    rows = {r.doc_id: r for r in op1_toxicity(spark, write(tmp_dir, docs, labels)).collect()}
    for i, _, toxic in labels:
        assert rows[i].predicted == toxic, (i, rows[i])


def test_held_out_labels_do_not_count(spark, tmp_dir):
    docs, labels = corpus(np.random.default_rng(2))
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    moved = [(i, t, "xx", "other", 9) for i, t, *_ in docs]
    a = {r.doc_id: r.score for r in op1_toxicity(spark, write(tmp_dir, docs, labels)).collect()}
    b = {r.doc_id: r.score for r in op1_toxicity(spark, write(tmp_dir, moved, flipped)).collect()}
    assert a == b


def test_edges(spark, tmp_dir):
    some = corpus(np.random.default_rng(3), 60)
    rows = op1_toxicity(spark, write(tmp_dir, EDGE_DOCS + [(1000 + d[0], *d[1:]) for d in some[0]], [(1000 + x[0], *x[1:]) for x in some[1]] + [(None, 1, 1), (5, 1, None)])).collect()
    assert len(rows) == len(EDGE_DOCS) + 60 and all(0 <= r.score <= 1 for r in rows)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(2, 1, 1), (5, 1, 1)]):
        rows = op1_toxicity(spark, write(tmp_dir, EDGE_DOCS, labels)).collect()
        assert len(rows) == len(EDGE_DOCS) and len({r.score for r in rows}) == 1
    assert op1_toxicity(spark, write(tmp_dir)).collect() == []


def test_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * x))).astype(float)
    at, value = toxicity.isotonic(x, y, np.ones(500))
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all()
    assert np.interp([-2, 2], at, value) == pytest.approx([0, 1], abs=0.1)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.3)).astype(float)
    margin = toxicity.Trees.fit(x, y, np.ones(2000)).margin(x)
    assert ((margin > 0) == (y > 0)).mean() > 0.99


def test_features_see_through_disguise():
    scorer = toxicity.Scorer({"idiot": 5.0, "dumm-": 4.0})
    value = dict(zip(toxicity.FEATURES, scorer.features("You ID10T !! 1d!ot idi-ot dummkopf fine words")))
    assert value["distinct_hits"] == 4 and value["obfuscated_hits"] > 0 and value["near_second_person"] > 0


def plain_features(lexicon, text):
    """The features counted word by word and character by character, every hit against every second-person word."""
    text = text or ""
    words, hits, people, hidden_words = text.split(), [], [], 0
    for i, word in enumerate(words):
        letters, hidden = toxicity.plain(word)
        weight = max([lexicon[s] for s in toxicity.stems(letters) if s in lexicon] or [0.0])
        hidden_words += hidden
        if weight:
            hits.append((i, weight, hidden))
        if letters in toxicity.SECOND_PERSON:
            people.append(i)
    n, weights = max(1, len(words)), [w for _, w, _ in hits]
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    return [
        np.log1p(len(words)), 100 * len([w for w in weights if w >= 3]) / n, 100 * len([w for w in weights if 1.5 <= w < 3]) / n,
        100 * sum(weights) / n, np.log1p(len(hits)), len({words[i].lower() for i, _, _ in hits}), max(weights or [0.0]),
        sum(any(abs(i - p) <= toxicity.NEAR for p in people) for i, _, _ in hits) / max(1, len(hits)), 100 * len(people) / n,
        upper / max(1, upper + lower), sum(33 <= ord(c) <= 47 or 58 <= ord(c) <= 64 for c in text) / max(1, len(text)), text.count("!") / n,
        100 * hidden_words / n, 100 * sum(h for _, _, h in hits) / n,
    ]


def plain_score(model, text):
    """One text down every tree, then the calibration's line between two knots."""
    x, margin = plain_features(model.lexicon, text), model.trees.base
    for feature, cut, value in model.trees.splits:
        node = 0
        while node < len(feature):
            j = feature[node]
            node = 2 * node + (2 if sum(e < x[j] for e in model.trees.edges[j]) > cut[node] else 1)
        margin += value[node - len(feature)]
    at, knots = model.knots
    if margin <= at[0] or margin >= at[-1]:
        return knots[0] if margin <= at[0] else knots[-1]
    i = max(i for i in range(len(at)) if at[i] <= margin)
    return knots[i] + (knots[i + 1] - knots[i]) * (margin - at[i]) / (at[i + 1] - at[i])


def test_query_rows_against_plain_code(spark):
    """Every row of the query on sf0.001: features, trees and calibration of the trained model, one text at a time."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    rows = {r.doc_id: r for r in op1_toxicity(spark, folder).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert model.trees is not None and len(rows) == len(texts)
    for doc_id, text in texts:
        assert rows[doc_id].score == pytest.approx(plain_score(model, text), abs=1e-9), doc_id
        assert rows[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
