"""Benchmark decontamination against exact containment of all pairs."""

import numpy as np
from llm_tables import EDGE_DOCS, LONG, words, write

from tidemark.llm import decontaminate as dc
from tidemark.llm.queries import op10_leaks


def brute(docs, items, k=5, threshold=0.8):
    out = []
    for doc_id, text, *_ in docs:
        w = dc.word_list(text)
        for item_id, item in set(items):
            x = dc.word_list(item)
            width = min(k, len(x))
            a = dc.word_shingles(x, width) if x and item_id is not None else set()
            own = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
            if a and len(a & own) >= threshold * len(a):
                out.append((doc_id, item_id, len(a), len(a & own)))
    return sorted(out, key=str)


def found(rows):
    return sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in rows), key=str)


def test_passages_in_long_documents(spark, tmp_dir):
    rng = np.random.default_rng(0)
    items = [(i, " ".join(words(rng, int(rng.integers(5, 70))))) for i in range(60)]
    docs = []
    for i in range(150):
        text = words(rng, int(rng.integers(0, 3000)))
        for _ in range(int(rng.integers(0, 3))):
            part = items[int(rng.integers(60))][1].split()
            for _ in range(int(rng.integers(0, 3))):
                part[int(rng.integers(len(part)))] = "changed"
            p = int(rng.integers(len(text) + 1))
            text[p:p] = part
        docs.append((i, " ".join(text).upper() if i % 3 == 0 else " \n".join(text), "en", "a", 1))
    assert found(op10_leaks(spark, write(tmp_dir, docs, benchmark=items)).collect()) == brute(docs, items)


def test_blocks_of_items(spark):
    docs = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    items = [(i, " ".join(f"w{j}" for j in range(i * 100, i * 100 + 30))) for i in range(20)]
    rows = dc.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=300).collect()
    assert sorted(r.item_id for r in rows) == list(range(20))


def test_scattered_shingles_count(spark):
    """An item split over two far places of a document is contained as a set."""
    item = [f"i{j}" for j in range(40)]
    text = item[:20] + LONG.split()[:3000] + item[16:]
    docs = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    rows = dc.find_leaks(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.item_id, r.containment) for r in rows] == [(7, 1.0)]


def test_edges(spark, tmp_dir):
    items = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "lonely WORDS"), (3, ""), (4, None), (None, "single"), (5, "single"), (6, "w5 w6 w7 w8 w9"), (7, "ä" * 50_000)]
    got = found(op10_leaks(spark, write(tmp_dir, EDGE_DOCS, benchmark=items)).collect())
    assert got == brute(EDGE_DOCS, items)
    assert {g[1] for g in got} == {1, 2, 5, 6, 7}
    assert op10_leaks(spark, write(tmp_dir, EDGE_DOCS)).collect() == []
    assert op10_leaks(spark, write(tmp_dir, benchmark=items)).collect() == []


def test_every_short_item_is_found():
    """Items of one to nine words, each inside a text of its own: recall is 1."""
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"s{x}" for x in rng.integers(0, 5000, 1 + i % 9))) for i in range(1800)]
    index = dc.ItemIndex(items, 5)
    for i, text in items:
        around = [f"f{x}" for x in rng.integers(0, 5000, 60)]
        cut = int(rng.integers(0, 60))
        words = " ".join([*around[:cut], text, *around[cut:]])
        data = np.frombuffer(words.encode(), np.uint8)
        start, end, row = dc.words_of(data, np.array([0, len(data)]))
        assert any(index.items[x][0] == i for _, x in index.candidates(dc.word_hashes(data, start, end), row))
