"""Quality outliers: counts against plain code, the estimate against a numpy version, verdicts."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import EDGE_DOCS, write

from tidemark.llm import quality
from tidemark.llm.queries import op7_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            cover.update(range(i, i + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab é#|\n\n \t\x0bZ"), max_size=60)), max_size=8))
def test_counts(texts):
    got = quality.counts_of(pa.array(texts, pa.string()))
    assert list(zip(*(got[c].tolist() for c in NAMES))) == [base(t) for t in texts]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op7_quality(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == len(docs)
    good = junk = lost = 0
    for d in docs:
        r = rows[d.doc_id]
        assert tuple(r[c] for c in NAMES) == base(d.text)
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
        if not failed and d.quality == 1:
            good, lost = good + 1, lost + (not r.kept)
        if d.quality == 0:
            junk += r.kept
    assert good > 250 and lost == 0 and junk <= 3


def steps(x, centre, precision, scale, floor):
    """Concentration until the determinant stops falling, in numpy."""
    spread = np.inf
    while True:
        gap = x - centre
        distance = np.einsum("ij,jk,ik->i", gap, precision, gap)
        inner = x[distance <= np.sort(distance)[int(len(x) * quality.SHARE) - 1]]
        cov = np.cov(inner.T, bias=True) * scale + floor
        now = np.linalg.slogdet(cov)[1]
        if now >= spread - 1e-9:
            return spread, centre, precision
        spread, centre, precision = now, inner.mean(0), np.linalg.inv(cov)


def plain_estimate(x, starts=30):
    """The best of many random starts, then the reweighting step."""
    d, rng = x.shape[1], np.random.default_rng(9)
    floor = np.diag([s[2] ** 2 for s in quality.STATISTICS])
    scale = quality.SHARE / quality.chi_square_below(quality.chi_square_quantile(quality.SHARE, d), d + 2)
    best = None
    for _ in range(starts):
        part = x[rng.choice(len(x), 40, replace=False)]
        got = steps(x, part.mean(0), np.linalg.inv(np.cov(part.T, bias=True) + floor), scale, floor)
        best = got if best is None or got[0] < best[0] else best
    cut = quality.chi_square_quantile(quality.WITHIN, d)
    gap = x - best[1]
    inner = x[np.einsum("ij,jk,ik->i", gap, best[2], gap) <= cut]
    cov = np.cov(inner.T, bias=True) * quality.WITHIN / quality.chi_square_below(cut, d + 2) + floor
    return best[0], inner.mean(0), np.linalg.inv(cov)


def test_estimates_equal_numpy_s_best(spark):
    """Pools with a far cluster, with scattered outliers and with none; the determinant is as small as many random starts find."""
    rng = np.random.default_rng(1)
    d = len(quality.NAMES)
    pools = {}
    for name, odd in (("far", lambda x: x[:80] + 5), ("wide", lambda x: x[:80] * 8), ("none", lambda x: x[:80])):
        x = rng.normal(0, 0.4, (400, d)) @ (np.eye(d) + 0.3)
        x[:80] = odd(x)
        pools[name] = x
    frame = pd.concat([pd.DataFrame(x, columns=quality.NAMES).assign(pool=p) for p, x in pools.items()])
    rows = spark.createDataFrame(frame)
    best = {r.pool: r.spread for r in quality.concentrated(rows).collect()}
    for r in quality.fit_pools(rows).collect():
        spread, centre, precision = plain_estimate(pools[r.pool])
        assert best[r.pool] <= spread + 0.1 and r.n == 400
        assert np.allclose(r.centre, centre, atol=0.05)
        assert np.allclose(r.precision, precision[np.tril_indices(d)], rtol=0.15, atol=0.25)


def test_a_start_that_fails_does_not_decide(spark):
    """Nearly half of the rows are a tight far cluster in half of the statistics: a single start may end in a mixture."""
    rng = np.random.default_rng(7)
    d = len(quality.NAMES)
    x = rng.normal(0, 0.5, (600, d))
    x[:140, ::2] = rng.normal(4, 0.05, (140, d // 2))
    frame = pd.DataFrame(x, columns=quality.NAMES).assign(pool="p")
    fit = quality.fit_pools(spark.createDataFrame(frame)).collect()[0]
    assert np.allclose(fit.centre, x[140:].mean(0), atol=0.1)


def test_edges(spark, tmp_dir):
    rows = op7_quality(spark, write(tmp_dir, EDGE_DOCS)).collect()
    assert sorted((str(r.doc_id), *(r[c] for c in NAMES)) for r in rows) == sorted((str(d[0]), *base(d[1])) for d in EDGE_DOCS)
    assert all(r.kept != r.base_failed for r in rows)  # too few rows to judge: only the base rules reject
    assert op7_quality(spark, write(tmp_dir)).collect() == []


def test_outliers_are_rejected_per_source(spark, tmp_dir):
    rng = np.random.default_rng(2)
    docs = []
    for i in range(300):
        w = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(80)]
        docs.append((i, " ".join(x + ("|" if i % 2 else "") for x in w), "en", f"s{i % 2}", 1))
    odd = [(900, docs[1][1], "en", "s0", 1), (901, docs[0][1], "en", "s1", 1)]  # usual in the other source
    rows = {r.doc_id: r.kept for r in op7_quality(spark, write(tmp_dir, docs + odd)).collect()}
    assert not rows[900] and not rows[901] and all(rows[i] for i in range(300))
