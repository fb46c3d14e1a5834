"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document gives a vector of transformed statistics.  Per language and source, the centre
and scatter are those of the ``SHARE`` of documents whose covariance has the smallest determinant:
concentration steps run from several starts (medians and absolute deviations, and small subsets
drawn by hash), each until its determinant stops falling, and the smallest determinant wins.  A
reweighting step then takes the moments of all documents within a chi-square quantile of that
estimate.  A document is rejected if its Mahalanobis distance passes a further quantile.

Concentration steps run over all rows: a step takes each group's distance quantile and the
moments of the rows within it, both aggregates with partial sums, so a group of any size
takes no task of its own.  Groups of fewer than ``LEAST_ROWS`` rows are pooled by language, then
in one rest group; a rest group that is too small rejects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shingles_of, small, text_slices, word_hashes, words_of

SHARE = 0.75
STARTS = 3
#: Rows of the subset that a start other than the first is drawn from.
SUBSET_ROWS = 40
#: A step that lowers the logarithm of the determinant by less is the last; quantiles are approximate.
LEAST_FALL = 1e-3
#: Share of regular documents that the reweighting step takes.
WITHIN = 0.975
LEAST_ROWS = 60
#: Upper tail of the chi-square law that is rejected.
TAIL = 1e-6
LEAST_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_twins", "n_lines")
COUNT_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)

_IS = {
    "n_symbols": np.isin(np.arange(256), list(b"#*$%&|<>")),
    "n_capitals": np.isin(np.arange(256), range(65, 91)),
    "n_marks": np.isin(np.arange(256), list(b"!?.,;:'\"()[]{}-_=+/\\@^~`")),
    "word_chars": np.array([(b & 0xC0) != 0x80 and b not in (0x20, *range(9, 14)) for b in range(256)]),
}


def counts_of(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column; null texts have none."""
    total = {c: np.zeros(len(column), np.int64) for c in COUNTS}
    for lo, hi, data, offsets in text_slices(column):
        m = hi - lo
        for name, table in _IS.items():
            summed = np.concatenate([[0], np.cumsum(table[data])])
            total[name][lo:hi] = summed[offsets[1:]] - summed[offsets[:-1]]
        start, end, row = words_of(data, offsets)
        words = word_hashes(data, start, end, fold=False)
        total["n_words"][lo:hi] = np.bincount(row, minlength=m)
        twin = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        total["n_twins"][lo:hi] = np.bincount(row[1:][twin], minlength=m)
        h, of, first = shingles_of(words, row, 5)
        again = _repeated(h, of)
        cover = np.zeros(len(words) + 5, np.int64)
        np.add.at(cover, first[again], 1)
        np.add.at(cover, first[again] + 5, -1)
        total["n_repeat_words"][lo:hi] = np.bincount(row[np.cumsum(cover)[: len(words)] > 0], minlength=m)
        a, z, line_of = _lines(data, offsets, start)
        lines = word_hashes(data, a, z, fold=False)
        total["n_lines"][lo:hi] = np.bincount(line_of, minlength=m)
        total["n_dup_lines"][lo:hi] = np.bincount(line_of[~_firsts(lines, line_of)], minlength=m)
    return total


def _lines(data: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of lines that hold a word."""
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    bounds = np.unique(np.concatenate([offsets, breaks]))
    stop = bounds[np.minimum(np.searchsorted(bounds, begin, side="left"), len(bounds) - 1)]
    inside = np.isin(begin, offsets) & (stop == begin)  # a line that begins a row ends at the next bound
    stop[inside] = bounds[np.minimum(np.searchsorted(bounds, begin[inside], side="right"), len(bounds) - 1)]
    stop = np.where((data[begin] == 10) if len(begin) else False, begin, stop)
    worded = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, stop = begin[worded], stop[worded]
    return begin, stop, np.searchsorted(offsets, begin, side="right") - 1


def _firsts(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which values are the first of their row."""
    order = np.lexsort((h, row))
    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])]) if len(h) else np.empty(0, bool)
    out = np.zeros(len(h), bool)
    out[order[new]] = True
    return out


def _repeated(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which values occur again in their row."""
    order = np.lexsort((h, row))
    same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def count_table(docs: DataFrame) -> DataFrame:
    """doc_id, lang and source of each row with its counts."""
    keys = ["doc_id", "lang", "source"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = counts_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *(pa.array(found[c]) for c in COUNTS)], names=[*keys, *COUNTS])

    rows = docs.select("doc_id", *[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, lang string, source string, {COUNT_SCHEMA}")


#: Name, expression and least standard deviation of each statistic.  Rates are smoothed by one sentence's worth.
_CHARS = "(word_chars + 60)"
STATISTICS = (
    ("size", "ln(n_words + 1)", 0.5),
    ("length", "ln((word_chars + 20) / (n_words + 5))", 0.12),
    ("symbols", f"sqrt(n_symbols / {_CHARS})", 0.04),
    ("capitals", f"sqrt((n_capitals + 2) / {_CHARS})", 0.06),
    ("marks", f"sqrt((n_marks + 2) / {_CHARS})", 0.05),
    ("twins", "sqrt(n_twins / (n_words + 5))", 0.12),
    ("lines", "sqrt(n_dup_lines / (n_lines + 3))", 0.15),
    ("repeats", "sqrt(n_repeat_words / (n_words + 20))", 0.12),
)
NAMES = [s[0] for s in STATISTICS]


def chi_square_quantile(p: float, d: int) -> float:
    """By bisection of the closed form for even d."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_below(mid, d) < p else (lo, mid)
    return lo


def chi_square_below(x: float, d: int) -> float:
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(d // 2))


def _pooled(rows: DataFrame) -> DataFrame:
    """Adds ``pool``: language and source, else language, else the rest, by the rows there."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    rows = rows.withColumn("_lang", name("lang")).withColumn("_source", name("source"))
    pairs = materialise(rows.groupBy("_lang", "_source").agg(F.count("*").alias("n")), "quality-pairs")
    langs = pairs.where(F.col("n") < LEAST_ROWS).groupBy("_lang").agg(F.sum("n").alias("n_lang"))
    pairs = pairs.join(langs, "_lang", "left")
    pool = F.when(F.col("n") >= LEAST_ROWS, F.concat_ws("\t", "_lang", "_source")).when(F.col("n_lang") >= LEAST_ROWS, F.col("_lang"))
    pairs = materialise(pairs.select("_lang", "_source", F.coalesce(pool, F.lit("rest")).alias("pool")), "quality-pools")
    return rows.join(small(pairs), ["_lang", "_source"]).drop("_lang", "_source")


def _distance() -> Column:
    """Squared Mahalanobis distance by the joined centre and precision (lower triangle, rows in order)."""
    d = len(NAMES)
    gap = [F.col(s) - F.col("centre")[i] for i, s in enumerate(NAMES)]
    total, at = F.lit(0.0), 0
    for i in range(d):
        for j in range(i + 1):
            total = total + gap[i] * gap[j] * F.col("precision")[at] * (1.0 if i == j else 2.0)
            at += 1
    return total


def _moments(rows: DataFrame) -> DataFrame:
    d = len(NAMES)
    sums = [F.avg(F.col(s)).alias(f"m{i}") for i, s in enumerate(NAMES)]
    sums += [F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1)]
    return rows.groupBy("pool", "start").agg(*sums)


FIT_SCHEMA = "pool string, start int, centre array<double>, precision array<double>, spread double"


def _solved(moments: DataFrame, scale: float) -> DataFrame:
    """Centre, precision and log determinant (``spread``) of moments; the covariance times ``scale``, plus each statistic's least variance."""
    d, floor = len(NAMES), np.diag([s[2] ** 2 for s in STATISTICS])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                cov = np.zeros((d, d))
                for i in range(d):
                    for j in range(i + 1):
                        cov[i, j] = cov[j, i] = getattr(r, f"c{i}_{j}") * scale
                p = np.linalg.inv(cov + floor)
                lower = [p[i, j] for i in range(d) for j in range(i + 1)]
                out.append((r.pool, r.start, [getattr(r, f"m{i}") for i in range(d)], lower, float(np.linalg.slogdet(cov + floor)[1])))
            yield pd.DataFrame(out, columns=["pool", "start", "centre", "precision", "spread"])

    return moments.mapInPandas(solve, FIT_SCHEMA)


def _starts(rows: DataFrame) -> DataFrame:
    """The estimates that concentration begins from; their ``spread`` is null."""
    d = len(NAMES)
    middle = [F.percentile_approx(s, 0.5, 10_000).alias(f"q{i}") for i, s in enumerate(NAMES)]
    medians = small(materialise(rows.groupBy("pool").agg(*middle), "quality-medians"))
    spread = [F.percentile_approx(F.abs(F.col(s) - F.col(f"q{i}")), 0.5, 10_000).alias(f"a{i}") for i, s in enumerate(NAMES)]
    start = medians.join(rows.join(medians, "pool").groupBy("pool").agg(*spread), "pool")
    cells = []
    for i in range(d):
        cells += [F.lit(0.0)] * i + [1 / (F.pow(F.col(f"a{i}") * 1.4826, F.lit(2.0)) + F.lit(STATISTICS[i][2] ** 2))]
    first = start.select("pool", F.lit(0).alias("start"), F.array(*[f"q{i}" for i in range(d)]).alias("centre"), F.array(*cells).alias("precision"))
    drawn = rows.withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(STARTS - 1))))
    place = F.row_number().over(Window.partitionBy("pool", "start").orderBy(F.xxhash64(*NAMES, "start")))
    drawn = drawn.withColumn("_place", place).where(F.col("_place") <= SUBSET_ROWS)
    return first.unionByName(_solved(_moments(drawn), 1.0).drop("spread")).withColumn("spread", F.lit(None).cast("double"))


def _inner(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """The ``SHARE`` of the rows nearest to each estimate of their pool."""
    near = rows.join(fit.select("pool", "start", "centre", "precision"), "pool").withColumn("_d", _distance()).drop("centre", "precision")
    bounds = near.groupBy("pool", "start").agg(F.percentile_approx("_d", SHARE, 10_000).alias("_bound"))
    return near.join(small(materialise(bounds, "quality-bounds")), ["pool", "start"]).where("_d <= _bound")


def concentrated(rows: DataFrame) -> DataFrame:
    """The estimate of smallest determinant of each pool, each start followed until its determinant stops falling."""
    d = len(NAMES)
    scale = SHARE / chi_square_below(chi_square_quantile(SHARE, d), d + 2)
    open_ = small(materialise(_starts(rows), "quality-fit"))
    ended = open_.limit(0)
    while not open_.isEmpty():
        step = _solved(_moments(_inner(rows, open_)), scale)
        before = open_.select("pool", "start", F.struct("spread", "centre", "precision").alias("before"))
        step = materialise(step.join(before, ["pool", "start"]), "quality-step")
        falls = F.col("before.spread").isNull() | (F.col("spread") < F.col("before.spread") - LEAST_FALL)
        better = F.struct("spread", "centre", "precision")
        better = F.when(F.col("before.spread").isNull() | (F.col("spread") <= F.col("before.spread")), better).otherwise(F.col("before"))
        last = step.where(~falls).select("pool", "start", better.alias("b")).select("pool", "start", "b.centre", "b.precision", "b.spread")
        ended = ended.unionByName(last)
        open_ = small(materialise(step.where(falls).drop("before"), "quality-fit"))
    best = ended.groupBy("pool").agg(F.min_by(F.struct("start", "centre", "precision", "spread"), F.struct("spread", "start")).alias("b"))
    return materialise(best.select("pool", "b.*"), "quality-best")


def fit_pools(rows: DataFrame) -> DataFrame:
    """(pool, n, centre, precision) of ``rows`` (pool and the statistics): the best estimate, reweighted."""
    d = len(NAMES)
    cut = chi_square_quantile(WITHIN, d)
    near = rows.join(small(concentrated(rows)), "pool").withColumn("_d", _distance())
    final = _solved(_moments(near.where(F.col("_d") <= cut)), WITHIN / chi_square_below(cut, d + 2))
    sizes = rows.groupBy("pool").agg(F.count("*").alias("n"))
    return materialise(final.join(sizes, "pool").select("pool", "n", "centre", "precision"), "quality-fit")


def judge_documents(docs: DataFrame) -> DataFrame:
    """Counts, distance and verdict of each row of ``docs`` (doc_id, text, lang, source).

    Columns: doc_id, the counts, base_failed, distance (null where not judged) and kept.  Rows that
    fail the base rules (too few words, or too many in repeated five-word windows) are rejected
    and shape no estimate.  Null text has no words and fails; null lang and source are values of
    their own; repeated rows count as often as they occur; other columns are ignored; an empty
    table gives no rows.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    counts = materialise(count_table(docs).withColumn("base_failed", failed), "quality-counts")
    rows = counts.where("not base_failed").select("*", *[F.expr(e).alias(n) for n, e, _ in STATISTICS])
    rows = materialise(_pooled(rows), "quality-rows")
    fit = small(fit_pools(rows.select("pool", *NAMES)))
    judged = rows.join(fit, "pool", "left")
    limit = chi_square_quantile(1 - TAIL, len(NAMES))
    judged = judged.withColumn("distance", F.sqrt(F.when(F.col("n") >= LEAST_ROWS, _distance())))
    judged = judged.withColumn("kept", F.coalesce(F.col("distance") <= math.sqrt(limit), F.lit(True)))
    base = counts.where("base_failed").withColumn("distance", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    names = ["doc_id", *COUNTS, "base_failed", "distance", "kept"]
    return judged.select(*names).unionByName(base.select(*names))
