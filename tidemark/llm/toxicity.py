"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon hits (whole words and their stems, de-obfuscated), the
share of hits near a second-person word, rates of capitals, of punctuation and of obfuscated
words, and the length.  The lexicon is learned, with support counts by Spark, from the
training rows; each training row is scored by a lexicon of the other folds, so the trees see hits
as they will be on new texts.  Near copies share a fold and count once.

The classifier is fitted on at most ``train_rows`` labelled rows (those of smallest hash in each
class); a row's weight restores the classes' shares.  Scores are calibrated by isotonic
regression on the predictions of each fold by trees of the other folds.  All else, the features
and the scores, covers every document in one pass without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, sets_of

TRAIN_ROWS = 20_000
LEXICON_ROWS = 50_000
FOLDS = 8
LEAST_SUPPORT = 3
THRESHOLD = 0.7
STEMS = (4, 5, 6)
NEAR = 4

#: Second-person words of the languages met most.
SECOND_PERSON = frozenset(
    "you your yours yourself ya u ur du dich dir dein deine deinen deiner deinem ihr euch euer eure sie "
    "tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros vuestro os você teu sua tuo voi".split()
)
#: Characters that stand in for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e"})

_INNER = regex.compile(r"\p{L}[^\p{L}\s'’-]+\p{L}")
_NOT_LETTER = regex.compile(r"[^\p{L}]+")
_REPEAT = regex.compile(r"(.)\1{2,}")

FEATURES = (
    "log_words", "strong_density", "medium_density", "weight_density", "log_hits", "distinct_hits", "top_weight",
    "near_second_person", "second_person_density", "capitals", "punctuation", "shouts", "obfuscated", "obfuscated_hits",
)


def plain(word: str) -> tuple[str, bool]:
    """(the word's letters in lower case, whether it was obfuscated inside)."""
    low = word.lower()
    if low.isalpha():
        return _REPEAT.sub(r"\1", low), False
    hidden = bool(_INNER.search(low))
    return _REPEAT.sub(r"\1", _NOT_LETTER.sub("", low.translate(STAND_INS) if hidden else low)), hidden


def stems(word: str) -> list[str]:
    """The whole word and its longer beginnings; a beginning ends with a dash."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)] if len(word) > 2 else []


class Scorer:
    """Features of texts under one lexicon (stem -> weight)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.seen: dict[str, tuple[float, bool, bool]] = {}

    def look(self, word: str) -> tuple[float, bool, bool] | None:
        """(weight, obfuscated, second person) of a word that matters, else None."""
        found = self.seen.get(word, 0)
        if found == 0:
            letters, hidden = plain(word)
            weight = max((self.lexicon.get(s, 0.0) for s in stems(letters)), default=0.0)
            person = letters in SECOND_PERSON
            found = (weight, hidden, person) if weight or hidden or person else None
            if len(self.seen) > 150_000:
                self.seen.clear()
            self.seen[word] = found
        return found

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        words = text.split()
        n = max(1, len(words))
        look, seen = self.look, self.seen
        marks = [(i, f) for i, f in enumerate(map(lambda w: seen[w] if w in seen else look(w), words)) if f]
        hits = [(i, f[0], f[1]) for i, f in marks if f[0]]
        people = [i for i, f in marks if f[2]]
        near = 0
        if hits and people:
            at = np.array(people)
            place = np.searchsorted(at, [i for i, *_ in hits])
            for (i, *_), p in zip(hits, place):
                near += (p < len(at) and at[p] - i <= NEAR) or (p > 0 and i - at[p - 1] <= NEAR)
        chars = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        letters = max(1, int(chars[97:123].sum() + chars[65:91].sum()))
        weights = [w for _, w, _ in hits]
        return [
            math.log1p(len(words)),
            100 * sum(w >= 3 for w in weights) / n,
            100 * sum(1.5 <= w < 3 for w in weights) / n,
            100 * sum(weights) / n,
            math.log1p(len(hits)),
            float(len({words[i].lower() for i, *_ in hits})),
            max(weights, default=0.0),
            near / max(1, len(hits)),
            100 * len(people) / n,
            chars[65:91].sum() / letters,
            (chars[33:48].sum() + chars[58:65].sum()) / max(1, len(text)),
            chars[33] / n,
            100 * sum(f[1] for _, f in marks) / n,
            100 * sum(h for *_, h in hits) / n,
        ]


@dataclass
class Trees:
    """Boosted regression trees of fixed depth for the log-odds, on binned features."""

    edges: list[np.ndarray]
    base: float
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # per tree: feature and bin of each inner node, leaf values

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 5.0):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        q = cls._binned(x, edges)
        share = min(max(float(np.average(y, weights=weight)), 1e-6), 1 - 1e-6)
        out = cls(edges, math.log(share / (1 - share)), [])
        margin = np.full(len(y), out.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            slope, bend = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins)
            for level in range(depth):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-9)
                for j in range(x.shape[1]):
                    key = (node - first) * bins + q[:, j]
                    g = np.bincount(key, slope, width * bins).reshape(width, bins).cumsum(1)
                    h = np.bincount(key, bend, width * bins).reshape(width, bins).cumsum(1)
                    gain = g**2 / (h + ridge) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + ridge) - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                    at = gain.argmax(1)
                    better = gain[np.arange(width), at] > best
                    best = np.where(better, gain[np.arange(width), at], best)
                    feature[first : first + width][better] = j
                    cut[first : first + width][better] = at[better]
                node = 2 * node + 1 + (q[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, bend, 2**depth) + ridge)
            margin += value[leaf]
            out.splits.append((feature, cut, value))
        return out

    @staticmethod
    def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        q, rows = self._binned(x, self.edges), np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, cut, value in self.splits:
            node = np.zeros(len(x), np.int64)
            for _ in range(int(math.log2(len(value)))):
                node = 2 * node + 1 + (q[rows, feature[node]] > cut[node])
            total += value[node - (len(value) - 1)]
        return total


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, value) of the weighted isotonic regression of y on x by pooling adjacent violators."""
    order = np.lexsort((y, x))
    pools: list[list[float]] = []  # weight, weighted sum, first x, last x
    for a, b, w in zip(x[order], y[order], weight[order]):
        pools.append([w, w * b, a, a])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    knots = [(p[i], (p[1] + 0.5 * w0) / (p[0] + w0)) for p in pools for i in (2, 3) for w0 in [float(weight.mean())]]
    return np.array([k[0] for k in knots]), np.maximum.accumulate(np.array([k[1] for k in knots]))


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    constant: float = 0.0

    def scores(self, scorer: Scorer, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.constant)
        margin = self.trees.margin(np.array([scorer.features(t) for t in texts]))
        return np.clip(np.interp(margin, *self.knots), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id's text modulo 3 is 1; a null id is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _sample(docs: DataFrame, labels: DataFrame, train_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Written training rows (family, toxic, text) and the number of usable labels by class."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = materialise(known, "toxic-labels")
    share = {int(t): n for t, n in known.groupBy("toxic").count().collect()}
    picked = None
    for toxic in (0, 1):
        part = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2)
        picked = part if picked is None else picked.union(part)
    picked = materialise(picked, "toxic-picked")  # at most train_rows rows: a proven bound for the broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            family = np.zeros(batch.num_rows, np.int64)
            for i, h in sets_of(batch.column("text"), 5):
                family[i] = int(h[0] >> np.uint64(1))
            yield pa.RecordBatch.from_arrays([pa.array(family), batch.column("toxic"), batch.column("text")], names=["family", "toxic", "text"])

    rows = rows.mapInArrow(families, "family long, toxic int, text string")
    return materialise(rows.groupBy("family").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "toxic-train"), share


def _support(train: DataFrame) -> list[tuple[str, list[int], list[int]]]:
    """(stem, clean rows by fold, toxic rows by fold) of stems in toxic rows; at most LEXICON_ROWS, the best supported."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for family, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("family", "toxic", "text"))):
                found = {s for w in set((text or "").split()) for s in stems(plain(w)[0])}
                held.update((s, toxic * FOLDS + family % FOLDS) for s in found)
                if len(held) > 400_000:
                    yield _counts(held)
                    held.clear()
        if held:
            yield _counts(held)

    sums = train.mapInArrow(count, "stem string, cell int, n long").groupBy("stem").agg(
        *[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(2 * FOLDS)]
    )
    toxic, clean = (sum(F.col(f"c{c + at}") for c in range(FOLDS)) for at in (FOLDS, 0))
    rows = sums.where((toxic >= LEAST_SUPPORT) & (toxic > clean * 0.05)).orderBy(toxic.desc(), clean, "stem").limit(LEXICON_ROWS)
    return [(r[0], list(r[1 : 1 + FOLDS]), list(r[1 + FOLDS :])) for r in rows.collect()]


def _counts(held: Counter) -> pa.RecordBatch:
    keys = list(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(held.values()), pa.int64())],
        names=["stem", "cell", "n"],
    )


def _lexicon(support: list, rows: np.ndarray, without: int | None) -> dict[str, float]:
    """Stems whose log-odds of toxic rows is clearly positive (its value less 1.64 standard errors); rows: class by fold."""
    keep = [f for f in range(FOLDS) if f != without]
    n0, n1 = (rows[c][keep].sum() + 1.0 for c in (0, 1))
    out = {}
    for stem, clean, toxic in support:
        a, b = sum(toxic[f] for f in keep) + 0.5, sum(clean[f] for f in keep) + 0.5
        weight = math.log(a / n1) - math.log(b / n0) - 1.64 * math.sqrt(1 / a + 1 / b)
        if a > LEAST_SUPPORT and weight > 1.0:
            out[stem] = weight
    return out


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model of (doc_id, text) and (doc_id, toxic).  Without labels every score is 0; with one class, its value."""
    rows, share = _sample(docs, labels, train_rows)
    sizes = np.zeros((2, FOLDS))
    for family, toxic, n in rows.groupBy(F.col("family") % FOLDS, "toxic").count().collect():
        sizes[toxic, family] = n
    if not sizes.sum(1).all():
        return Model({}, None, None, float(sizes[1].any()))
    support = _support(rows)
    lexicons = [_lexicon(support, sizes, f) for f in range(FOLDS)]
    sent = docs.sparkSession.sparkContext.broadcast(lexicons)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(x) for x in sent.value]
        for batch in batches:
            family = batch.column("family").to_pylist()
            x = [scorers[f % FOLDS].features(t) for f, t in zip(family, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("family"), batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["family", "toxic", "x"])

    table = sorted(rows.mapInArrow(extract, "family long, toxic int, x array<double>").collect())  # at most train_rows rows
    fold = np.array([r[0] % FOLDS for r in table])
    y, x = np.array([float(r[1]) for r in table]), np.array([r[2] for r in table])
    weight = np.array([share.get(int(c), 1) / max(1.0, (y == c).sum()) for c in y])
    weight /= weight.mean()
    out = np.zeros(len(y))
    for f in range(FOLDS):
        here = fold == f
        fits = ~here if len(set(y[~here])) == 2 else np.full(len(y), True)
        if here.any():
            out[here] = Trees.fit(x[fits], y[fits], weight[fits]).margin(x[here])
    return Model(_lexicon(support, sizes, None), Trees.fit(x, y, weight), isotonic(out, y, weight))


def score_column(model: Model, text: Column, spark) -> Column:
    """The calibrated score of a text column; null and empty texts get the score of no words."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        scorer = Scorer(model.lexicon)
        for batch in batches:
            parts = [model.scores(scorer, batch.slice(i, 256).to_pylist()) for i in range(0, len(batch), 256)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return score(text.cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of every row of ``docs``.

    Repeated rows get equal scores; null ids are scored like others; an empty table gives no rows;
    other columns are ignored.  Labels come only from rows that are not held out.
    """
    model = train(docs, labels, train_rows)
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text"), docs.sparkSession).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, all their columns as they are."""
    model = train(docs, labels, train_rows)
    return docs.where(score_column(model, F.col("text"), docs.sparkSession) < threshold)
