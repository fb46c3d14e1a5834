"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words.  Within a source a document's expected copies are
proportional to its inclusion weight, at most ``limit`` and such that the expected words are the
target.  The whole part of the expected copies is certain.  The fraction left, ``p``, is an
inclusion probability: documents are ranked by their random odds over their inclusion
odds, ``(u / (1 - u)) / (p / (1 - p))``, and the sample is the front of that order.

The sample's size is fixed in words, the unit of the targets: the front ends before the document
that would pass what the source still lacks, then goes on with the documents further back that
still fit, round by round, until none fits or the gap is below ``TOLERANCE`` of the target.

``u`` is drawn from the MD5 of seed and doc_id, so reruns agree.  A source may hold any
share of the rows: the narrow rows are range-partitioned by (source, rank) and running totals
are taken per range, with the totals of earlier ranges added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, small

TOLERANCE = 0.001
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(rows: DataFrame, groups: list[str], budget: str, limit: str, weight: str, amount: str) -> DataFrame:
    """Adds ``amount``: the group's budget dealt by weight, where no row gets more than its limit.

    A row at its limit leaves the excess to the others by weight until none is above.  Rows fill
    in the order of limit / weight, so those at their limits are a front of that order.
    """
    order = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    order = order.orderBy(F.col(limit) / F.col(weight), weight, limit)
    before = F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(limit)
    rest = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", (F.col(budget) - before) / rest)
    rows = rows.withColumn("_full", F.col(limit) <= F.col("_level") * F.col(weight))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(whole)
    rows = rows.withColumn(amount, F.when(F.col("_full"), F.col(limit).cast("double")).otherwise(level * F.col(weight)))
    return rows.drop("_level", "_full")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes; no
    target is above ``limit`` times its source's size.  The table has a row per source.
    """
    turn = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    rows = rows.withColumn("_total", total).withColumn("_limit", F.col("source_size") * F.lit(limit))
    empty = rows.where("source_size = 0").select("source", "source_size", F.lit(0.0).alias("target"))
    rows = water_fill(rows.where("source_size > 0"), [], "_total", "_limit", "_weight", "target")
    return rows.select("source", "source_size", "target").union(empty)


def expected_copies(classes: DataFrame, limit: float = 3.0) -> DataFrame:
    """Adds ``copies`` to (source, target, weight, words): expected copies of each weight class of a source."""
    rows = classes.where("words > 0 and target > 0")
    rows = rows.withColumn("_limit", F.col("words") * F.lit(limit)).withColumn("_share", F.col("words") * F.col("weight"))
    rows = water_fill(rows, ["source"], "target", "_limit", "_share", "_amount")
    return rows.withColumn("copies", F.least(F.col("_amount") / F.col("words"), F.lit(limit))).drop("_limit", "_share", "_amount")


def damped(size: Column) -> Column:
    """Default inclusion weight: the fourth root of 1 / size, so fewer very long documents decide a mix."""
    return F.pow(F.greatest(size, F.lit(1)).cast("double"), F.lit(-0.25))


def mix(
    docs: DataFrame,
    row: str,
    weights: tuple[int, ...] = (5, 2, 1),
    limit: float = 3.0,
    inclusion=damped,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source and a unique ``row`` number).

    Returns row, doc_id, size, source_size, target, copies (int) and taken = copies * size.
    Null text has size 0 and is never taken; a null source is a source of its own, last in order;
    null doc_ids and repeated rows draw the same ``u`` and rank by the CRC of the text and the row
    number.  An inclusion weight is rounded to a quarter power of two, so a source has a bounded
    number of weight classes.  An empty table gives no rows; other columns are ignored.
    """
    size = word_count(F.col("text"))
    rows = docs.select(
        F.col(row).alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("tie"),
    )
    rows = materialise(rows.withColumn("class", F.round(F.log2(inclusion(F.col("size"))) * 4).cast("int")), "mix-rows")
    sums = materialise(rows.groupBy("source", "class").agg(F.sum("size").alias("words")), "mix-sums")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = materialise(source_targets(sources, weights, limit), "mix-targets")
    classes = _by_source(sums, targets).withColumn("weight", F.pow(F.lit(2.0), F.col("class") / 4))
    plan = expected_copies(classes, limit).select("source", "class", "words", "copies")
    plan = plan.withColumn("whole", F.floor(F.col("copies") + 1e-9).cast("int"))
    plan = plan.withColumn("part", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0)))
    plan = materialise(plan.withColumn("part", F.when(F.col("part") > 1e-9, F.col("part")).otherwise(0.0)), "mix-plan")
    certain = plan.groupBy("source").agg(F.sum(F.col("words") * F.col("whole")).alias("certain"))
    needs = _by_source(targets, certain).withColumn("gap", F.col("target") - F.coalesce("certain", F.lit(0)))
    needs = materialise(needs.drop("certain"), "mix-needs")

    rows = _by_source(rows, plan.select("source", "class", "whole", "part"), "class")
    rows = _by_source(rows, needs.drop("gap"))
    rows = rows.withColumn("whole", F.coalesce("whole", F.lit(0)))
    rows = rows.withColumn("part", F.when((F.col("size") > 0) & F.col("part").isNotNull(), F.col("part")).otherwise(0.0))
    u = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(u, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    rank = F.when(F.col("part") > 0, u / (1 - u) * (1 - F.col("part")) / F.col("part"))
    rows = rows.withColumn("rank", rank).repartitionByRange("source", "rank", "doc_id", "tie", "row")
    rows = rows.sortWithinPartitions("source", "rank", "doc_id", "tie", "row").withColumn("range", F.spark_partition_id())
    ranked = materialise(rows, "mix-ranked")

    done = [ranked.where("part = 0").withColumn("extra", F.lit(0))]
    left, gaps = ranked.where("part > 0"), needs.select("source", "target", "gap")
    while True:  # a round decides at least one row of each source that has any left
        left, chosen = _front(left, gaps)
        done.append(chosen)
        won = chosen.where("extra = 1").groupBy("source").agg(F.sum("size").alias("won"))
        gaps = _by_source(gaps, won).withColumn("gap", F.col("gap") - F.coalesce("won", F.lit(0))).drop("won")
        gaps = materialise(gaps, "mix-gaps")
        if left.isEmpty() or gaps.where(F.col("gap") > F.lit(TOLERANCE) * F.col("target")).isEmpty():
            break
    done.append(left.withColumn("extra", F.lit(0)))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part.select(*out.columns))
    copies = F.col("whole") + F.col("extra")
    return out.select(
        F.col("row").alias(row), "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def _by_source(rows: DataFrame, facts: DataFrame, *more: str) -> DataFrame:
    """Left join on the null-safe source and on ``more``; facts are broadcast only within the row bound."""
    facts = materialise(facts, "mix-facts")
    keys = ["source", *more]
    facts = small(facts.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in facts.columns]))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return rows.join(facts, on, "left").drop(*[f"_{c}" for c in keys])


def _front(left: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows still open, rows decided): of each source's rows that fit its gap, the front whose sizes fit together is taken.

    A row too long for the gap is decided against: the gap never grows.
    """
    names = left.columns
    rows = _by_source(left, gaps.select("source", "gap"))
    fit = rows.where("size <= gap")
    sums = materialise(fit.groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    earlier = F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words")
    within = Window.partitionBy("source", "range").orderBy("rank", "doc_id", "tie", "row").rowsBetween(Window.unboundedPreceding, 0)
    fit = fit.withColumn("_within", F.sum("size").over(within))
    fit = _by_source(fit, sums.select("source", "range", earlier.alias("_earlier")), "range")
    total = F.col("_earlier") + F.col("_within")
    fit = fit.select(*names, F.when(total <= F.col("gap"), 1).otherwise(0).alias("extra"))
    fit = materialise(fit, "mix-front")
    long = rows.where("size > gap").select(*names, F.lit(0).alias("extra"))
    return fit.where("extra = 0").drop("extra"), fit.where("extra = 1").unionByName(long)


def repeat_rows(docs: DataFrame, row: str, **settings) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it (``mix`` tells the settings); ``docs`` must be a written table."""
    taken = mix(docs, row, **settings).where("copies > 0").select(F.col(row).alias(f"{row}_taken"), F.col("copies").alias(f"{row}_copies"))
    taken = small(materialise(taken, "mix-taken"))
    rows = docs.join(taken, docs[row] == F.col(f"{row}_taken"))
    return rows.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), f"{row}_copies")).alias(f"{row}_copy")).drop(f"{row}_copy")
