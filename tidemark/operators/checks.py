"""Preflight and contract checks (V1, V3, K5).

All checks are aggregations that run in Spark; only their tiny summaries
(one row per rule) are returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..schemas import ACTIONS_KEY, TOTALS_KEY


def ensure_table(spark: SparkSession, name_or_path: str) -> None:
    """V1: the target table (catalog name or Parquet path) must exist before
    streams start; raise with the remedy otherwise."""
    try:
        if spark.catalog.tableExists(name_or_path):
            return
    except Exception:  # not a table identifier: treat as a path
        pass
    try:
        spark.read.parquet(name_or_path).schema  # noqa: B018 - lists the path
    except Exception as exc:
        raise RuntimeError(
            f"Rollup table {name_or_path!r} is missing; run the backfill or create the "
            "warehouse table before starting the streams."
        ) from exc


def lookup_dup_keys(lookup: DataFrame) -> DataFrame:
    """V3: keys that occur more than once (and how often)."""
    return (
        lookup.groupBy("lk_wiki_key")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def contract_violations(rollup: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """K5: one row per violated rule of the keyed-table contract, with a count.

    Rules: null key columns, duplicate keys, and text longer than the column
    sizes of the keyed tables.  One pass: a group-by on the key (partial
    aggregation before its shuffle) counts every row rule per key, then one
    global sum folds the groups.
    """
    key = ACTIONS_KEY if "event_type" in rollup.columns else TOTALS_KEY
    limits = {
        "wiki": config.max_wiki_len,
        "wiki_label": config.max_label_len,
        "language": config.max_language_len,
    }
    if "event_type" in rollup.columns:
        limits["event_type"] = config.max_event_type_len
    null_key = None
    for k in key:
        null_key = F.col(k).isNull() if null_key is None else null_key | F.col(k).isNull()
    rules = {"null_key": null_key}
    rules.update({f"{c}_too_long": F.char_length(F.col(c)) > F.lit(n) for c, n in limits.items()})
    per_key = rollup.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(cond).alias(name) for name, cond in rules.items()]
    )
    summary = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
        F.count_if(F.col("_rows") > 1).alias("duplicate_key"),
    )
    return summary.unpivot([], [*rules, "duplicate_key"], "rule", "violations").filter(F.col("violations") > 0)


def contract_reason(rollup: DataFrame, config: PipelineConfig = DEFAULT):
    """Per-row K5 rule a row breaks first (null when it keeps the contract)."""
    key = ACTIONS_KEY if "event_type" in rollup.columns else TOTALS_KEY
    null_key = None
    for k in key:
        null_key = F.col(k).isNull() if null_key is None else null_key | F.col(k).isNull()
    reason = F.when(null_key, F.lit("null_key"))
    limits = [("wiki", config.max_wiki_len), ("wiki_label", config.max_label_len),
              ("language", config.max_language_len)]
    if "event_type" in rollup.columns:
        limits.append(("event_type", config.max_event_type_len))
    for c, n in limits:
        reason = reason.when(F.char_length(F.col(c)) > F.lit(n), F.lit(f"{c}_too_long"))
    return reason


def split_contract(rollup: DataFrame, config: PipelineConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(rows keeping the keyed-table contract, rows breaking it with a reason).

    Keys are unique per batch by construction (they are the grouping keys), so
    only the row rules apply here; ``contract_violations`` also checks keys.
    """
    flagged = rollup.withColumn("contract_reason", contract_reason(rollup, config))
    ok = flagged.filter(F.col("contract_reason").isNull()).drop("contract_reason")
    bad = flagged.filter(F.col("contract_reason").isNotNull())
    return ok, bad
