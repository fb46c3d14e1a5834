"""S2 replay / backfill: the streaming transforms on a static read.

Batch mode closes every window (no watermark), so a backfill over stored raw
events -- a Kafka batch read from ``earliest`` or raw files -- gives the final
rollups.  The action rollup is persisted once; actions are written from it and
totals derived from it (A4), so the input is parsed once and no checkpoint is
left behind.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.parse import parse_events
from ..operators.checks import split_contract
from ..operators.current import current_view
from ..operators.enrich import prepare_lookup
from ..operators.rollups import actions_rollup, totals_from_actions
from ..schemas import ACTIONS_COLUMNS
from ..sinks.warehouse import read_rollup, write_batch


@dataclass(frozen=True)
class WarehousePaths:
    root: str

    @property
    def totals(self) -> str:
        return f"{self.root}/totals"

    @property
    def actions(self) -> str:
        return f"{self.root}/actions"

    @property
    def violations(self) -> str:
        return f"{self.root}/contract_violations"


def check_contract(actions: DataFrame, paths: WarehousePaths, run_id: str, batch_id: int,
                   config: PipelineConfig = DEFAULT) -> None:
    """K5 on one batch of action rows: list the rows that break the contract, or fail the batch."""
    if config.contract_mode == "off":
        return
    _, bad = split_contract(actions, config)
    if config.contract_mode == "fail":
        broken = bad.select("contract_reason").limit(1).collect()
        if broken:
            raise ValueError(f"batch {batch_id} breaks the table contract: {broken[0][0]}")
    elif not bad.isEmpty():
        stamped = bad.withColumn("run_id", F.lit(str(run_id))).withColumn("batch_id", F.lit(int(batch_id)))
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id", "batch_id").parquet(paths.violations)


def write_rollups(
    spark: SparkSession,
    actions: DataFrame,
    paths: WarehousePaths,
    run_id: str,
    batch_id: int,
    config: PipelineConfig = DEFAULT,
    updated_at: Column | None = None,
) -> None:
    """Write one batch of enriched action rows, then the totals derived from them.

    ``actions`` must be materialised by the caller (a persisted micro-batch or
    a checkpoint): it is read more than once.  Totals come from it directly --
    re-reading the table root would list every partition directory of the
    warehouse on each batch.  Every row is stored; rows that break the
    keyed-table contract (K5) are listed beside the tables with their rule, or
    fail the batch, per ``config.contract_mode``.
    """
    check_contract(actions, paths, run_id, batch_id, config)
    totals = totals_from_actions(actions.select(*ACTIONS_COLUMNS), config)
    # Both read the materialised actions and nothing else: submit the two
    # writes as concurrent Spark jobs.  Either failing fails the batch, whose
    # replay overwrites both (run_id, batch_id) partitions.
    with ThreadPoolExecutor(max_workers=2) as pool:
        pending = [
            pool.submit(write_batch, actions, paths.actions, run_id, batch_id, updated_at,
                        config.write_partitions, config.actions_table, config.partition_stats),
            pool.submit(write_batch, totals, paths.totals, run_id, batch_id, updated_at,
                        config.write_partitions, config.totals_table, config.partition_stats),
        ]
        for job in pending:
            job.result()


def input_run_id(files: list[str]) -> str:
    """A run id from the input's identity: its file names, in any order."""
    return "backfill-" + hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:16]


def run_backfill(
    spark: SparkSession,
    raw: DataFrame,
    lookup: DataFrame,
    paths: WarehousePaths,
    run_id: str,
    config: PipelineConfig = DEFAULT,
    batch_id: int = 0,
    updated_at: Column | None = None,
) -> WarehousePaths:
    """Backfill ``raw`` into the warehouse.

    ``run_id`` names the input: the same id replaces the earlier run over that
    input, another id adds to it.  It has no default, so two inputs never
    replace each other by accident; ``input_run_id`` derives one from files.
    """
    parsed = parse_events(raw, config=config)
    checked = prepare_lookup(lookup, config.lookup_broadcast_max_rows)
    actions = actions_rollup(parsed, checked, config, lookup_checked=True)
    # read several times below: kept once instead of re-parsing the input for
    # each; what a lost executor held is computed again from the input
    actions = actions.persist()
    try:
        write_rollups(spark, actions, paths, run_id, batch_id, config, updated_at)
    finally:
        actions.unpersist()
    return paths


def current_totals(spark: SparkSession, paths: WarehousePaths) -> DataFrame:
    return current_view(read_rollup(spark, paths.totals, "totals"))


def current_actions(spark: SparkSession, paths: WarehousePaths) -> DataFrame:
    return current_view(read_rollup(spark, paths.actions, "actions"))
