"""The warehouse as a partitioned catalog table.

``CREATE TABLE ... USING PARQUET PARTITIONED BY ... LOCATION`` over the sink
directory, then ``MSCK REPAIR TABLE`` (alias ``ALTER TABLE ... RECOVER
PARTITIONS``) after new partitions land.  Filters on ``ds``/``hr`` prune whole
directories.  A ``<name>_current`` view exposes the latest version per key.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sinks.warehouse import _stored_schema

_PARTITIONS = ("ds", "hr", "run_id", "batch_id")
#: Partitions named in one ALTER TABLE: a long backfill sends several statements.
PARTITIONS_PER_STATEMENT = 500


def _ddl_columns(kind: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in _stored_schema(kind).fields)


def register_table(spark: SparkSession, name: str, path: str, kind: str = "totals", rebuild: bool = False) -> None:
    """Create the catalog table over ``path`` and register what is there, unless it exists.

    A table that exists keeps its partitions: those that compaction dropped stay dropped, and a start
    lists nothing.  ``rebuild`` drops it and registers all folders again.  An empty append first
    makes sure the location exists (no data files are added), so a table can be declared before the
    first batch lands.
    """
    if rebuild:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if rebuild or not spark.catalog.tableExists(name):
        schema = _stored_schema(kind)
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*_PARTITIONS).parquet(path)
        spark.sql(
            f"CREATE TABLE {name} ({_ddl_columns(kind)}) USING PARQUET "
            f"PARTITIONED BY ({', '.join(_PARTITIONS)}) LOCATION '{path}' "
            "TBLPROPERTIES ('parquet.compression' = 'SNAPPY')"
        )
        repair(spark, name)
    current_of(spark, name, kind)


def current_of(spark: SparkSession, name: str, kind: str = "totals") -> None:
    """The ``<name>_current`` view of a table that exists."""
    # ds, hr lead the window partition so partition filters reach the scan
    key = "ds, hr, window_end, wiki" + (", event_type" if kind == "actions" else "")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name}_current AS "
        f"SELECT * EXCEPT (_version) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        "ORDER BY updated_at DESC NULLS LAST, batch_id DESC, run_id DESC) AS _version "
        f"FROM {name}) WHERE _version = 1"
    )


def register_totals_table(spark: SparkSession, name: str, path: str) -> None:
    register_table(spark, name, path, "totals")


def repair(spark: SparkSession, name: str) -> None:
    """Pick up partitions written since the last repair (lists the whole
    location: for a first registration or an occasional sweep)."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def _quote(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_partitions(spark: SparkSession, name: str, hours: list[tuple[str, str]], run_id: str, batch_id: int) -> None:
    """Register the partitions one batch wrote, without listing the table.

    ``hours`` is the (ds, hr) list of the batch -- a few hours for a
    micro-batch, at most the backfilled time range.
    """
    specs = [
        f"PARTITION (ds = {_quote(ds)}, hr = {_quote(hr)}, run_id = {_quote(run_id)}, batch_id = {int(batch_id)})"
        for ds, hr in hours
    ]
    for at in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[at:at + PARTITIONS_PER_STATEMENT])}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove the catalog table and its view; the files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}_current")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
