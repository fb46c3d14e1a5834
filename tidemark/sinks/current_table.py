"""K2 / K3: the current rows as a table of their own, kept up to date batch by batch.

Reading the current view sorts all versions of the hours it reads.  Here the newest version of
every key is stored: a batch is merged into the hours it touches, and no other hour is read or
written.  A touched hour is rewritten as a whole into a new generation folder
(``<path>/generation=<id>/ds=/hr=``), then the catalog's partition is pointed at it.  Readers take
the location from the catalog, so they see an hour either before or after the merge; files they
are reading stay until ``remove_superseded`` finds them out of use for longer than a retention.

The merge keeps the version that the current view would keep, so a repeated batch changes nothing,
a late batch that is older than what is stored changes nothing, and every attempt writes a
generation of its own: it never replaces files that the table points at.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.current import current_view
from ..sources.warehouse import PARTITIONS_PER_STATEMENT, _quote
from .warehouse import _stored_schema

_HOUR = ("ds", "hr")


def create_current_table(spark: SparkSession, name: str, path: str, kind: str = "totals") -> None:
    """The empty table, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _stored_schema(kind).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET PARTITIONED BY (ds, hr) LOCATION {_quote(f'{path}/empty')}")


def _spec(hour) -> str:
    return f"PARTITION (ds = {_quote(hour['ds'])}, hr = {_quote(hour['hr'])})"


def _same_hour(hours: list) -> F.Column:
    """Rows of some hours, as a filter that prunes partitions."""
    by_day: dict[str, list[str]] = {}
    for hour in hours:
        by_day.setdefault(hour["ds"], []).append(hour["hr"])
    wanted = F.lit(False)
    for ds, hrs in by_day.items():
        wanted = wanted | ((F.col("ds") == ds) & F.col("hr").isin(hrs))
    return wanted


def merge_batch(spark: SparkSession, name: str, path: str, versions: DataFrame) -> list[tuple[str, str]]:
    """Merge a batch of stored rows into the table; the hours that were rewritten.

    Hours in which the batch changes nothing are left as they are.
    """
    table = spark.table(name)
    versions = versions.select(*table.columns).persist()
    try:
        touched = versions.select(*_HOUR).distinct().collect()  # the hours of one batch
        if not touched:
            return []
        merged = current_view(table.where(_same_hour(touched)).unionByName(versions)).persist()
        try:
            old = table.where(_same_hour(touched)).select(*_HOUR, F.lit(1).alias("was"), F.xxhash64(*table.columns).alias("row"))
            new = merged.select(*_HOUR, F.lit(0).alias("was"), F.xxhash64(*table.columns).alias("row"))
            # order-free sums of row hashes and counts tell changed hours
            both = old.unionByName(new).groupBy(*_HOUR, "was").agg(F.count("*").alias("n"), F.sum(F.col("row").cast("decimal(38,0)")).alias("sum"))
            changed = both.groupBy(*_HOUR, "n", "sum").agg(F.count("*").alias("sides")).where("sides = 1").select(*_HOUR).distinct().collect()
            if not changed:
                return []
            generation = f"{path}/generation={int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
            rows = merged.where(_same_hour(changed)).hint("rebalance", *_HOUR)
            rows.write.option("compression", "snappy").partitionBy(*_HOUR).parquet(generation)
        finally:
            merged.unpersist()
    finally:
        versions.unpersist()
    _point(spark, name, generation, changed)
    return sorted((h["ds"], h["hr"]) for h in changed)


def _point(spark: SparkSession, name: str, generation: str, hours: list) -> None:
    """Point the catalog's partitions at a generation that is whole."""
    known = {r[0] for ds in {h["ds"] for h in hours} for r in spark.sql(f"SHOW PARTITIONS {name} PARTITION (ds = {_quote(ds)})").collect()}
    fresh = [h for h in hours if f"ds={h['ds']}/hr={h['hr']}" not in known]
    for hour in hours:
        if hour not in fresh:
            spark.sql(f"ALTER TABLE {name} {_spec(hour)} SET LOCATION {_quote(_folder(generation, hour))}")
    for at in range(0, len(fresh), PARTITIONS_PER_STATEMENT):
        specs = " ".join(f"{_spec(h)} LOCATION {_quote(_folder(generation, h))}" for h in fresh[at : at + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(name)


def _folder(generation: str, hour) -> str:
    return f"{generation}/ds={hour['ds']}/hr={hour['hr']}"


def remove_superseded(spark: SparkSession, name: str, path: str, retention_seconds: float) -> int:
    """Delete hour folders that the table no longer points at and that are older than the retention; their number.

    A generation is written before the catalog points at it, so the retention has to exceed the longest merge and the longest read.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for folder in files.globStatus(jvm.org.apache.hadoop.fs.Path(root, "generation=*/ds=*/hr=*")) or []:
        if folder.getModificationTime() / 1000.0 > time.time() - retention_seconds:
            continue
        at = folder.getPath()
        ds, hr = at.getParent().getName().split("=", 1)[1], at.getName().split("=", 1)[1]
        if _location(spark, name, ds, hr) != at.toUri().getPath():
            removed += bool(files.delete(at, True))
    return removed


def _location(spark: SparkSession, name: str, ds: str, hr: str) -> str | None:
    """Path of the folder that the catalog has for an hour."""
    spec = _spec({"ds": ds, "hr": hr})
    if spark.sql(f"SHOW PARTITIONS {name} {spec}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").where("col_name = 'Location'").select("data_type").first()
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(described[0]).toUri().getPath() if described else None
