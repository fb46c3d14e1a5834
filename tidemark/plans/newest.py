"""Q4 / Q6 / Q8: the newest rows without the table's history.

A key lives in one hour, so whole hours can be read one after the other.  Hours are walked newest
first, a few, then twice as many, until what was read proves that no other hour can hold one of the
rows asked for:

* by update time, when the n-th newest row read is newer than the greatest update time of
  every hour not read (from the batches' statistics; a late batch that rewrites an old hour
  raises that hour's bound, so it is read early);
* by window, when n rows were read: a later hour's windows are all newer.

Only those hours' folders are listed and read.  What is collected is the walked part of the list of hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.current import current_view
from ..sinks.partition_stats import hours
from ..sinks.warehouse import _stored_schema
from . import reports

FIRST_HOURS = 4


def _read_hours(spark: SparkSession, path: str, kind: str, walked: list) -> DataFrame:
    """Current rows of some hours."""
    folders = [f"{path}/ds={h['ds']}/hr={h['hr']}" for h in walked]
    if not folders:
        return spark.createDataFrame([], _stored_schema(kind))
    return current_view(spark.read.schema(_stored_schema(kind)).option("basePath", path).parquet(*folders))


def _walk(spark: SparkSession, path: str, kind: str, n: int, order: list, pick: Callable[[DataFrame, int], DataFrame],
          proven: Callable[[DataFrame, object], bool]) -> DataFrame:
    ordered = hours(spark, path).orderBy(*order)
    take = FIRST_HOURS
    while True:
        ahead = ordered.limit(take + 1).collect()
        rows = pick(_read_hours(spark, path, kind, ahead[:take]), n)
        if len(ahead) <= take or proven(rows, ahead[take]):
            return rows
        take *= 2


def latest_rows(spark: SparkSession, path: str, kind: str = "totals", n: int = 2_000) -> DataFrame:
    """Q4 / Q6: the newest ``n`` current rows by update time, ties by key."""

    def proven(rows: DataFrame, following) -> bool:
        found = rows.agg(F.count(F.lit(1)).alias("rows"), F.min("updated_at").alias("oldest")).first()
        bound = following["newest_update"]  # the following hours are ordered by it: none is newer
        return found["rows"] >= n and bound is not None and found["oldest"] is not None and found["oldest"] > bound

    order = [F.col("newest_update").desc_nulls_first(), F.col("ds").desc(), F.col("hr").desc()]
    return _walk(spark, path, kind, n, order, reports.latest, proven)


def recent_rows(spark: SparkSession, path: str, kind: str = "totals", n: int = 150) -> DataFrame:
    """Q8: the newest ``n`` current rows by window, ties by key."""
    order = [F.col("ds").desc_nulls_last(), F.col("hr").desc_nulls_last()]
    return _walk(spark, path, kind, n, order, reports.recent_rows, lambda rows, _: rows.count() >= n)
