"""The given parquet tables (``{sf_dir}/{name}.parquet``) and input spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal a batch input's rows to ``partitions`` tasks, if the caller asks for it.

    For an input of few unsplittable files whose per-row JSON work is the costliest step.
    None, the default everywhere, leaves the input's own splits.  Round-robin sorts before it
    deals, so a retried task sees the same rows.
    """
    return df if df.isStreaming or not partitions else df.repartition(partitions)
