"""S1b stand-ins for the raw stream: text lines or given tables on files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .synthetic import raw_events


def text_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON event per line; ``raw STRING`` like the Kafka projection."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(directory).select(F.col("value").alias("raw"))


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("raw"))


def events_table_stream(spark: SparkSession, directory: str, file_glob: str = "events.parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """The given ``events`` parquet file(s) of ``directory`` as a file stream."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(directory).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(directory)


def events_stream(spark: SparkSession, directory: str, file_glob: str = "events.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """That stream turned into raw JSON events."""
    return raw_events(events_table_stream(spark, directory, file_glob, max_files_per_trigger), keep_id=False)
