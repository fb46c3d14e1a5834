"""tidemark -- edit-activity rollups on Spark.

Raw JSON change events are cleaned and typed, counted in event-time windows,
enriched from a lookup dimension, written to idempotent partitioned Parquet
and read back by a library of reports.  Batch and streaming share the same
DataFrame transforms.
"""

from .config import DEFAULT, PipelineConfig

__all__ = ["DEFAULT", "PipelineConfig"]
