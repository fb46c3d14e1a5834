"""Broadcast only behind a measured size bound.

``measure`` sizes the candidate side with one distributed aggregate (row
count, serialized bytes, distinct keys -- partial aggregation on every
partition, nothing funnelled through one task).  Within both bounds
the side is hinted for broadcast; beyond them it is returned unhinted, so the
planner keeps a shuffle join (sort merge or shuffled hash, with AQE skew
splitting) and nothing unbounded is ever shipped to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def measure(df: DataFrame, key: str | None = None) -> tuple[int, int, int | None]:
    """(rows, approximate serialized bytes, distinct non-null keys) of ``df``, by one distributed aggregate."""
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    aggs = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")]
    if key is not None:
        aggs.append(F.count_distinct(F.col(key)).alias("k"))
    stats = df.agg(*aggs).first()
    return int(stats["n"]), int(stats["b"]), (int(stats["k"]) if key is not None else None)

