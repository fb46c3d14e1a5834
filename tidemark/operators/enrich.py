"""Left equi-join to the lookup dimension with fallbacks.

Miss, or a hit with a null cell: ``wiki_label := wiki``, ``language :=
'unknown'``.  Equality on ``wiki`` is case-sensitive.

The pipeline joins *after* aggregating (label and language are functions of
the wiki key once the lookup has one row per key), so the join touches one row
per (window, wiki[, type]) group instead of one per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..sources.lookup import dedupe_lookup
from .broadcast import DEFAULT_MAX_BYTES, measure

UNKNOWN_LANGUAGE = "unknown"


def prepare_lookup(lookup: DataFrame, max_rows: int = DEFAULT.lookup_broadcast_max_rows,
                   dedupe: bool = True) -> DataFrame:
    """One row per key (B3), hinted for broadcast only when the measured size
    fits.  The size is measured before de-duplication, which can only shrink
    it; the same distributed aggregate counts distinct keys, and a dimension
    whose keys are already unique skips the dedupe shuffle."""
    rows, size, keys = measure(lookup, key="lk_wiki_key")
    fits = rows <= max_rows and size <= DEFAULT_MAX_BYTES
    unique = keys == rows  # distinct counts skip nulls: equality also rules out null keys
    side = dedupe_lookup(lookup) if dedupe and not unique else lookup
    return F.broadcast(side) if fits else side


def enrich(df: DataFrame, lookup: DataFrame, checked: bool = False,
           max_rows: int = DEFAULT.lookup_broadcast_max_rows) -> DataFrame:
    side = lookup if checked else prepare_lookup(lookup, max_rows)
    label = F.coalesce("lk_wiki_label", "wiki").alias("wiki_label")
    language = F.coalesce("lk_language", F.lit(UNKNOWN_LANGUAGE)).alias("language")
    own = [c for c in df.columns if c not in ("wiki_label", "language")]
    return df.join(side, F.col("wiki") == F.col("lk_wiki_key"), "left").select(*own, label, language)
