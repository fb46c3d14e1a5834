"""Sharding by jump consistent hashing, in built-in expressions only.

``jump(key, n)`` walks the shard counts at which the key would move: from shard ``b`` the
next such count is ``j = floor((b + 1) * 2^31 / ((state >> 33) + 1))`` with ``state`` a
64-bit linear congruential sequence seeded by the key.  The last ``b`` below ``n`` is the
shard.  Adding a shard moves keys only into it, and no ring table exists.

The 64-bit state is kept as two 32-bit halves, so no step overflows in ANSI mode.  A walk
visits strictly growing counts; ``SHORT_WALK`` steps end nearly all of them, and the rows
left go on with as many steps as there are shards, so the result is exact for any ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Fixed value: multiplier of the published algorithm's generator.
MULTIPLIER = 2862933555777941757
SHORT_WALK = 24
ROWS_PER_RUN = 50_000


def stable_key(key: Column) -> tuple[Column, Column]:
    """Halves of a 60-bit seed from the MD5 of the key's text; null counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 7), 16, 10).cast("long"), F.conv(F.substring(digest, 8, 8), 16, 10).cast("long"))


def _advance(s: Column) -> tuple[Column, Column]:
    """(high, low) of state * MULTIPLIER + 1 modulo 2^64."""
    m0, m1, mh = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF, MULTIPLIER >> 32
    word = F.lit(0xFFFFFFFF)
    high, low = s["high"], s["low"]
    upper = low * F.lit(m1)
    lower = low * F.lit(m0) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftright(lower, 32) + F.shiftright(upper, 16)
    cross = (low * F.lit(mh)).bitwiseAND(word)
    turn = (high * F.lit(m0)).bitwiseAND(word) + F.shiftleft((high * F.lit(m1)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (carry + cross + turn).bitwiseAND(word), lower.bitwiseAND(word)


def _walk(state: Column, shards: int, steps: int) -> Column:
    def step(s: Column, _: Column) -> Column:
        high, low = _advance(s)
        j = F.floor((s["j"] + 1) * (F.lit(2147483648.0) / (F.shiftright(high, 1) + 1))).cast("long")
        moved = F.struct(s["j"].alias("b"), j.alias("j"), high.alias("high"), low.alias("low"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, step)


def jump(key: Column, shards: int) -> Column:
    """Shard of ``key`` among ``shards``."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    high, low = stable_key(key)
    state = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), high.alias("high"), low.alias("low"))
    short = _walk(state, shards, SHORT_WALK)
    if shards <= SHORT_WALK:
        return short["b"].cast("int")
    return F.element_at(
        F.transform(F.array(short), lambda s: F.when(s["j"] < shards, _walk(s, shards, shards)["b"]).otherwise(s["b"])), 1
    ).cast("int")


def shard_table(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 16.  The key and the shard count alone decide
    the shard (law ``key``), so rows of one key, repeated rows and all null keys share a shard;
    null text has 0 bytes and the CRC of nothing.  ``slot`` numbers the rows of a shard from 0
    without gaps.  An empty table gives no rows; other columns are ignored.

    Slots need no task that holds a shard: the narrow rows are written once with a row number,
    counted per run of ``ROWS_PER_RUN`` row numbers and shard, and only rows of one run are
    sorted together, however hot a shard or a key is.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump(F.col(key), shards).alias("shard"),
        jump(F.col(key), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialise(rows.withColumn("_run", F.expr(f"_row div {ROWS_PER_RUN}")), "shards")
    counts = materialise(rows.groupBy("shard", "_run").count(), "shard-runs")
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("_run")) - F.col("count")
    before = counts.select("shard", "_run", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("shard", "_run").orderBy("_row")) - 1
    placed = rows.withColumn("_place", place)
    return placed.join(before, ["shard", "_run"]).select(
        key, "size", "text_crc32", "law", "shard", (F.col("_before") + F.col("_place")).cast("long").alias("slot"), "grown_shard"
    )
