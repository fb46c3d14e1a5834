"""Message key of a raw payload -- ``meta.id``, else ``id``; falsy -> no key.

The payload is read once, as the one element of an array: that refuses text
after the value and anything that is not JSON, and takes what the feed
client's parser takes (repeated names, the last one counting, and NaN).  Both
ids are read as text, so numbers keep their digits.

Truthiness follows the feed client: an empty string, zero, false, null, an
empty object or array are falsy; the string "0" is truthy.  Text alone cannot
tell the string "0" from the number 0, so only rows with such a text look at
the value's type; there, a payload with repeated names or NaN counts as not a
string.  Floats are written as the client writes them (``1e+20``, ``1.0``).
An object or array id keeps its JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPTIONS = {"allowSingleQuotes": "false"}
_ONE = "array<struct<id: string, meta: string>>"
# texts whose JSON type decides: numbers equal to zero, booleans, empty containers
_UNCLEAR = r"^(-?0+(\.0*)?([eE][-+]?[0-9]+)?|true|false|\{\}|\[\])$"


def _element(raw: Column) -> Column:
    return F.concat(F.lit("["), raw, F.lit("]"))


def payload(raw: Column) -> Column:
    """The payload's id and meta as text; null unless it is one JSON object."""
    read = F.from_json(_element(raw), _ONE, _OPTIONS)
    return F.when(raw.startswith("{") & (F.size(read) == 1), read[0])


def is_json(raw: Column) -> Column:
    """True for one JSON value of any kind."""
    return F.coalesce(F.size(F.from_json(_element(raw), "array<string>", _OPTIONS)) == 1, F.lit(False))


def _is_text(raw: Column, path: str) -> Column:
    value = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _float_text(text: Column) -> Column:
    """A float in exponent form as the feed client writes it."""
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    plain = F.regexp_replace(text.cast("double").cast("decimal(38,10)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    digits = F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    size = F.lpad(F.abs(power).cast("string"), 2, "0")
    size = F.when(F.abs(power) >= 100, F.abs(power).cast("string")).otherwise(size)
    exponent = F.concat(digits, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), size)
    return F.when(power.between(-4, 15), plain).otherwise(exponent)


def _key(text: Column, raw: Column, path: str) -> Column:
    """The id as the key's text; null when it is falsy."""
    unclear = text.rlike(_UNCLEAR)
    settled = F.when(_is_text(raw, path), text).when(text == "true", F.lit("True"))
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(unclear, settled)
        .when(text == '"NaN"', F.lit("nan")).when(text == '"Infinity"', F.lit("inf")).when(text == '"-Infinity"', F.lit("-inf"))
        .when(text.rlike(r"^-?[0-9]+\.[0-9]+E-?[0-9]+$"), _float_text(text))
        .otherwise(text)
    )


def with_message_key(df: DataFrame, raw: str = "raw", out: str = "message_key", valid: str | None = None) -> DataFrame:
    """Adds ``out`` (and ``valid``: the payload is one JSON object).

    The parsed payload sits behind a one-element Generate, so it is computed once per row.
    """
    base = [F.col(c) for c in df.columns]
    parsed = df.select("*", F.inline(F.array(F.struct(payload(F.col(raw)).alias("_p")))))
    inner = F.when(F.col("_p.meta").startswith("{"), F.from_json("_p.meta", "id string", _OPTIONS)["id"])
    ids = parsed.select("*", F.inline(F.array(F.struct(inner.alias("_meta_id")))))
    key = F.coalesce(_key(F.col("_meta_id"), F.col(raw), "$.meta.id"), _key(F.col("_p.id"), F.col(raw), "$.id"))
    extra = [F.col("_p").isNotNull().alias(valid)] if valid else []
    return ids.select(*base, key.alias(out), *extra)
