"""Tolerant JSON helpers over JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, first_filled


def json_field(c, *paths: str) -> Column:
    """First filled value among JSON paths of a text column; NULL for malformed JSON."""
    return first_filled(*[F.get_json_object(col(c), p) for p in paths])


def is_json_object(c) -> Column:
    return F.coalesce(F.json_object_keys(col(c)).isNotNull(), F.lit(False))


def tolerant_struct(c, schema: str, **defaults: Column) -> Column:
    """Parsed struct; a malformed text gives the default record instead."""
    parsed = F.from_json(col(c), schema)
    fallback = F.struct(*[v.alias(k) for k, v in defaults.items()])
    return F.when(is_json_object(c), parsed).otherwise(fallback)


def as_json_array(c) -> Column:
    """Array of JSON texts of a value that may be one object or a list of them."""
    t = F.trim(col(c))
    return F.when(F.startswith(t, F.lit("[")), F.coalesce(
        F.from_json(t, "array<string>"), F.array().cast("array<string>"))).when(
        t.isNull(), F.array().cast("array<string>")).otherwise(F.array(t))


def pairs_to_map(c) -> Column:
    """Map of an ``array<struct<key,value>>``; the last duplicate key wins, entries without a key are left out."""
    a = F.filter(col(c), lambda p: p["key"].isNotNull())
    # Explicit last-wins, so the result does not depend on a session setting.
    last = F.filter(a, lambda p, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def unescape(c) -> Column:
    """Decode the escapes of a doubly encoded text."""
    t = col(c)
    # \\\\ first becomes a mark, so that an escaped backslash does not start another escape.
    t = F.replace(t, F.lit("\\\\"), F.lit(""))
    for esc, char in [('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")]:
        t = F.replace(t, F.lit(esc), F.lit(char))
    return F.replace(t, F.lit(""), F.lit("\\"))
