"""Tolerant JSON helpers over VARIANT: a text is parsed once, its fields are typed paths of the parsed value.

``functions.jsonx`` reads a path of a JSON text at a time and parses the text for each. Where several fields of one text
are wanted, parse it with ``parsed`` in a column of its own and take the fields from that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, first_filled


def parsed(c) -> Column:
    """Variant of a JSON text; NULL for a malformed one."""
    return F.try_parse_json(col(c))


def text_at(v, *paths: str) -> Column:
    """First filled value among paths of a variant, as text (an object or list as its JSON)."""
    return first_filled(*[F.try_variant_get(col(v), p, "string") for p in paths])


def value_at(v, path: str, kind: str) -> Column:
    """Typed value of a path; NULL where it is missing or of another kind."""
    return F.try_variant_get(col(v), path, kind)


def is_object(v) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(col(v)), F.lit("OBJECT")), F.lit(False))


def is_list(v) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(col(v)), F.lit("ARRAY")), F.lit(False))


def items(v, path: str = "$") -> Column:
    """Values of a path that may hold one value or a list of them, as an array of variants; none for NULL."""
    at = F.try_variant_get(col(v), path, "variant")
    none = F.array().cast("array<variant>")
    return F.when(at.isNull() | F.is_variant_null(at), none).when(is_list(at), F.try_variant_get(at, "$", "array<variant>")).otherwise(F.array(at))


def record(v, fields: dict[str, str], **defaults: Column) -> Column:
    """Struct of typed top-level fields of an object; anything else gives the default record."""
    own = F.struct(*[F.try_variant_get(col(v), f"$.{n}", kind).alias(n) for n, kind in fields.items()])
    other = F.struct(*[defaults[n].cast(kind).alias(n) for n, kind in fields.items()])
    return F.when(is_object(v), own).otherwise(other)


def pairs(v, path: str) -> Column:
    """Map of a list of ``{key, value}`` objects; the last duplicate key wins, entries without a key are left out."""
    each = F.transform(items(v, path), lambda p: F.struct(F.try_variant_get(p, "$.key", "string").alias("key"), F.try_variant_get(p, "$.value", "string").alias("value")))
    keyed = F.filter(each, lambda p: p["key"].isNotNull())
    return F.aggregate(keyed, F.create_map().cast("map<string,string>"),
                       lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["key"]), F.map_from_entries(F.array(p))))
