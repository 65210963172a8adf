"""Keyed table maintenance on plain Parquet: upsert, reset, identifiers.

There is no MERGE on Parquet, so an upsert is a full outer join on the key. Updates are reduced to one
row per key before the join, so a key repeated in the updates cannot multiply rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last row per key in a total order (partial aggregation before the shuffle)."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("_last")
    return rows.groupBy(*key).agg(last).select(*key, *[F.col(f"_last.{c}").alias(c) for c in order + rest]).select(*rows.columns)


def upsert(target: DataFrame, updates: DataFrame, key: list[str], set_fields: list[str],
           set_on_insert: list[str] = ()) -> DataFrame:
    """Target with ``updates`` applied: named fields are overwritten, insert-only fields are kept on
    rows that exist. ``updates`` must hold one row per key."""
    t, u = target.alias("t"), updates.alias("u")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in key])
    t_hit, u_hit = F.col(f"t.{key[0]}").isNotNull(), F.col(f"u.{key[0]}").isNotNull()

    def field(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c in key:
            return F.coalesce(old, F.col(f"u.{c}"))
        if c in set_fields:
            return F.when(u_hit, F.col(f"u.{c}")).otherwise(old)
        if c in set_on_insert:
            return F.when(t_hit, old).otherwise(F.col(f"u.{c}"))
        return old
    return t.join(u, on, "full_outer").select(*[field(c).alias(c) for c in target.columns])


def write_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Replace only the partitions present in ``rows``; others stay as they are. Rows meet by partition before the
    write; adaptive execution splits a large one into several files."""
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def index_key(c) -> Column:
    """Primary key the search index accepts."""
    return F.regexp_replace(c, "[^a-zA-Z0-9_-]", "_")
