"""Prefix scans inside large groups.

A window over one key runs in one task. Where a key may hold a large part of all rows, the scan is
done in two steps. First one summary row per (key, bucket) piece, made by a partial aggregation, is
scanned per key. Then each piece gets the running value of the pieces before it as an extra leading
row, and a window over (key, bucket) does the rest. The rows themselves are shuffled once and spread
over the cluster whatever the size of a key. ``bucket`` must be monotone in the order columns (a time
slice, ``floor(ordinal / n)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _running(kind: str, value: Column, w) -> Column:
    if kind == "sum":
        return F.coalesce(F.sum(value).over(w), F.lit(0))
    if kind == "last":
        return F.last(value, ignorenulls=True).over(w)
    return (F.max if kind == "max" else F.min)(value).over(w)


def _total(kind: str, value: Column, order: Column, reverse: bool) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "last":
        pick = F.min if reverse else F.max
        return pick(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))["v"]
    return (F.max if kind == "max" else F.min)(value)


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column,
                specs: dict[str, tuple[str, Column]], reverse: bool = False,
                inclusive: bool = True) -> DataFrame:
    """Add one running value per spec ``{name: (kind, value)}`` in key groups along ``order``.

    ``kind`` is ``sum``, ``last`` (last non-null value so far), ``max`` or ``min``. ``reverse`` scans
    from the end; without ``inclusive`` the row itself is left out, so ``last`` is a lag (or lead).
    """
    names = list(specs)
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    base = df.withColumn("_bucket", bucket)
    for n in names:
        base = base.withColumn(f"_v_{n}", specs[n][1])

    rank = F.struct(*[F.col(c) for c in order])
    totals = base.groupBy(*keys, "_bucket").agg(
        *[_total(specs[n][0], F.col(f"_v_{n}"), rank, reverse).alias(f"_t_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    lead = totals.select(*keys, "_bucket", F.lit(0).alias("_row"),
                         *[_running(specs[n][0], F.col(f"_t_{n}"), before).alias(f"_v_{n}") for n in names])

    rows = base.withColumn("_row", F.lit(1)).unionByName(lead, allowMissingColumns=True)
    piece = Window.partitionBy(*keys, "_bucket").orderBy("_row", *[direction(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    scanned = rows.select(*[F.col(c) for c in df.columns if c not in specs], "_row",
                          *[_running(specs[n][0], F.col(f"_v_{n}"), piece).alias(n) for n in names])
    return scanned.where("_row = 1").drop("_row")


def max_plus_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: Column, step: Column, name: str) -> DataFrame:
    """Add ``name``: the running value x_i = max(value_i, x_(i-1) + step) in key groups along ``order``, ``step`` the same
    within a key, both whole numbers. Rows without a key or bucket are left out.

    Unrolled, x_i = i * step + max over j up to i of (value_j - j * step), i the place in the group. A piece of (key, bucket)
    counts its places from 1 and keeps the running maximum; the pieces before it add the places they hold and their
    maximum, both from one row per piece. So rows are shuffled once, and the join meets its piece where it already is."""
    piece = [*keys, "_bucket"]
    base = df.withColumn("_bucket", bucket).withColumn("_v", value.cast("long")).withColumn("_step", step.cast("long"))
    inside = Window.partitionBy(*piece).orderBy(*order)
    local = base.withColumn("_i", F.row_number().over(inside).cast("long"))
    own = F.col("_v") - F.col("_i") * F.col("_step")
    local = local.withColumn("_m", F.max(own).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy(*piece).agg(F.count("*").alias("_n"), F.max(own).alias("_a"), F.max("_step").alias("_s"))
    totals = totals.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    totals = totals.withColumn("_c", F.max(F.col("_a") - F.col("_off") * F.col("_s")).over(before)).select(*piece, "_off", "_c")
    best = F.greatest(F.col("_m") - F.col("_off") * F.col("_step"), F.col("_c"))
    out = local.join(totals, piece).withColumn(name, best + (F.col("_off") + F.col("_i")) * F.col("_step"))
    return out.select(*[c for c in df.columns if c != name], name)


def ordinal_bucket(c: str, size: int = 4096) -> Column:
    return F.floor(F.col(c) / size)


def time_bucket(c: str, unit: str = "hour") -> Column:
    return F.date_trunc(unit, F.col(c).cast("timestamp"))
