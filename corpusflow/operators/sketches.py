"""Distinct ids per site and layer from mergeable sketches.

The exact counts read every layer for each poll. A summary table instead holds one theta sketch per site, layer and day;
a poll merges those, and sketches of two layers tell how many ids one has and the other lacks. Up to ``2 ** lg`` ids a
sketch is exact; beyond, the standard error is about ``1 / sqrt(2 ** lg)`` of the count (of the larger layer for
differences).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG = 14          # up to 16,384 ids exact, then a standard error of 0.8 %


def summarize(rows: DataFrame, layer: str, ident: str, site: str, day: str, lg: int = LG) -> DataFrame:
    """Summary rows ``site, day, layer, sketch`` of a layer. New days are appended; a day that came again replaces its rows."""
    return rows.groupBy(F.col(site).alias("site"), F.col(day).alias("day")).agg(F.theta_sketch_agg(ident, lg).alias("sketch")).select(
        "site", "day", F.lit(layer).alias("layer"), "sketch")


def funnel(summary: DataFrame, layers: list[str], minus: list[tuple[str, str]] = (), lg: int = LG) -> DataFrame:
    """Distinct ids per site of each layer, and for each pair of ``minus`` those of the first that the second lacks
    (``first_not_second``). Days of a site are merged; an id of several days counts once."""
    of = lambda name: F.theta_union_agg(F.when(F.col("layer") == name, F.col("sketch")), lg)
    wide = summary.groupBy("site").agg(*[of(n).alias(n) for n in layers])
    counts = [F.theta_sketch_estimate(n).alias(n) for n in layers]
    lacking = [F.theta_sketch_estimate(F.theta_difference(a, b)).alias(f"{a}_not_{b}") for a, b in minus]
    return wide.select("site", *counts, *lacking)
