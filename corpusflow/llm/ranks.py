"""Positions of rows inside groups of any size, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.common import stored

_AT = (1 << 33) - 1      # the part of monotonically_increasing_id() that counts inside a partition


def laid_out(df: DataFrame, keys: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Sort ``df`` over the cluster by ``keys`` (never null) and ``order`` and return two tables: the rows with their
    partition ``_p`` and place ``_at`` in it, and a row per group and partition with ``_count`` and ``_shift``. The
    0-based position of a row in its group is ``_at + _shift`` of its group's row in its partition.

    A range partitioning splits a group however large it is; rows equal in all of ``order`` are split as well, by their
    place in the input. The second table has a row per group, and one more for each border that a group crosses, so the
    window that sums the counts sees at most as many rows of a group as there are partitions."""
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [*keys, *order, "_tie"]
    rows = tie.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    rows = stored(rows.withColumn("_p", F.spark_partition_id())
                  .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_AT))), name)
    count = rows.groupBy(*keys, "_p").agg(F.min("_at").alias("_first"), F.count("*").alias("_count"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")
    return rows, count.withColumn("_shift", shift).drop("_first")


def ranked(df: DataFrame, keys: list[str], order: list[str], rank: str, name: str) -> DataFrame:
    """``df`` with the 0-based position ``rank`` of each row among the rows of equal ``keys``, along ``order``."""
    rows, pieces = laid_out(df, keys, order, name)
    placed = rows.join(pieces.select(*keys, "_p", "_shift"), [*keys, "_p"])
    return placed.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(rank))
