"""Ingest with its counts taken in the pass that writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sinks import append_batch, read_log


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Rows that count themselves while an action reads them."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), seen


def ingest(source: DataFrame, keep: Callable[[DataFrame], DataFrame], path: str, batch_id: int) -> None:
    """Write the rows that ``keep`` leaves as a batch of the log under ``path/log``, and how many came and were kept as a row
    under ``path/counts``. Source and output are read once, by the write. A batch that is run again replaces both, so it
    counts once. The counts are Spark's observed metrics: where a lost executor makes a shuffle run again inside one
    write, the source count can include its rows twice; the kept rows are counted in the writing stage."""
    rows, came = counted(source, f"came-{batch_id}")
    kept, left = counted(keep(rows), f"kept-{batch_id}")
    append_batch(kept, f"{path}/log", batch_id)
    counts = source.sparkSession.createDataFrame([(came.get["n"], left.get["n"])], "original long, new long")
    append_batch(counts.coalesce(1), f"{path}/counts", batch_id)


def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Original and new rows over all batches."""
    return read_log(spark, f"{path}/counts").agg(F.coalesce(F.sum("original"), F.lit(0)).alias("original"), F.coalesce(F.sum("new"), F.lit(0)).alias("new"))
