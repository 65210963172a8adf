"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.base, name)

    def spread(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a table for a CPU-heavy stage, over all cores even when the table is one file."""
        df = table(self.spark, self.base, name)
        return spread(df.select(*columns) if columns else df)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; without ``sql`` only rows are checked."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")

        def run(spark: SparkSession, base: str) -> DataFrame:
            return fn(Tables(configure(spark), base))
        run.__name__, run.__doc__, run.module = name, fn.__doc__, fn.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register
