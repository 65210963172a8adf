"""Sinks: partitioned tables, keyed tables kept as a change log, indexes, dumps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_partition
from ..operators.upsert import index_key, latest_by_key, upsert, write_partitions
from ..session import cut_lineage


def write_by_date(rows: DataFrame, root: str, kind: str, date: str) -> None:
    """Table ``<root>/<kind>`` partitioned by site, year and month of the date; unknown dates have
    their own partition. Only the partitions present are replaced."""
    year, month = date_partition(date)
    write_partitions(rows.withColumn("year", year).withColumn("month", month), f"{root}/{kind}", ["site", "year", "month"])


def reset_site(rows: DataFrame, path: str) -> None:
    """Rebuild the partitions of the sites in ``rows``; other sites stay."""
    write_partitions(rows, path, ["site"])


def replace_table(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """Write a new version next to the old one and return its path; a table that is being read is
    never overwritten."""
    target = f"{path}/v-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(target)
    return target


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, key: list[str], set_fields: list[str],
                 set_on_insert: list[str] = (), by: str = "site") -> None:
    """Apply updates to a table partitioned by ``by`` (part of the key). Only the partitions the
    updates touch are read and rewritten; the merged rows are written elsewhere first, since a
    partition must not be overwritten while it is read."""
    # The semi-join prunes the partitions of the target at run time.
    target = spark.read.parquet(path).join(updates.select(by).distinct(), by, "left_semi")
    merged = upsert(target, updates, key, set_fields, set_on_insert)
    write_partitions(cut_lineage(merged, "upsert"), path, [by])


# --- keyed tables as change logs ------------------------------------------------------------------------
# A micro-batch appends its rows under its own batch folder, so replaying a batch after a failure
# replaces the same folder. The current table is the last row per key.

def append_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def current(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last row per key of a change log; ``batch_id`` decides, then ``order``."""
    return latest_by_key(log, key, ["batch_id", *order])


def compact(spark: SparkSession, path: str, key: list[str], order: list[str]) -> str:
    """Current rows of a log as a new one-batch log; readers switch to the returned path."""
    rows = current(read_log(spark, path), key, order)
    target = f"{path}-compact-{uuid.uuid4().hex[:8]}"
    append_batch(rows.drop("batch_id"), target, 0)
    return target


# Reading a log from its start gets longer with every batch. A compacted part holds the current rows up to a batch; readers
# take the newest complete one and the batches after it.

def compacted_upto(spark: SparkSession, path: str, part: str = "compact") -> int | None:
    """Last batch of the newest complete compacted part of the log under ``path``."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/upto=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found or ()), default=None)


def _batches(spark: SparkSession, path: str, after: int) -> list[str]:
    """Folders of the log under ``path`` of the batches after one."""
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*")
    found = folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders)
    return sorted(f.getPath().toString() for f in found or () if int(f.getPath().getName().split("=")[1]) > after)


def log_tail(spark: SparkSession, path: str, log: str = "log", part: str = "compact") -> DataFrame:
    """Rows of the newest compacted part and of the batches after it, with their ``batch_id``."""
    upto = compacted_upto(spark, path, part)
    if upto is None:
        return read_log(spark, f"{path}/{log}")
    base, later = spark.read.parquet(f"{path}/{part}/upto={upto}"), _batches(spark, f"{path}/{log}", upto)
    if not later:
        return base
    rows = spark.read.option("basePath", f"{path}/{log}").parquet(*later)
    return base.unionByName(rows, allowMissingColumns=True)


def current_log(spark: SparkSession, path: str, key: list[str], order: list[str]) -> DataFrame:
    """``current`` of the log under ``path/log``, read from its newest compacted part on."""
    return current(log_tail(spark, path), key, order)


def write_compacted(rows: DataFrame, path: str, upto: int, part: str = "compact") -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{part}/upto={upto}")


def write_index(docs: DataFrame, posts: DataFrame, path: str) -> None:
    """Search documents by key, and postings clustered by term so that a query reads few files."""
    docs.withColumn("id", index_key(F.col("id"))).write.mode("overwrite").parquet(f"{path}/docs")
    posts.repartitionByRange(F.col("term"), F.col("doc_id")).sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(f"{path}/postings")


def update_index(spark: SparkSession, path: str, docs: DataFrame, posts: DataFrame) -> str:
    """Add documents (one row per ``id``) and their postings to a stored index, or replace those it has, and return
    the path of the new version. Postings of a replaced document go, also those of terms it no longer holds; readers
    of ``path`` are not disturbed."""
    fresh = docs.withColumn("id", index_key(F.col("id")))
    old_docs = spark.read.parquet(f"{path}/docs")
    # The document may have had another ``doc_id`` before: its old postings are found by that one.
    replaced = old_docs.join(fresh.select("id").distinct(), "id", "left_semi").select("doc_id").unionByName(fresh.select("doc_id")).distinct()
    rest = old_docs.join(fresh.select("id").distinct(), "id", "left_anti")
    kept = spark.read.parquet(f"{path}/postings").join(replaced, "doc_id", "left_anti")
    target = f"{path}/v-{uuid.uuid4().hex[:12]}"
    write_index(rest.unionByName(fresh, allowMissingColumns=True), kept.unionByName(posts), target)
    return target


def write_json_dump(dump: DataFrame, path: str) -> None:
    dump.write.mode("overwrite").json(path)
