"""Tables laid out in buckets of their key, so that an update touches only what it has to.

An index keeps documents and postings in hash buckets of the document: an update rewrites the buckets of its documents. A
keyed table keeps Spark's own buckets: an upsert joins it with the updates where it lies, without an exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import index_key, latest_by_key, upsert
from ..session import cut_lineage


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


# --- search index ------------------------------------------------------------------------------------------------

def _write(rows: DataFrame, path: str, order: list[str]) -> None:
    """Replace the buckets that occur in ``rows``; a large one becomes several files, each sorted."""
    (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def _keyed(docs: DataFrame, buckets: int) -> DataFrame:
    return docs.withColumn("id", index_key(F.col("id"))).withColumn("bucket", _bucket("id", buckets))


def _with_bucket(posts: DataFrame, docs: DataFrame) -> DataFrame:
    return posts.join(docs.select("doc_id", "bucket"), "doc_id").select(*posts.columns, "bucket")


def create_index(docs: DataFrame, posts: DataFrame, path: str, buckets: int = 256) -> None:
    """Index of search documents (one row per ``id``) and their postings: ``docs`` and ``postings`` in folders by bucket of the
    document, postings clustered by term inside, so that a word's rows are found by file statistics."""
    spark = docs.sparkSession
    keyed = _keyed(docs, buckets)
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(f"{path}/layout")
    _write(keyed, f"{path}/docs", ["id"])
    _write(_with_bucket(posts, keyed), f"{path}/postings", ["term", "doc_id"])


def update_index(spark: SparkSession, path: str, docs: DataFrame, posts: DataFrame) -> None:
    """Add documents (one row per ``id``) and their postings, or replace those the index has. Only the buckets of these
    documents are read and written; the files of all others stay. Postings of a replaced document go, also those of terms
    it no longer holds."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    fresh = cut_lineage(_keyed(docs, buckets), "index-fresh")
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]      # at most ``buckets`` numbers
    old_docs = spark.read.parquet(f"{path}/docs").where(F.col("bucket").isin(touched))
    old_posts = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(touched))
    # An id stays in its bucket, so do the postings of the version before, whatever its doc_id was.
    replaced = old_docs.join(fresh.select("id"), "id", "left_semi").select("doc_id").union(fresh.select("doc_id")).distinct()
    rest = old_docs.join(fresh.select("id"), "id", "left_anti")
    new_docs = cut_lineage(rest.unionByName(fresh, allowMissingColumns=True), "index-docs")
    new_posts = cut_lineage(old_posts.join(replaced, "doc_id", "left_anti").unionByName(_with_bucket(posts, fresh)), "index-postings")
    _write(new_docs, f"{path}/docs", ["id"])
    _write(new_posts, f"{path}/postings", ["term", "doc_id"])
    # A bucket whose documents have lost their last posting is not in the new rows.
    for b in set(touched) - {r["bucket"] for r in new_posts.select("bucket").distinct().collect()}:
        new_posts.drop("bucket").limit(0).write.mode("overwrite").parquet(f"{path}/postings/bucket={b}")


# --- keyed tables --------------------------------------------------------------------------------------------------

def create_keyed(rows: DataFrame, table: str, path: str, key: list[str], buckets: int = 256) -> None:
    """Table bucketed and sorted by its key, one file a bucket."""
    (rows.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", path).mode("overwrite").saveAsTable(table))


def merged(target: DataFrame, updates: DataFrame, key: list[str], set_fields: list[str], set_on_insert: list[str] = ()) -> DataFrame:
    """``upsert`` of a bucketed table: of repeated keys the last row in the order of the other columns counts. The updates are
    sent to the buckets; the table is not moved."""
    one = latest_by_key(updates, key, [c for c in updates.columns if c not in key])
    return upsert(target, one.hint("shuffle_merge"), key, set_fields, set_on_insert)


def upsert_keyed(spark: SparkSession, table: str, updates: DataFrame, path: str, key: list[str], set_fields: list[str],
                 set_on_insert: list[str] = ()) -> str:
    """Write the next version of a bucketed table below ``path`` and return its name; readers of ``table`` are not disturbed.
    Every join task holds one bucket and writes its file, so neither reading nor writing moves the table."""
    spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    buckets = int(spec["Num Buckets"])
    name = f"{table.split('__')[0]}__{uuid.uuid4().hex[:8]}"
    out = merged(spark.table(table), updates, key, set_fields, set_on_insert)
    out.write.bucketBy(buckets, *key).sortBy(*key).option("path", f"{path}/{name}").saveAsTable(name)
    return name
