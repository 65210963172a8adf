"""Session settings the operators rely on. Cluster sizing stays with the cluster."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Semantics only: nothing here sizes the job.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results (time zone, map duplicates) on a session."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    return spark


def cluster_settings(input_bytes: int, cores: int, html: bool = False) -> dict[str, str]:
    """Builder settings that size a job to its input: shuffle partitions of about 200 MB which AQE
    merges where less data arrives, at least two per core; small Arrow batches for wide markup rows."""
    partitions = max(2 * cores, -(-input_bytes // (200 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(200 << 20),
        "spark.sql.files.maxPartitionBytes": str((64 << 20) if html else (256 << 20)),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256" if html else "10000",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a directory; columns are pruned by the plan that uses it."""
    return configure(spark).read.parquet(f"{base}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Give a CPU-heavy stage over a small scan at least one partition per core. A scan with more
    partitions than cores, which is every large one, is left alone and not shuffled."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.isStreaming or scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusflow-")


def work_path(spark: SparkSession, name: str) -> str:
    """New folder for an intermediate table, in the shared directory the cluster names in
    ``spark.checkpoint.dir``. Where that is unset, a session in one process gets a temporary folder, and
    a cluster an error: its executors share no local folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a directory that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/_corpusflow/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write an intermediate result as a table in the shared directory and read it back: it is
    computed once, outlives an executor, and its readers still prune columns."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
