"""Frontier upkeep: what to fetch next, what is done, what is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.base import contains_any
from ..sites import SiteSpec
from .scan import prefix_scan
from .upsert import latest_by_key, upsert

FAILED = ["failed", "failed_permanent"]
ITEM_ROWS = 250_000            # items of issues that a task takes at a time


def status_open(status="status") -> Column:
    """Not failed; a missing status counts as open."""
    s = F.col(status) if isinstance(status, str) else status
    return s.isNull() | ~s.isin(FAILED)


def select_work(frontier: DataFrame, done: DataFrame, queued: DataFrame, site: SiteSpec | None = None,
                overwrite: bool = False, error_reset: bool = False) -> DataFrame:
    """Rows to queue: open, not completed, not queued. ``overwrite`` takes completed and queued rows
    too; ``error_reset`` takes only failed rows."""
    rows = frontier.where("url IS NOT NULL AND url <> ''")
    if error_reset:
        rows = rows.where("status = 'failed'")
    else:
        rows = rows.where(status_open())
        if not overwrite:
            rows = rows.join(done.select("id"), "id", "left_anti")
    if site is not None:
        rows = rows.where(site.accepts(F.col("url")))
    if not overwrite:
        rows = rows.join(queued.select("url"), "url", "left_anti")
    return rows.select("id", "url")


def upsert_frontier(frontier: DataFrame, items: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    """Frontier after a listing run (``id, url, title, updated_at``): status from the completed set,
    ``pushed`` only on insert unless ``overwrite`` resets it."""
    flags = items.join(done.select("id").distinct().withColumn("_done", F.lit(True)), "id", "left")
    finished = F.lit(False) if overwrite else F.coalesce("_done", F.lit(False))
    updates = flags.select("id", "url", "title", F.when(finished, "completed").otherwise("new").alias("status"),
                           finished.alias("pushed"), "updated_at")
    sets = ["url", "title", "status", "updated_at"] + (["pushed"] if overwrite else [])
    return upsert(frontier, latest_by_key(updates, ["id"], ["updated_at", "url"]), ["id"], sets,
                  [] if overwrite else ["pushed"])


def newly_queued(frontier: DataFrame) -> DataFrame:
    """Rows a listing run sends to the queue: not completed and not pushed yet."""
    return frontier.where("status <> 'completed' AND NOT coalesce(pushed, false)").select("id", "url")


def seed_frontier(frontier: DataFrame, seeds: DataFrame, overwrite: bool = False) -> DataFrame:
    """Insert seeds that are missing; ``overwrite`` resets the existing ones."""
    fresh = seeds.select("id", "url", "title", F.lit("new").alias("status"), F.lit(False).alias("pushed"), "updated_at")
    sets = ["status", "pushed", "updated_at"] if overwrite else []
    inserts = [c for c in ("url", "title", "status", "pushed", "updated_at") if c not in sets]
    return upsert(frontier, latest_by_key(fresh, ["id"], ["updated_at", "url"]), ["id"], sets, inserts)


def completed_ids(bronze: DataFrame, id_col: str = "id", numeric_only: bool = False) -> DataFrame:
    ids = bronze.select(F.col(id_col).cast("string").alias("id")).where("id IS NOT NULL")
    return (ids.where(F.col("id").rlike(r"^\d+\z")) if numeric_only else ids).distinct()


def geo_targets(items: DataFrame, done: DataFrame, targets: list[str], geo_on: bool = True) -> DataFrame:
    """Direct items whose country is targeted, one per id, not completed."""
    rows = items.where("source = 'DIRECT'")
    if geo_on:
        rows = rows.where(F.col("geo").isin(targets))
    return rows.groupBy("id").agg(F.min("url").alias("url")).join(done.select("id"), "id", "left_anti")


def admission(tasks: DataFrame, domain: Column, site: SiteSpec) -> DataFrame:
    """Add the cleaned ``url``, its ``id`` and ``reject_reason`` (NULL when the task may run)."""
    rows = tasks.withColumn("url", U.strip_tracking("url")).withColumn("_host", U.host_of("url"))
    rows = rows.withColumn("id", site.id_rule(F.col("url")))
    own = F.coalesce(U.same_domain("_host", domain), F.lit(False))
    reason = (F.when(F.col("_host").isNull(), "invalid").when(~own, "domain").when(~site.passes_filter(F.col("url")), "filter")
              .when(contains_any("url", site.exclude), "exclude").when(F.coalesce("id", F.lit("")) == "", "no_id"))
    return rows.withColumn("reject_reason", reason).drop("_host")


def convert_backlog(bronze: DataFrame, silver: DataFrame, overwrite: bool = False) -> DataFrame:
    """Bronze ids without a silver record, compared as text; everything when ``overwrite``."""
    ids = bronze.select(F.col("id").cast("string").alias("id")).where("id IS NOT NULL").distinct()
    return ids if overwrite else ids.join(silver.select(F.col("id").cast("string").alias("id")), "id", "left_anti")


def reindex_tasks(silver: DataFrame, filter_field: str | None = None) -> DataFrame:
    ids = F.coalesce(F.col(filter_field).cast("string"), F.col("id").cast("string")) if filter_field else F.col("id").cast("string")
    return silver.select("site", ids.alias("id"))


def exhausted_listings(pages: DataFrame, key: list[str], page: str, items: str, bucket: Column) -> DataFrame:
    """Listing pages before the first empty page of their listing."""
    ended = prefix_scan(pages, key, [page], bucket, {"_empty": ("sum", F.when(F.col(items) == 0, 1).otherwise(0))})
    return ended.where("_empty = 0").drop("_empty")


def expand_issues(issues: DataFrame, topics: DataFrame, done: DataFrame) -> DataFrame:
    """Items of issue pages: each topic, then the issue itself, without what is completed.
    ``issues(issue_id)``, ``topics(issue_id, topic_id)``. Topics meet their issue, and equal items each other, in partitions
    of about ``ITEM_ROWS`` rows: their number follows the rows, which are counted first."""
    size = issues.count() + topics.count()
    parts = max(topics.sparkSession.sparkContext.defaultParallelism, -(-size // ITEM_ROWS))
    open_issues = issues.select("issue_id").repartition(parts, "issue_id").distinct().join(
        done.select(F.col("id").alias("issue_id")), "issue_id", "left_anti")
    rows = topics.repartition(parts, "issue_id").join(open_issues, "issue_id", "left_semi").select("issue_id", F.col("topic_id").alias("id"))
    rows = rows.union(open_issues.select("issue_id", F.col("issue_id").alias("id")))
    rows = rows.repartition(parts, "issue_id", "id").distinct()
    return rows.join(done.select("id"), "id", "left_anti").select("issue_id", "id")


def drain_order(tasks: DataFrame, seed: str) -> DataFrame:
    """Queue order of a batch as sort columns: priority rank, retries of high first, seeded site
    shuffle, enqueue time. A consumer takes ``orderBy(*columns).limit(n)``."""
    rank = F.when(F.col("priority") == "high", 0).when(F.col("priority") == "medium", 1).when(
        F.col("priority") == "low", 2).otherwise(3)
    high_retry = (F.col("priority") == "high") & (F.col("attempt") > 1)
    return tasks.select("*", rank.alias("priority_rank"), F.when(high_retry, 0).otherwise(1).alias("retry_rank"),
                        F.md5(F.concat("site", F.lit(seed))).alias("site_shuffle"))


DRAIN_KEYS = ["priority_rank", "retry_rank", "site_shuffle", "enqueued_at", "id"]
