"""Corpus statistics: daily counts, funnels, queues, progress."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.jsonx import is_json_object, json_field
from .scan import max_plus_scan, prefix_scan, time_bucket


def daily_counts(docs: DataFrame, start: str, end: str, ts: str, site: str = "site") -> DataFrame:
    """``day, site, n`` by Korean calendar day; the range test is a plain comparison on ``ts``."""
    return (docs.where(D.in_kst_days(ts, start, end))
            .groupBy(D.kst_day(ts).alias("day"), F.col(site).alias("site")).agg(F.count("*").alias("n")))


def day_spine(spark, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(D.day_range(F.lit(start), F.lit(end))).alias("day"))


def with_spine(counts: DataFrame, start: str, end: str) -> DataFrame:
    """Every day of the range present; a day without rows has ``site`` NULL and ``n`` 0."""
    spine = day_spine(counts.sparkSession, start, end)
    return spine.join(counts, "day", "left").select("day", "site", F.coalesce("n", F.lit(0)).alias("n"))


def daily_pivot(counts: DataFrame, sites: list[str], start: str, end: str) -> DataFrame:
    """One row per day of the range, one column per site, ``total`` at the end."""
    wide = counts.groupBy("day").pivot("site", sites).agg(F.sum("n"))
    full = day_spine(counts.sparkSession, start, end).join(wide, "day", "left")
    filled = [F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(s) for s in sites]
    out = full.select("day", *filled)
    return out.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"`{s}`") for s in sites]))


def markdown_report(pivot: DataFrame, sites: list[str]) -> DataFrame:
    """Report lines ``(ord, line)`` of a daily pivot as a Markdown table."""
    cell = lambda c: F.when(F.col(f"`{c}`") > 0, F.concat(F.lit("**"), F.col(f"`{c}`"), F.lit("**"))).otherwise(F.lit("0"))
    body = pivot.select(F.col("day").cast("string").alias("ord"), F.concat(
        F.lit("| "), F.col("day").cast("string"), F.lit(" | "), F.concat_ws(" | ", *[cell(s) for s in sites]),
        F.lit(" | **"), F.col("total"), F.lit("** |")).alias("line"))
    head = ["| Date | " + " | ".join(sites) + " | Total |", "| :--- | " + " | ".join([":---:"] * len(sites)) + " | :---: |"]
    top = pivot.sparkSession.range(2).select(
        F.concat(F.lit("!"), F.col("id").cast("string")).alias("ord"),
        F.when(F.col("id") == 0, head[0]).otherwise(head[1]).alias("line"))
    return top.union(body)


def stats_summary(counts: DataFrame, site_part: str | None = None) -> DataFrame:
    """Highest daily total (10 when there is none) and the active sources."""
    rows = counts if site_part is None else counts.where(F.contains("site", F.lit(site_part)))
    per_day = rows.groupBy("day").agg(F.sum("n").alias("total"), F.collect_set(F.when(F.col("n") > 0, F.col("site"))).alias("s"))
    top = F.max("total")
    # Sources of a day are a handful of site names, so the nested set stays small.
    return per_day.agg(F.when(top > 0, top).otherwise(F.lit(10)).alias("max_daily"),
                       F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("sites"))


def move_range(start, end, weeks: int) -> tuple[Column, Column]:
    """Date range moved by whole weeks."""
    return F.date_add(start, 7 * weeks), F.date_add(end, 7 * weeks)


def site_funnel(layers: dict[str, DataFrame], site: str = "site") -> DataFrame:
    """Row counts of several layers per site in one aggregation; layers hold a site column."""
    tagged = reduce(DataFrame.unionByName, [
        d.select(F.col(site).alias("site"), F.lit(name).alias("layer")) for name, d in layers.items()])
    return tagged.groupBy("site").agg(*[F.count_if(F.col("layer") == n).alias(n) for n in layers])


def queue_counts(items: DataFrame, queue: str = "queue", payload: str = "payload") -> DataFrame:
    """Items per queue and site; malformed items and items without a site count as ``Unknown``."""
    site = F.coalesce(json_field(payload, "$.site"), F.lit("Unknown"))
    return items.groupBy(queue, site.alias("site")).agg(F.count("*").alias("n"))


def queue_peek(items: DataFrame, k: int, queue: str, order: list[str]) -> DataFrame:
    """First ``k`` items of each queue. The rank filter prunes to ``k`` rows per queue and task
    before the shuffle, so a long queue does not move as a whole."""
    w = Window.partitionBy(queue).orderBy(*order)
    return items.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def queue_dump(items: DataFrame, queue: str, payload: str, order: list[str], part_size: int = 1000) -> DataFrame:
    """All items of each queue as JSON arrays of at most ``part_size`` items (``ordinal`` gives the
    part), with malformed items kept as ``{"raw": ...}``. A long queue becomes many parts."""
    text = F.when(is_json_object(payload), F.col(payload)).otherwise(F.to_json(F.struct(F.col(payload).alias("raw"))))
    rows = items.withColumn("_part", F.floor(F.col(order[0]) / part_size))
    grouped = rows.groupBy(queue, F.col("_part").alias("part")).agg(
        F.count("*").alias("items"), F.sort_array(F.collect_list(F.struct(*order, text.alias("j")))).alias("a"))
    return grouped.select(queue, "part", "items", F.concat(F.lit("["), F.array_join(F.transform("a", lambda x: x["j"]), ","), F.lit("]")).alias("json"))


def snapshot_deltas(snapshots: DataFrame, ts: str, queue: str, n: str, bucket: Column | None = None) -> DataFrame:
    """Change of each queue length since the poll before."""
    out = prefix_scan(snapshots, [queue], [ts], time_bucket(ts, "day") if bucket is None else bucket,
                      {"_before": ("last", F.col(n))}, inclusive=False)
    return out.withColumn("delta", F.col(n) - F.col("_before")).drop("_before")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [d.agg(F.count("*").alias("n")).select(F.lit(k).alias("layer"), "n") for k, d in layers.items()])


def progress(completions: DataFrame, keys: list[str], order: list[str], ts: str, total: str, bucket: Column) -> DataFrame:
    """Per completion: number done, elapsed seconds, seconds left at the average speed so far."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    run = prefix_scan(completions, keys, order, bucket, {"done": ("sum", F.lit(1)), "_t0": ("min", t)})
    elapsed = F.floor((t - F.col("_t0")) / 1000000)
    left = F.floor(elapsed / (F.col("done") - 1) * (F.col(total) - (F.col("done") - 1)))
    return run.withColumn("elapsed_s", elapsed).withColumn("left_s", F.when(F.col("done") > 1, left)).drop("_t0")


def rate_violations(fetches: DataFrame, key: str, ts: str, tie: str, slack: Column, unit: str = "hour") -> DataFrame:
    """Fetches that came sooner than ``slack`` seconds after the one before on the same site."""
    return _gaps(fetches, key, ts, tie, unit).where(F.col("gap_s") < slack)


def rate_schedule(requests: DataFrame, key: str, ts: str, tie: str, slack: Column, unit: str = "hour") -> DataFrame:
    """Earliest time at which each request of a site may run, ``allowed_at`` with ``wait_s`` after the request, when they run in
    the order of their requests and at least ``slack`` seconds (one value per site) apart; none or a negative slack lets
    all run at once. Requests without site or time are left out."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = F.greatest(F.coalesce(slack, F.lit(0)), F.lit(0)) * 1000000
    out = max_plus_scan(requests, [key], [ts, tie], time_bucket(ts, unit), t, gap, "_allowed")
    return (out.withColumn("allowed_at", F.timestamp_micros("_allowed"))
            .withColumn("wait_s", (F.col("_allowed") - t) / 1000000.0).drop("_allowed"))


def heartbeat_gaps(beats: DataFrame, worker: str, ts: str, tie: str, minutes: float = 3, unit: str = "day") -> DataFrame:
    """Silences of a worker longer than the limit."""
    return _gaps(beats, worker, ts, tie, unit).where(F.col("gap_s") > minutes * 60)


def _gaps(rows: DataFrame, key: str, ts: str, tie: str, unit: str) -> DataFrame:
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    out = prefix_scan(rows, [key], [ts, tie], time_bucket(ts, unit), {"_before": ("last", t)}, inclusive=False)
    return out.withColumn("gap_s", (t - F.col("_before")) / 1000000.0).where("_before IS NOT NULL").drop("_before")


def capture_changes(captures: DataFrame, key: str, order: list[str], size: str, bucket: Column, pct: float = 0.15) -> DataFrame:
    """Captures whose size moved by more than ``pct`` against the capture before."""
    out = prefix_scan(captures, [key], order, bucket, {"size_before": ("last", F.col(size))}, inclusive=False)
    moved = F.abs(F.col(size) - F.col("size_before")) / F.col("size_before") > pct
    return out.where((F.col("size_before") > 0) & moved)


def ingest_counts(source: DataFrame, kept: DataFrame) -> DataFrame:
    """Original against new row counts of one run."""
    both = source.select(F.lit(0).alias("k")).union(kept.select(F.lit(1)))
    return both.agg(F.count_if(F.col("k") == 0).alias("original"), F.count_if(F.col("k") == 1).alias("new"))


def null_audit(docs: DataFrame, title: str, url: str, content: str, markdown: str) -> DataFrame:
    """Counts of placeholder titles, missing addresses and missing bodies in one pass."""
    t, u = F.col(title), F.col(url)
    return docs.agg(
        F.count("*").alias("rows"),
        F.count_if(t.isNull() | t.isin("", "Untitled")).alias("missing_title"),
        F.count_if(u.isNull() | (u == "")).alias("missing_url"),
        F.count_if(F.col(content).isNull() | F.col(markdown).isNull()).alias("missing_body"))


def column_matrix(docs: DataFrame, site: str, fields: list[str]) -> DataFrame:
    """``field, site, present``: does any row of the site carry the field?"""
    any_value = [F.max(F.col(f).isNotNull()).alias(f) for f in fields]
    wide = docs.groupBy(F.col(site).alias("site")).agg(*any_value)
    return wide.unpivot("site", fields, "field", "present")


def field_distribution(index: DataFrame, fields: list[str]) -> DataFrame:
    """Number of documents that carry each field, plus the total as field ``*``."""
    one = index.agg(F.count(F.lit(1)).alias("_all"), *[F.count(F.col(f)).alias(f) for f in fields])
    out = one.unpivot([], ["_all"] + fields, "field", "n")
    return out.withColumn("field", F.when(F.col("field") == "_all", "*").otherwise(F.col("field")))
