"""Structured Streaming forms of the pipeline. Every query has a batch twin that gives the same rows.

Keyed results are change logs (see ``sources.sinks``): each micro-batch writes its own folder, which
makes a replay after a lost driver or executor idempotent; ``current`` reads the last row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.jsonx import json_field
from ..operators import convert as CV
from ..operators import logs as LG
from ..operators import search as SE
from ..operators.scan import prefix_scan
from ..operators.upsert import latest_by_key
from ..sources.sinks import append_batch, current, current_log, log_tail, read_log, write_compacted

MAX_ATTEMPTS = 3
PERMANENT = "HTTP status 404"


def file_stream(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder, at most ``files_per_batch`` per micro-batch."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", files_per_batch).parquet(path))


def each_batch(stream: DataFrame, checkpoint: str, body: Callable[[DataFrame, int], None], mode: str = "append",
               name: str | None = None) -> StreamingQuery:
    """Run ``body`` on every available micro-batch, then stop."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def log_of(stream: DataFrame, path: str, mode: str = "append") -> StreamingQuery:
    """Stream into a change log under ``path``."""
    return each_batch(stream, f"{path}/_checkpoint", lambda df, i: append_batch(df, f"{path}/log", i), mode)


def read_result(spark: SparkSession, path: str, key: list[str] | None = None, order: list[str] = ()) -> DataFrame:
    if key is None:
        return read_log(spark, f"{path}/log").drop("batch_id")
    return current_log(spark, path, key, list(order)).drop("batch_id")


def _due(batch: int, every: int | None) -> bool:
    return bool(every) and (batch + 1) % every == 0


# --- pipeline ------------------------------------------------------------------------------------------------

def ingest_captures(captures: DataFrame, path: str, compact_every: int | None = None) -> StreamingQuery:
    """Raw captures to the bronze log, last capture per (site, id) and batch; every so many batches the log is compacted."""
    def body(df, i):
        rest = [c for c in df.columns if c not in ("site", "id", "scraped_at")]
        last = df.groupBy("site", "id").agg(F.max(F.struct("scraped_at", *rest)).alias("m"))
        append_batch(last.select("site", "id", "m.*"), f"{path}/log", i)
        if _due(i, compact_every):
            write_compacted(current_log(df.sparkSession, path, ["site", "id"], ["scraped_at"]), path, i)
    return each_batch(captures, f"{path}/_checkpoint", body)


def convert_stream(bronze: DataFrame, site_key: str, path: str) -> StreamingQuery:
    """Bronze rows of a site to its silver log and the status rows of the frontier; of several captures of
    an id in a batch the newest counts."""
    def body(df, i):
        if "scraped_at" in df.columns:
            df = latest_by_key(df, ["id"], ["scraped_at"])
        meta = CV.convert(df, site_key)
        append_batch(CV.silver(meta, site_key), f"{path}/log", i)
        status = F.when(F.col("error").isNull(), "completed").otherwise("failed")
        append_batch(df.select("id", CV.raw_payload()[1].alias("error")).select("id", status.alias("status")), f"{path}/status", i)
    return each_batch(bronze, f"{path}/_checkpoint", body)


def index_stream(silver: DataFrame, path: str, run_ts: Column, compact_every: int | None = None) -> StreamingQuery:
    """Silver rows to the search-document log and the postings log, one version of a document per batch; every so many
    batches both are compacted."""
    def body(df, i):
        df = latest_by_key(df, ["id"], [c for c in ("updated_at", "published_at") if c in df.columns])
        docs = SE.search_documents(df, run_ts, F.coalesce("published_at", "updated_at"))
        append_batch(docs, f"{path}/log", i)
        append_batch(SE.postings(docs, "id"), f"{path}/postings", i)
        if _due(i, compact_every):
            spark = df.sparkSession
            live = _live_postings(spark, path)
            write_compacted(live, path, i, "compact-postings")
            write_compacted(current_log(spark, path, ["id"], []), path, i)
    return each_batch(silver, f"{path}/_checkpoint", body)


def _live_postings(spark: SparkSession, path: str) -> DataFrame:
    latest = log_tail(spark, path).groupBy("id").agg(F.max("batch_id").alias("batch_id"))
    return log_tail(spark, path, "postings", "compact-postings").join(latest.withColumnRenamed("id", "doc_id"), ["doc_id", "batch_id"], "left_semi")


def current_postings(spark: SparkSession, path: str) -> DataFrame:
    """Postings of the latest version of each document. A new version replaces all old postings of
    its document, also the terms it no longer holds."""
    return _live_postings(spark, path).drop("batch_id")


# --- retries -----------------------------------------------------------------------------------------------

def retry_states(attempts: DataFrame, bucket: Column) -> DataFrame:
    """Outcome of each attempt of a task (``site, id, ord, ok, error``): ``done``, ``retry`` while
    fewer than three attempts failed, else ``failed``; a permanent error fails at once. The attempt
    counter starts anew after a success or a dead letter. Works for a task with any number of attempts;
    the stream of it is ``stateful.retry_stream``."""
    rows = attempts.withColumn("permanent", ~F.col("ok") & F.contains(F.coalesce("error", F.lit("")), F.lit(PERMANENT)))
    rows = rows.withColumn("_w", F.when(F.col("ok"), 0).otherwise(1)).withColumn("_b", bucket)
    keys = ["site", "id"]
    n = prefix_scan(rows, keys, ["ord"], F.col("_b"), {"_n": ("sum", F.col("_w"))})
    # Failures counted up to and with the last boundary before this row.
    edge = F.when(F.col("ok") | F.col("permanent"), F.col("_n"))
    n = prefix_scan(n, keys, ["ord"], F.col("_b"), {"_e": ("last", edge)}, inclusive=False)
    run = F.col("_n") - F.coalesce("_e", F.lit(0))
    attempt = F.when(F.col("ok"), F.lit(0)).otherwise(F.pmod(run - 1, F.lit(MAX_ATTEMPTS)) + 1)
    out = n.withColumn("attempt", attempt.cast("int"))
    outcome = (F.when(F.col("ok"), "done").when(F.col("permanent"), "failed_permanent")
               .when(F.col("attempt") >= MAX_ATTEMPTS, "failed").otherwise("retry"))
    return out.withColumn("outcome", outcome).select(*attempts.columns, "attempt", "outcome")


def dead_letters(states: DataFrame) -> DataFrame:
    return states.where(F.col("outcome").isin("failed", "failed_permanent"))


# --- views ---------------------------------------------------------------------------------------------------

def dead_letter_counts(letters: DataFrame) -> DataFrame:
    """Running count of dead letters per site (update mode)."""
    return letters.groupBy(F.coalesce(json_field("payload", "$.site"), F.lit("Unknown")).alias("site")).agg(F.count("*").alias("n"))


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, by query name (or id): ``spark.streams.addListener(LateRows())``. In
    front of an aggregation, late rows of one group and task are one. A micro-batch run again counts once."""

    def __init__(self):
        self._batches: dict[str, dict[int, int]] = {}

    def count(self, query: str) -> int:
        return sum(self._batches.get(query, {}).values())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        if late:
            self._batches.setdefault(p.name or str(p.id), {})[p.batchId] = late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def dedupe_in_flight(tasks: DataFrame, ts: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """First row per key within the watermark delay; later repeats are dropped."""
    return tasks.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def daily_view(docs: DataFrame, ts: str, site: str, delay: str = "1 day") -> DataFrame:
    """Counts per Korean calendar day (midnight is 15:00 UTC) and site, kept up to date."""
    w = F.window(F.col(ts), "1 day", startTime="15 hours")
    return docs.withWatermark(ts, delay).groupBy(w, F.col(site).alias("site")).agg(F.count("*").alias("n")).select(
        F.to_date(F.from_utc_timestamp(F.col("window.start"), "Asia/Seoul")).alias("day"), "site", "n")


def parsed_logs(lines: DataFrame, run_ts: str) -> DataFrame:
    return LG.parse_logs(lines, run_ts)
