"""Streams that keep state per key: retry counters, silent workers, results that arrive in another stream.

State lives in the RocksDB store of the query's checkpoint, so a micro-batch reads and writes only the keys it
touches, and a query that is started again goes on where it stopped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.base import trim_ws
from ..operators.scan import prefix_scan, time_bucket
from ..sources.sinks import append_batch
from .streams import MAX_ATTEMPTS, PERMANENT, dead_letters, each_batch

# The processors travel with the plan, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> SparkSession:
    """Choose the state store that keyed state with timers needs; it holds state on disk, not on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


# Rows that leave a processor carry names.
_OUTCOME = Row("site", "id", "ord", "ok", "error", "attempt", "outcome")
_ALARM = Row("worker", "silent_since_us")


# --- retries -------------------------------------------------------------------------------------------------

class Retries(StatefulProcessor):
    """Failures of a task since its last success or dead letter. A task without any has no state."""

    def __init__(self, attempts: int, permanent: str, ttl_ms: int | None):
        self.attempts, self.permanent, self.ttl_ms = attempts, permanent, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fails = handle.getValueState("fails", StructType([StructField("n", IntegerType())]), self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["fails"]:
            self.fails.update((int(initialState["fails"]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fails = self.fails.get()[0] if self.fails.exists() else 0
        for r in sorted(rows, key=lambda r: r["ord"]):
            fails = 0 if r["ok"] else fails + 1
            gone = not r["ok"] and self.permanent in (r["error"] or "")
            outcome = "done" if r["ok"] else "failed_permanent" if gone else "failed" if fails >= self.attempts else "retry"
            yield _OUTCOME(*key, r["ord"], r["ok"], r["error"], fails, outcome)
            fails = fails if outcome == "retry" else 0
        if fails:
            self.fails.update((fails,))
        else:
            self.fails.clear()

    def close(self) -> None:
        pass


_STATES = StructType([StructField("site", StringType()), StructField("id", StringType()), StructField("ord", LongType()), StructField("ok", BooleanType()),
                      StructField("error", StringType()), StructField("attempt", IntegerType()), StructField("outcome", StringType())])


def retry_outcomes(attempts: DataFrame, initial: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Outcome of each attempt of a stream ``site, id, ord, ok, error``: the rules of ``streams.retry_states``. Attempts of a
    task must arrive in their order, within a micro-batch in any.

    ``initial(site, id, fails)`` are counters to start from, taken once when the query first runs. ``ttl_ms`` forgets the
    counter of a task that no attempt came for in that time."""
    keyed_state(attempts.sparkSession)
    rows = attempts.select("site", "id", "ord", "ok", "error").groupBy("site", "id")
    return rows.transformWithState(Retries(MAX_ATTEMPTS, PERMANENT, ttl_ms), _STATES, "append", "ProcessingTime" if ttl_ms else "None",
                                   initial.select("site", "id", "fails").groupBy("site", "id") if initial is not None else None)


def retry_stream(attempts: DataFrame, path: str, initial: DataFrame | None = None, ttl_ms: int | None = None, every: str = "1 minute") -> StreamingQuery:
    """Outcomes of attempts as a log under ``path/log`` and the dead letters among them under ``path/dead``. Ends with the
    available data; with ``ttl_ms``, where time itself is input, it runs ``every`` so often until it is stopped."""
    def body(df, i):
        append_batch(df, f"{path}/log", i)
        # The written rows are read back: the stateful plan runs once a batch.
        append_batch(dead_letters(df.sparkSession.read.schema(df.schema).parquet(f"{path}/log/batch_id={i}")), f"{path}/dead", i)
    states = retry_outcomes(attempts, initial, ttl_ms)
    if ttl_ms is None:
        return each_batch(states, f"{path}/_checkpoint", body)
    return states.writeStream.foreachBatch(body).option("checkpointLocation", f"{path}/_checkpoint").trigger(processingTime=every).start()


# --- silent workers --------------------------------------------------------------------------------------------

class Silence(StatefulProcessor):
    """Last beat of a worker, and the beats that may still be overtaken by earlier ones."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", StructType([StructField("us", LongType()), StructField("alarmed", BooleanType())]))
        self.open = handle.getListState("open", StructType([StructField("us", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._advance(key, [r["us"] for r in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues)

    def _advance(self, key, new, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        beats = sorted([r[0] for r in self.open.get()] + new) if self.open.exists() else sorted(new)
        last, alarmed = self.last.get() if self.last.exists() else (None, False)
        settled = [b for b in beats if b <= now]
        for b in settled:
            if last is not None and not alarmed and b - last > self.gap_us:
                yield _ALARM(*key, last)
            if last is None or b > last:
                last, alarmed = b, False
        rest = beats[len(settled):]
        if last is not None and not alarmed and last + self.gap_us <= now:
            yield _ALARM(*key, last)
            alarmed = True
        if last is not None:
            self.last.update((last, alarmed))
        self.open.clear()
        if rest:
            self.open.put([(b,) for b in rest])
        # Next time something can be decided: a waiting beat is settled, or the silence is long enough.
        due = ([rest[0]] if rest else []) + ([last + self.gap_us] if last is not None and not alarmed else [])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if due:
            self.handle.registerTimer(max(-(-min(due) // 1000), now // 1000 + 1))

    def close(self) -> None:
        pass


def silent_workers(beats: DataFrame, worker: str, ts: str, minutes: float = 3, delay: str = "1 minute") -> DataFrame:
    """Alarm ``worker, silent_since_us`` once per silence: no beat for ``minutes`` after that beat. A timer raises it as soon as
    the watermark (``delay`` behind the newest beat of any worker) has passed, so also for a worker that never comes back.
    Beats may be out of order by up to ``delay``."""
    keyed_state(beats.sparkSession)
    rows = beats.select(F.col(worker).alias("worker"), F.col(ts).alias("_ts"), F.unix_micros(ts).alias("us")).withWatermark("_ts", delay)
    out = StructType([StructField("worker", rows.schema["worker"].dataType), StructField("silent_since_us", LongType())])
    return rows.groupBy("worker").transformWithState(Silence(round(minutes * 60_000_000)), out, "append", "EventTime")


def silences(beats: DataFrame, worker: str, ts: str, minutes: float = 3, delay: str = "1 minute", unit: str = "day") -> DataFrame:
    """Batch twin of ``silent_workers`` over all beats: the alarms raised when the stream has read them all."""
    us = F.unix_micros(ts)
    gap, rows = round(minutes * 60_000_000), beats.select(F.col(worker).alias("worker"), F.col(ts).alias("_ts"), us.alias("us")).where("worker IS NOT NULL AND us IS NOT NULL")
    newest = F.floor(F.max("us") / 1000) * 1000 - F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {delay}"))
    end = rows.agg(newest).first()[0]
    nxt = prefix_scan(rows, ["worker"], ["us"], time_bucket("_ts", unit), {"_next": ("last", F.col("us"))}, reverse=True, inclusive=False)
    silent = nxt.where(F.col("_next").isNull() | (F.col("_next") - F.col("us") > gap))
    return silent.where(F.col("us") + gap <= F.lit(end)).select("worker", F.col("us").alias("silent_since_us"))


# --- results in another stream -----------------------------------------------------------------------------------

def attach_tasks_stream(calls: DataFrame, finishes: DataFrame, horizon: str, delay: str = "10 minutes") -> DataFrame:
    """Calls (``session_id, line_no, call_no, name, result, task_id, ts``) with the finish messages of their background tasks
    (``session_id, task_id, done_line, report, ts``) that arrive in another stream: a row per call and message that came
    after the call within ``horizon``, and a row without message for a call that none came for.

    Both sides are kept no longer than the horizon needs; the watermarks tell when an unanswered call is final. Messages
    later than the horizon are not attached."""
    c = calls.withWatermark("ts", delay).alias("c")
    f = finishes.select(F.col("session_id").alias("_s"), F.col("task_id").alias("_t"), "done_line", "report", F.col("ts").alias("_ts")).withWatermark("_ts", delay)
    on = (F.col("session_id") == F.col("_s")) & (F.col("task_id") == F.col("_t")) & (F.col("done_line") > F.col("line_no")) & \
        (F.col("_ts") >= F.col("ts")) & (F.col("_ts") <= F.col("ts") + F.expr(f"INTERVAL {horizon}"))
    return c.join(f, on, "left_outer").select("session_id", "line_no", "call_no", "name", "result", "task_id", "ts", "done_line", "report")


def final_results(attached: DataFrame) -> DataFrame:
    """One row per call of the log of ``attach_tasks_stream``: the last finish message counts."""
    last = attached.groupBy("session_id", "line_no", "call_no").agg(
        F.max("name").alias("name"), F.max("task_id").alias("task_id"), F.max("result").alias("_own"), F.max(F.struct("done_line", "report")).alias("_d"))
    finished = F.concat(F.lit("[Background Task "), "task_id", F.lit(" finished]\n"), trim_ws("_d.report"))
    return last.select("session_id", "line_no", "call_no", "name", "task_id", F.when(F.col("_d.done_line").isNotNull(), finished).otherwise(F.col("_own")).alias("result"))
