"""Keyed-state streams in several micro-batches, started again, with initial state and timers."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.streaming import stateful as SF
from corpusflow.streaming import streams as ST
from test_streams import ATTEMPTS, _attempts, _expected, _states, feed


def test_retry_stream_goes_on_after_a_restart(spark, tmp_path):
    """The second run of the query has its counters from the checkpoint alone."""
    rows, out = sorted(_attempts(), key=lambda r: r[2]), str(tmp_path / "out")
    schema = spark.createDataFrame([], ATTEMPTS).schema
    for part in (rows[:9], rows[9:20], rows[20:]):
        spark.createDataFrame(part, ATTEMPTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        SF.retry_stream(ST.file_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1), out).awaitTermination()
    want = _expected(rows)
    assert _states(ST.read_result(spark, out)) == want
    dead = {(r["id"], r["ord"]) for r in spark.read.parquet(f"{out}/dead").collect()}
    assert dead == {k for k, v in want.items() if v[1].startswith("failed")}


GIVEN = [[("s", "a", 1, False, "t"), ("s", "b", 1, False, None)], [("s", "a", 2, False, "t")]]


def test_retry_counters_start_from_given_ones(spark, tmp_path):
    stream = feed(spark, str(tmp_path / "in"), GIVEN, ATTEMPTS)
    initial = spark.createDataFrame([("s", "a", 2), ("s", "b", 0), ("s", "unseen", 1)], "site string, id string, fails int")
    SF.retry_stream(stream, str(tmp_path / "out"), initial).awaitTermination()
    assert _states(ST.read_result(spark, str(tmp_path / "out"))) == {("a", 1): (3, "failed"), ("a", 2): (1, "retry"), ("b", 1): (1, "retry")}


def test_counters_with_a_lifetime_run_until_stopped(spark, tmp_path):
    out = str(tmp_path / "out")
    q = SF.retry_stream(feed(spark, str(tmp_path / "in"), GIVEN, ATTEMPTS), out, ttl_ms=3_600_000, every="1 second")
    try:
        for _ in range(120):
            time.sleep(0.5)
            if q.lastProgress and q.lastProgress["batchId"] >= 2 or not q.isActive:
                break
    finally:
        q.stop()
    assert q.exception() is None
    assert _states(ST.read_result(spark, out)) == {("a", 1): (1, "retry"), ("a", 2): (2, "retry"), ("b", 1): (1, "retry")}


@pytest.mark.parametrize("seed", [1, 2])
def test_silent_workers_equal_the_batch_twin_and_the_plain_rule(spark, tmp_path, seed):
    """Beats out of order within the delay, repeated beats, workers that come back and one that never does."""
    rng, start = random.Random(seed), dt.datetime(2024, 1, 1)
    at = lambda s: start + dt.timedelta(seconds=s)
    beats = [(w, at(s)) for w in range(5) for s in sorted(rng.sample(range(3000), 30))]
    beats += [(7, at(100)), (7, at(100)), (8, at(2990)), (9, at(10)), (9, at(190)), (9, at(371))]
    beats.sort(key=lambda b: b[1])
    parts = [[b for b in beats if lo <= (b[1] - start).seconds < lo + 750] for lo in range(0, 3000, 750)]
    for a, b in zip(parts, parts[1:]):                         # a beat a little late
        if a and (b[0][1] - a[-1][1]).seconds < 40:
            b.append(a.pop())
    stream = feed(spark, str(tmp_path / "in"), parts, "worker int, ts timestamp")
    out = str(tmp_path / "out")
    ST.log_of(SF.silent_workers(stream, "worker", "ts"), out).awaitTermination()
    end, want = max(b[1] for b in beats) - dt.timedelta(minutes=1), set()
    for w, t in beats:
        nxt = min((u for v, u in beats if v == w and u > t), default=None)
        if t + dt.timedelta(minutes=3) <= end and (nxt is None or nxt - t > dt.timedelta(minutes=3)):
            want.add((w, t))
    stamp = lambda df: sorted((r["worker"], r["at"].replace(tzinfo=None)) for r in df.withColumn("at", F.timestamp_micros("silent_since_us")).collect())
    assert stamp(ST.read_result(spark, out)) == sorted(want)
    assert stamp(SF.silences(spark.createDataFrame(beats, "worker int, ts timestamp"), "worker", "ts").distinct()) == sorted(want)
    assert (7, at(100)) in want and (8, at(2990)) not in want and (9, at(190)) in want and (9, at(10)) not in want


def test_finish_messages_come_later_or_never(spark, tmp_path):
    """A message batches later, two of one task, one that is too late, one before its call, a call without any."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    calls = "session_id int, line_no int, call_no int, name string, result string, task_id string, ts timestamp"
    done = "session_id int, task_id string, done_line int, report string, ts timestamp"
    c = [[(1, 1, 1, "run_command", "wait task-1", "task-1", at(1)), (1, 2, 1, "run_command", "wait task-2", "task-2", at(2)), (1, 3, 1, "read", "text", None, at(3))],
         [(2, 5, 1, "run_command", "wait task-1", "task-1", at(50)), (2, 6, 1, "run_command", "wait task-9", "task-9", at(51))],
         [(-1, -1, -1, "", "", "", at(90_000))]]
    d = [[(2, "task-1", 4, "before the call", at(40))], [(1, "task-1", 10, " first ", at(60)), (1, "task-1", 20, "last\n", at(70))],
         [(1, "task-2", 30, "too late", at(4000))], [(-1, "", -1, "", at(90_000))]]
    out = str(tmp_path / "out")
    q = SF.attach_tasks_stream(feed(spark, str(tmp_path / "c"), c, calls), feed(spark, str(tmp_path / "d"), d, done), "1 hour")
    ST.log_of(q, out).awaitTermination()
    got = {(r["session_id"], r["line_no"]): r["result"] for r in SF.final_results(ST.read_result(spark, out).where("session_id >= 0")).collect()}
    assert got == {(1, 1): "[Background Task task-1 finished]\nlast", (1, 2): "wait task-2", (1, 3): "text", (2, 5): "wait task-1", (2, 6): "wait task-9"}
