"""Streams fed in several micro-batches give what their batch twins give."""

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.scan import ordinal_bucket
from corpusflow.sources import readers as RD
from corpusflow.sources import sinks as SK
from corpusflow.streaming import stateful as SF
from corpusflow.streaming import streams as ST


def feed(spark, path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in{i}")
    return ST.file_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_batch=1)


ATTEMPTS = "site string, id string, ord bigint, ok boolean, error string"


def _attempts():
    fail, gone = "timeout", "HTTP status 404 for x"
    seq = [("hot", o, False, fail) for o in range(0, 40)] + [("hot", 40, True, None), ("hot", 41, False, gone), ("hot", 42, False, fail)]
    seq += [("b", 1, False, fail), ("b", 2, False, gone), ("b", 3, False, fail), ("b", 50, True, None)]
    return [("s", i, o, ok, e) for i, o, ok, e in seq]


def _expected(rows):
    out, fails = {}, {}
    for _, i, o, ok, e in sorted(rows, key=lambda r: (r[1], r[2])):
        if ok:
            fails[i] = 0
            out[(i, o)] = (0, "done")
            continue
        fails[i] = fails.get(i, 0) + 1
        state = "failed_permanent" if "404" in e else "failed" if fails[i] >= 3 else "retry"
        out[(i, o)] = (fails[i], state)
        if state != "retry":
            fails[i] = 0
    return out


def _states(df):
    return {(r["id"], r["ord"]): (r["attempt"], r["outcome"]) for r in df.collect()}


def test_retry_batch_equals_the_step_by_step_rule(spark):
    df = spark.createDataFrame(_attempts(), ATTEMPTS)
    assert _states(ST.retry_states(df, ordinal_bucket("ord", 8))) == _expected(_attempts())
    assert ST.dead_letters(ST.retry_states(df, ordinal_bucket("ord", 8))).count() == sum(v[1].startswith("failed") for v in _expected(_attempts()).values())


@pytest.mark.parametrize("cuts", [(10, 41), (1, 2), (41, 42)])
def test_retry_stream_does_not_depend_on_batches(spark, tmp_path, cuts):
    rows = sorted(_attempts(), key=lambda r: r[2])
    a, b = cuts
    parts = [[r for r in rows if r[2] < a], [r for r in rows if a <= r[2] < b], [r for r in rows if r[2] >= b]]
    stream = feed(spark, str(tmp_path / "in"), [p for p in parts if p], ATTEMPTS)
    SF.retry_stream(stream, str(tmp_path / "out")).awaitTermination()
    assert _states(ST.read_result(spark, str(tmp_path / "out"))) == _expected(rows)


def test_capture_log_keeps_the_latest(spark, tmp_path):
    schema = "site string, id string, raw_html string, scraped_at timestamp"
    ts = lambda d: __import__("datetime").datetime(2024, 1, d)
    stream = feed(spark, str(tmp_path / "in"), [[("s", "1", "a", ts(1)), ("s", "1", "b", ts(2)), ("s", "2", "x", ts(1))], [("s", "1", "c", ts(3))]], schema)
    out = str(tmp_path / "out")
    ST.ingest_captures(stream, out).awaitTermination()
    got = {r["id"]: r["raw_html"] for r in ST.read_result(spark, out, ["site", "id"], ["scraped_at"]).collect()}
    assert got == {"1": "c", "2": "x"}
    small = SK.compact(spark, out + "/log", ["site", "id"], ["scraped_at"])
    assert SK.read_log(spark, small).count() == 2


def test_index_drops_postings_of_old_versions(spark, tmp_path):
    schema = "site string, id string, title string, content string, published_at string, updated_at string"
    stream = feed(spark, str(tmp_path / "in"), [[("s", "1", "t", "old words", None, "1"), ("s", "2", "t", "old", None, "1")], [("s", "1", "t", "new words", None, "2")]], schema)
    out = str(tmp_path / "out")
    ST.index_stream(stream, out, F.lit("now")).awaitTermination()
    posts = {(r["doc_id"], r["term"]) for r in ST.current_postings(spark, out).where("field = 4").collect()}
    assert posts == {("s_1", "new"), ("s_1", "words"), ("s_2", "old")}


def test_compacted_logs_read_alike(spark, tmp_path):
    """The same stream with and without compaction; readers of the compacted one leave the old batches alone."""
    ts = lambda d: __import__("datetime").datetime(2024, 1, d)
    schema = "site string, id string, raw_html string, scraped_at timestamp"
    parts = [[("s", str(k % 3), f"v{b}{k}", ts(b + 1)) for k in range(b, b + 3)] for b in range(5)]
    docs = "site string, id string, title string, content string, published_at string, updated_at string"
    texts = [[("s", str(k % 3), "t", f"word{b} w{k}", None, str(b)) for k in range(b, b + 2)] for b in range(5)]
    got, posts = [], []
    for name, every in (("plain", None), ("compacted", 2)):
        out = str(tmp_path / name)
        ST.ingest_captures(feed(spark, str(tmp_path / f"in-{name}"), parts, schema), out, every).awaitTermination()
        got.append(sorted(map(tuple, ST.read_result(spark, out, ["site", "id"], ["scraped_at"]).select("site", "id", "raw_html").collect())))
        index = str(tmp_path / f"index-{name}")
        ST.index_stream(feed(spark, str(tmp_path / f"docs-{name}"), texts, docs), index, F.lit("now"), every).awaitTermination()
        posts.append(sorted(map(tuple, ST.current_postings(spark, index).select("doc_id", "term", "tf").collect())))
    assert got[0] == got[1] and len(got[0]) == 3 and posts[0] == posts[1] and len(posts[0]) == 12
    assert SK.compacted_upto(spark, str(tmp_path / "plain")) is None and SK.compacted_upto(spark, str(tmp_path / "compacted")) == 3
    files = SK.log_tail(spark, str(tmp_path / "compacted")).inputFiles()
    assert any("upto=3" in f for f in files) and not any(f"batch_id={i}" in f for f in files for i in range(4))


def test_a_table_in_several_files_streams_whole(spark, tmp_path):
    """Tables may be one file or a folder of files, whatever these are called."""
    from corpusflow.plans import all_queries
    pages = spark.createDataFrame([(i, f"https://a.test/{i}", f"<title>t{i}</title><p>x</p>") for i in range(6)], "page_id bigint, url string, html string")
    docs = spark.createDataFrame([(i, f"one two{i}", "en", "src", 8) for i in range(6)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    base = str(tmp_path / "tables")
    pages.repartition(3).write.parquet(f"{base}/pages.parquet")
    docs.repartition(3).write.parquet(f"{base}/documents.parquet")
    queries = all_queries()[0]
    assert {(r["id"], r["url"]) for r in queries["stream_bronze"](spark, base).collect()} == {(str(i), f"https://a.test/{i}") for i in range(6)}
    assert {(r["id"], r["status"]) for r in queries["stream_convert"](spark, base).collect()} == {(str(i), "completed") for i in range(6)}
    assert {r["kind"]: r["n"] for r in queries["stream_index"](spark, base).collect()} == {"docs": 6, "terms": 7}


def test_daily_view_counts_across_batches(spark, tmp_path):
    dt = __import__("datetime").datetime
    stream = feed(spark, str(tmp_path / "in"), [[(dt(2024, 1, 1, 14), "a"), (dt(2024, 1, 1, 16), "a")], [(dt(2024, 1, 1, 17), "a")]], "ts timestamp, site string")
    out = str(tmp_path / "out")
    ST.log_of(ST.daily_view(stream, "ts", "site"), out, "update").awaitTermination()
    got = {(str(r["day"]), r["n"]) for r in ST.read_result(spark, out, ["day", "site"]).collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 2)}


def test_late_rows_are_counted(spark, tmp_path):
    dt = __import__("datetime").datetime
    stream = feed(spark, str(tmp_path / "in"), [*[[(dt(2024, 1, 9, h), "a")] for h in (1, 2, 3)], [(dt(2024, 1, 1, 1), "a"), (dt(2024, 1, 1, 2), "b")]], "ts timestamp, site string")
    late = ST.LateRows()
    spark.streams.addListener(late)
    try:
        out = str(tmp_path / "out")
        q = ST.each_batch(ST.daily_view(stream, "ts", "site"), f"{out}/_checkpoint", lambda df, i: df.count(), "update", name="late_rows")
        q.awaitTermination()
        for _ in range(50):
            if late.count("late_rows"):
                break
            __import__("time").sleep(0.2)
        assert late.count("late_rows") == 2 and late.count("other") == 0
    finally:
        spark.streams.removeListener(late)


def test_file_sources(spark, tmp_path):
    (tmp_path / "book one").mkdir()
    (tmp_path / "book one" / "Chapter 2.md").write_text("# hi\nthere", encoding="utf-8")
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.md").write_text("no", encoding="utf-8")
    (tmp_path / "urls.txt").write_text("# c\n\nhttps://a \\\nnope\n", encoding="utf-8")
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{broken\n{"a": 2}\n', encoding="utf-8")
    got = RD.read_markdown_dir(spark, str(tmp_path)).where("book = 'book one'").collect()[0]
    assert (got["book"], got["title"], got["content"]) == ("book one", "Chapter 2", "# hi\nthere")
    assert RD.list_files(spark, [str(tmp_path), str(tmp_path)], [".md"]).count() == 1
    assert [r["url"] for r in RD.read_url_list(spark, str(tmp_path / "urls.txt"), http_only=True).collect()] == ["https://a"]
    assert sorted(r["a"] for r in RD.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [1, 2]


def test_intermediate_tables_go_to_the_shared_folder(spark):
    from corpusflow.session import cut_lineage
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
