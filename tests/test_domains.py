"""Mail, conversation, book-index, layer and index pieces on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.operators import books as B
from corpusflow.operators import company as CO
from corpusflow.operators import convo as CV
from corpusflow.operators import images as IM
from corpusflow.operators import lookup as LK
from corpusflow.operators import mail as M
from corpusflow.operators import search as SE
from corpusflow.operators import stats as ST
from corpusflow.sources import readers as RD
from corpusflow.sources import sinks as SK


def one(df):
    return df.collect()[0].asDict(recursive=True)


def test_mail_record_and_page(spark):
    att = [("a/b?.txt", None, 3)]
    df = spark.createDataFrame([("u1", dt.datetime(2024, 1, 1, 15), 'A "x" <a@news.shop.com>', None, "**hi** [](x)", "inbox", "<m>", None, ["r"], att)],
                               "uid string, ts timestamp, sender string, subject string, body_md string, folder string, message_id string, in_reply_to string, "
                               "refs array<string>, attachments array<struct<filename:string,content_type:string,size:bigint>>")
    r = one(M.mail_records(df))
    assert (r["title"], r["tags"], r["character_count"], r["plain_text"]) == ("No Subject", ["email_backup", "from/shop"], 6, "hi")
    assert r["attachments"] == [{"filename": "ab.txt", "content_type": "application/octet-stream", "size": 3}]
    assert r["thread_info"] == {"message_id": "<m>", "in_reply_to": "", "refs": ["r"]}
    md = one(M.mail_markdown(M.mail_records(df)))["markdown"]
    assert md.startswith('---\nid: "u1"\ntitle: "No Subject"\nauthor: "A \\"x\\" <a@news.shop.com>"') and '- [[ab.txt]]' in md and md.endswith("## Content\n**hi**")
    path = one(df.select(M.target_path(F.col("folder"), F.lit("a@b"), F.col("ts"), F.lit("S: x"), F.col("uid")).alias("p")))["p"]
    assert path == "inbox/a@b/2024-01-02_00-00-00_S x_u1"


def test_mail_index_needs_a_long_id(spark):
    df = spark.createDataFrame([("i/s/2024_x_abcdefgh",), ("i/s/2024_x_short",), ("j/s/2025_x_abcdefgh",)], "path string")
    assert [r["path"] for r in M.mail_index(df).collect()] == ["j/s/2025_x_abcdefgh"]


def test_tool_blocks(spark):
    long = "\n".join(str(i) for i in range(151))
    df = spark.createDataFrame([("run", '{"a":1}', "x /ws/f\ny"), ("run", "{}", long), ("run", "{}", None)], "name string, args string, result string")
    a, b, c = [r["block"] for r in CV.call_blocks(df, "/ws").collect()]
    assert "> x ./f\n> y" in a and "[Truncated 1 lines" in b and "Result" not in c
    got = spark.createDataFrame([("1\n2\n3\n4",), ("1\n2",)], "r string").select(CV.result_digest("r").alias("d")).collect()
    assert [r["d"] for r in got] == ["1\n2\n3\n... (Total 4 lines)", "1\n2"]


def test_leading_assistant_turn(spark):
    df = spark.createDataFrame([("s", 0, "assistant", "a0"), ("s", 1, "assistant", "a1"), ("s", 2, "user", "q"), ("s", 3, "assistant", "x"), ("s", 4, "user", "r")],
                               "session_id string, step int, role string, content string")
    got = sorted((r["turn"], r["user_step"], r["request"], r["answer"]) for r in CV.turns(df).collect())
    assert got == [(0, -1, "N/A", "a1"), (1, 2, "q", "x"), (2, 4, "r", "N/A")]


def test_hot_session_transcript_is_split(spark):
    df = spark.range(1000).select(F.lit("s").alias("session_id"), F.col("id").alias("step"), F.lit("user").alias("role"), F.lit("x").alias("content"))
    parts = CV.transcript_parts(df, "/ws", part_size=100).orderBy("part").collect()
    assert len(parts) == 10 and "".join(p["markdown"] for p in parts).count("### [Step ") == 1000


def test_book_index_formats(spark):
    df = spark.createDataFrame([("B", "Ch 10", "u10"), ("B", "Ch 9", "u9")], "book string, title string, url string")
    text = lambda fmt: "\n".join(r["line"] for r in B.index_lines(df, fmt).orderBy("section", "sort_key").collect())
    assert text("obsidian") == "# 📚 B\n\n## 📑 Chapters\n\n- [Ch 9](./Ch 9.md)\n- [Ch 10](./Ch 10.md)"
    assert "- [Ch 9](#ch-9)" in text("joplin") and text("joplin").endswith("## Ch 10\n\n> Source: u10\n")


def test_company_fallbacks(spark):
    df = spark.createDataFrame([("정보 없음", "x")], "industry string, website string")
    out = CO.fill_missing(df, {"industry": F.lit("Tech"), "website": F.lit("y")})
    assert one(out) == {"industry": "Tech", "website": "x"}


def test_small_pieces(spark):
    r = one(spark.range(1).select(
        IM.planned_path(*[F.lit(x) for x in ("s", "2024", "01", "7")], F.lit(0), F.lit(".png")).alias("p"),
        *[c.cast("string").alias(n) for c, n in zip(ST.move_range(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"), -1), ("a", "b"))],
        D.date_partition(F.lit(None).cast("timestamp"))[0]))
    assert r == {"p": "/s/2024/01/images/7/img_0.png", "a": "2024-01-01", "b": "2024-01-07", "year": "unknown"}


def test_site_partitions_are_pruned_and_replaced(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "site string, v int")
    SK.reset_site(rows, f"{root}/silver/contents")
    SK.reset_site(rows.where("site = 'a'").withColumn("v", F.lit(9)), f"{root}/silver/contents")
    df = RD.read_layer(spark, root, "silver", "contents", site="a")
    assert [r["v"] for r in df.collect()] == [9]
    assert "PartitionFilters: [isnotnull(site" in df._jdf.queryExecution().executedPlan().toString()
    assert RD.read_layer(spark, root, "silver", "contents").count() == 2


def test_stored_index_answers_searches(spark, tmp_path):
    docs = spark.createDataFrame([("s_1", "s", "1", "alpha beta"), ("s_2", "s", "2", "beta")], "id string, site string, doc_id string, title string")
    SK.write_index(docs, SE.postings(docs), str(tmp_path))
    posts = spark.read.parquet(f"{tmp_path}/postings")
    got = SE.search(spark.read.parquet(f"{tmp_path}/docs"), posts, SE.vocabulary(posts), "alp", sort=None)
    assert [r["doc_id"] for r in got.collect()] == ["1"]
    plan = posts.where("term = 'beta'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,beta)" in plan


def test_index_takes_and_replaces_documents(spark, tmp_path):
    schema = "id string, site string, doc_id string, title string"
    docs = spark.createDataFrame([("s 1", "s", "1", "alpha beta"), ("s_2", "s", "2", "beta")], schema)
    SK.write_index(docs, SE.postings(docs), str(tmp_path))
    more = spark.createDataFrame([("s_1", "s", "1b", "gamma"), ("s_3", "s", "3", "beta")], schema)
    new = SK.update_index(spark, str(tmp_path), more, SE.postings(more))
    assert {(r["id"], r["title"]) for r in spark.read.parquet(f"{new}/docs").collect()} == {("s_1", "gamma"), ("s_2", "beta"), ("s_3", "beta")}
    assert {(r["term"], r["doc_id"]) for r in spark.read.parquet(f"{new}/postings").collect()} == {("gamma", "1b"), ("beta", "2"), ("beta", "3")}
    assert spark.read.parquet(f"{tmp_path}/docs").count() == 2


def test_written_date_counts_for_its_site(spark):
    df = spark.createDataFrame([(s, b) for s in ("linkedin", "geeknews", "yozm") for b in ('posted_date: "2024-01-01"', "**작성일:** 2024-02-02")], "site string, body string")
    rows = df.select("site", F.date_format(D.published_fallback(F.lit("2024-05-05"), F.lit(None).cast("string"), body=F.col("body"), site="site"), "MM-dd").alias("d"))
    got = [tuple(r) for r in rows.collect()]
    assert got == [("linkedin", "01-01"), ("linkedin", "05-05"), ("geeknews", "05-05"), ("geeknews", "02-02"), ("yozm", "05-05"), ("yozm", "05-05")]


def test_translated_chapter_wins(spark):
    df = spark.createDataFrame([("b", x) for x in ("a.md", "A.en-ko.md", "c.md", "README.md", "index.md", "x.txt")], "book string, file string")
    assert sorted(r["file"] for r in LK.prefer_translation(df, "book", "file").collect()) == ["A.en-ko.md", "c.md"]


def test_session_numbers_within_a_second(spark):
    df = spark.createDataFrame([("b", 1500), ("a", 1200), ("c", 2000)], "session_id string, ms bigint").select("session_id", F.timestamp_millis("ms").alias("created"))
    got = {r["session_id"]: r["tag"] for r in CV.session_numbers(df, "created").collect()}
    assert got == {"a": "0001-a", "b": "0002-b", "c": "0001-c"}


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    SK.reset_site(spark.createDataFrame([("a", "1", "x"), ("b", "1", "y")], "site string, id string, v string"), path)
    before = {f for f in spark.read.parquet(path).inputFiles() if "site=b" in f}
    SK.upsert_table(spark, path, spark.createDataFrame([("a", "1", "X"), ("a", "2", "Z")], "site string, id string, v string"), ["site", "id"], ["v"])
    after = spark.read.parquet(path)
    assert sorted((r["site"], r["id"], r["v"]) for r in after.collect()) == [("a", "1", "X"), ("a", "2", "Z"), ("b", "1", "y")]
    assert before == {f for f in after.inputFiles() if "site=b" in f}


def test_postings_shuffle_texts_once(spark):
    docs = spark.createDataFrame([("1", "a b")], "doc_id string, title string")
    plan = SE.postings(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_cluster_settings_grow_with_the_input():
    from corpusflow.session import cluster_settings
    small, large = cluster_settings(1 << 30, 8), cluster_settings(100 << 40, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16 and int(large["spark.sql.shuffle.partitions"]) == 524288


def test_both_stores_give_one_message_table(spark):
    steps = CV.parse_steps(spark.createDataFrame([
        ("s", 0, '{"type":"USER_INPUT","content":"q"}'), ("s", 1, '{"type":"PLANNER_RESPONSE","content":"a","tool_calls":[{"name":"run_command","args":{"x":1}},{"tool":"t2"}]}'),
        ("s", 2, '{"type":"OUT","content":"started task-7"}'), ("s", 3, "{broken"), ("s", 4, '{"type":"OUT","content":"r2"}'), ("s", 5, '{"type":"OUT","content":"surplus"}'),
        ("s", 6, '{"type":"SYSTEM_MESSAGE","content":"task-7 finished with result: ok"}'), ("s", 7, '{"type":"USER_INPUT","content":"z"}'), ("s", 8, '{"type":"OUT","content":"lost"}')],
        "session_id string, line_no bigint, line string"))
    log = CV.log_messages(steps)
    got = [(r["step"], r["role"], r["content"], [tuple(c) for c in r["tool_calls"]]) for r in log.orderBy("step").collect()]
    assert got == [(0, "user", "q", []), (1, "assistant", "a", [("run_command", '{"x":1}', "[Background Task task-7 finished]\nok"), ("t2", "{}", "r2")]), (2, "user", "z", [])]
    part = "session_id string, message_id bigint, ord int, type string, text string, tool string, input string, output string"
    parts = spark.createDataFrame([("s", 5, 1, "text", "b", None, None, None), ("s", 5, 0, "reasoning", "a", None, None, None), ("s", 5, 2, "tool", None, "run", '{"k":1}', "o")], part)
    msgs = spark.createDataFrame([("s", 2, "user", "hi"), ("s", 5, "assistant", "unused"), ("s", 9, "other", "x")], "session_id string, message_id bigint, role string, content string")
    store = CV.store_messages(msgs.select("session_id").distinct(), msgs, parts)
    assert store.columns == log.columns and store.schema["tool_calls"].dataType == log.schema["tool_calls"].dataType
    got = [(r["step"], r["role"], r["content"], [tuple(c) for c in r["tool_calls"]]) for r in store.orderBy("step").collect()]
    assert got == [(0, "user", "hi", []), (1, "assistant", "a\nb", [("run", '{"k":1}', "o")])]
