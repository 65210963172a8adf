"""Operators on small literal tables, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import url as U
from corpusflow.operators import audit as A
from corpusflow.operators import books as B
from corpusflow.operators import frontier as FR
from corpusflow.operators import images as IM
from corpusflow.operators import links as L
from corpusflow.operators import logs as LG
from corpusflow.operators import search as SE
from corpusflow.operators import stats as ST
from corpusflow.operators import upsert as UP
from corpusflow.operators.scan import ordinal_bucket, prefix_scan
from corpusflow.sites import SiteSpec

SITE = SiteSpec("d", "D", U.job_id, "d.com", exclude=["login"])


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


# --- prefix scans against brute force: one key holds most rows, one key is NULL --------------------------

def _series():
    rnd = random.Random(7)
    data = [("hot", i, rnd.choice([None, rnd.randint(-5, 9)])) for i in range(600)]
    data += [(rnd.choice(["a", "b", None]), 10000 + i, rnd.randint(0, 9)) for i in range(200)]
    rnd.shuffle(data)
    return data


def _brute(data, kind, reverse, inclusive):
    out = {}
    for key in {k for k, _, _ in data}:
        group = sorted([(o, v) for k, o, v in data if k == key], reverse=reverse)
        for i, (o, _) in enumerate(group):
            seen = [v for _, v in group[:i + (1 if inclusive else 0)] if v is not None]
            out[(key, o)] = {"sum": sum(seen), "last": seen[-1] if seen else None,
                             "max": max(seen, default=None), "min": min(seen, default=None)}[kind]
    return out


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_prefix_scan(spark, reverse, inclusive):
    data = _series()
    df = spark.createDataFrame(data, "k string, o bigint, v int").repartition(5)
    kinds = ("sum", "last", "max", "min")
    out = prefix_scan(df, ["k"], ["o"], ordinal_bucket("o", 16), {f"s_{k}": (k, F.col("v")) for k in kinds}, reverse, inclusive).collect()
    assert len(out) == len(data)
    for kind in kinds:
        want = _brute(data, kind, reverse, inclusive)
        assert all(r[f"s_{kind}"] == want[(r["k"], r["o"])] for r in out), kind


# --- links ------------------------------------------------------------------------------------------------

PAGE = """<html><script>var x = '<a href="/no">';</script><!-- <a href="/gone"> --><body>
<a href="/post-1234567">a</a><a class='x' href='/post-1234567?utm_source=f#t'>b</a><a href=//d.com/x>c</a>
<a href="mailto:me">m</a><a href="https://e.com/p">e</a><a href="https://s.com/?u=https%3A%2F%2Fd.com%2Fshared">s</a>
<a href="/file.zip">z</a><a href="/login">l</a><a href="/a b">bad</a><a href="">none</a><a href="/x&amp;y">amp</a><a href="/">root</a></body></html>"""


def _outcomes(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, '<a href="/post-1234567">again</a>')], "page_id int, html string")
    return L.link_outcomes(L.anchors(pages), F.lit("d.com"), SITE)


def test_link_outcomes(spark):
    got = {r["href"]: (r["outcome"], r["url"], r["shared"]) for r in _outcomes(spark).where("page_id = 1").collect()}
    assert got["/post-1234567"] == ("ok", "https://d.com/post-1234567", False)
    assert got["//d.com/x"][1] == "https://d.com/x" and got["/x&y"][0] == "ok"
    assert got["https://s.com/?u=https%3A%2F%2Fd.com%2Fshared"] == ("ok", "https://d.com/shared", True)
    assert {h: got[h][0] for h in ("mailto:me", "https://e.com/p", "/file.zip", "/login", "/a b", "", "/")} == {
        "mailto:me": "protocol", "https://e.com/p": "domain", "/file.zip": "binary", "/login": "excluded", "/a b": "malformed",
        "": "empty", "/": "ok"}
    assert "/no" not in got and "/gone" not in got


def test_discovery_and_funnel_agree(spark):
    out = _outcomes(spark)
    known = L.known_ids(spark.createDataFrame([("x",), (None,)], "id string"))
    new = rows(L.discover_new(out, known, ["page_id", "pos"]), "dst_id", "url")
    assert ("1234567", "https://d.com/post-1234567") in new and not any(i == "x" for i, _ in new)
    f = L.link_funnel(out, known).collect()[0]
    assert f["new_urls"] == len(new) and f["total_anchors"] == 12 and f["share_extracted"] == 1
    skipped = sum(f[c] for c in ("malformed_skipped", "exclude_skipped", "protocol_skipped", "domain_skipped", "binary_skipped"))
    assert f["total_anchors"] == skipped + f["after_clean"] and f["after_clean"] == f["id_null"] + f["dedup_skipped"] + f["new_urls"]


def test_company_links(spark):
    html = 'x href="/company/acme/?a=1" href="https://kr.linkedin.com/compay/acme" href="/company/caf%C3%A9/" href="/jobs/1"'
    got = rows(L.company_links(spark.createDataFrame([(html,)], "html string")), "company_id", "url")
    assert got == [("acme", "https://www.linkedin.com/company/acme"), ("café", "https://www.linkedin.com/company/café")]


# --- tables -----------------------------------------------------------------------------------------------

def test_upsert_keeps_keys_unique(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    u = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z"), (3, "D", "Q")], "id int, v string, w string")
    out = UP.upsert(t, UP.latest_by_key(u, ["id"], ["v"]), ["id"], ["v"], ["w"])
    assert rows(out, "id", "v", "w") == [(1, "a", "x"), (2, "B", "y"), (3, "D", "Q")]
    assert UP.upsert(out, UP.latest_by_key(u, ["id"], ["v"]), ["id"], ["v"], ["w"]).exceptAll(out).count() == 0
    assert A.key_violations(out, ["id"]).count() == 0


def test_work_selection_treats_missing_status_as_open(spark):
    fr = spark.createDataFrame([("1", "u1", None), ("2", "u2", "failed"), ("3", "u3", "new"), ("4", "u4", "new"), ("5", None, "new")],
                               "id string, url string, status string")
    done, queued = spark.createDataFrame([("3",)], "id string"), spark.createDataFrame([("u4",)], "url string")
    ids = lambda **k: [r[0] for r in rows(FR.select_work(fr, done, queued, **k), "id")]
    assert ids() == ["1"] and ids(overwrite=True) == ["1", "3", "4"] and ids(error_reset=True) == ["2"]


def test_frontier_upsert(spark):
    fr = spark.createDataFrame([("1", "u", "old", "failed", True, 0)], "id string, url string, title string, status string, pushed boolean, updated_at int")
    items = spark.createDataFrame([("1", "u", "new", 5), ("2", "u", "n2", 5), ("3", "u", "n3", 5)], "id string, url string, title string, updated_at int")
    done = spark.createDataFrame([("3",)], "id string")
    out = FR.upsert_frontier(fr, items, done)
    assert rows(out, "id", "status", "pushed") == [("1", "new", True), ("2", "new", False), ("3", "completed", True)]
    assert rows(FR.newly_queued(out), "id") == [("2",)]
    assert rows(FR.upsert_frontier(fr, items, done, overwrite=True), "id", "status", "pushed") == [("1", "new", False), ("2", "new", False), ("3", "new", False)]


def test_admission_reasons(spark):
    t = spark.createDataFrame([("https://d.com/a?ref=1",), ("x",), ("https://e.com/a",), ("https://d.com/login",), ("https://d.com/",)], "url string")
    got = {r["url"]: r["reject_reason"] for r in FR.admission(t, F.lit("d.com"), SiteSpec("x", "x", lambda u: F.regexp_extract(u, "/(a)$", 1), exclude=["login"])).collect()}
    assert got == {"https://d.com/a": None, "x": "invalid", "https://e.com/a": "domain", "https://d.com/login": "exclude", "https://d.com/": "no_id"}


def test_repairs(spark):
    u = spark.createDataFrame([("한1", "https://d.com/1234567한글", None, "done"), ("한2", "https://d.com/1234567%20", "t", "done"),
                               ("9", "https://d.com/9", "k", "done"), ("%x", "https://d.com/9%20", "k", "done"), ("한3", None, "keep", "done")],
                              "id string, url string, title string, status string")
    out = A.repair_noise_ids(u, U.job_id)
    assert rows(out, "id", "title", "status") == [("1234567", "Recovered Clean Target", "new"), ("9", "k", "done"), ("한3", "keep", "done")]
    m = spark.createDataFrame([(1, "a", "ua"), (2, "x", "ua"), (3, "y", "ub"), (4, "z", "ub"), (5, "q", None)], "n int, id string, url string")
    got = A.migrate_ids(m, F.substring("url", 2, 1), "n")
    assert rows(got, "n", "outcome") == [(1, "ok"), (2, "duplicate"), (3, "migrated"), (4, "duplicate"), (5, "skipped")]


def test_purge_of_queue_items(spark):
    q = spark.createDataFrame([('{"site":"d","url":"https://bad"}',), ('{"site":"e","url":"https://bad"}',), ("broken bad",), ('{"site":"d"}',)], "p string")
    out = A.split_by_pattern(q, A.queue_item_url("p", "d"), "bad")
    assert [r["removed"] for r in out.collect()] == [True, False, True, False]


# --- logs, stats --------------------------------------------------------------------------------------------

def test_log_lines(spark):
    lines = ['{"level":"debug","msg":"x"}', '{"level":"warn","msg":"\\u001b[31mm","error_name":"E","stack":"s"}', "{bad}", "  at foo()",
             "[fetcher] stderr boom", "[geeknews] just info", "", '{"timestamp":"t"}']
    df = spark.createDataFrame([("w", i, x) for i, x in enumerate(lines)], "service string, idx int, line string")
    got = {r["idx"]: (r["level"], r["site"], r["message"], r["stack"]) for r in LG.parse_logs(df, "now", reserved=["Fetcher"]).collect()}
    assert got == {1: ("WARN", "Unknown", "E: m", "s"), 2: ("INFO", "Unknown", "{bad}", None), 4: ("ERROR", "Unknown", "[fetcher] stderr boom", None),
                   5: ("INFO", "geeknews", "[geeknews] just info", None), 7: ("INFO", "Unknown", "No message", None)}


def test_error_summary(spark):
    lines = ['w | {"level":"ERROR","error_name":"E","message":"m on attempt 1"}', 'w | {"level":"ERROR","error_name":"E","message":"m on attempt 2"}',
             'v | {"level":"ERROR" broken', "v | at x (y)", "v | TSError z", "no pipe Error:", "v | fine"]
    got = {(r["kind"], r["value"]): r["n"] for r in LG.error_summary(spark.createDataFrame([(x,) for x in lines], "line string")).collect()}
    assert got == {("pattern", "E: m"): 2, ("pattern", "Stack Trace Line"): 1, ("pattern", "TSError z"): 1, ("service", "w"): 2, ("service", "v"): 2, ("total", ""): 5}


def test_kst_days_are_inclusive(spark):
    df = spark.createDataFrame([("a", "2024-01-01 14:59:59"), ("a", "2024-01-01 15:00:00"), ("a", "2024-01-02 14:59:59.999")], "site string, t string")
    out = ST.daily_counts(df.select("site", F.col("t").cast("timestamp").alias("ts")), "2024-01-02", "2024-01-02", "ts")
    assert [(str(d), n) for d, n in rows(out, "day", "n")] == [("2024-01-02", 2)]


# --- books, images -----------------------------------------------------------------------------------------

def test_parts_and_equal_pages(spark):
    toc = spark.createDataFrame([("b", 1, 1, "Cover", 1), ("b", 2, 1, "Part II. Deep", 5), ("b", 3, 2, "One", 5), ("b", 4, 2, "Index", 9),
                                 ("b", 5, 1, "Part empty", 20), ("b", 6, 1, "Last", 20)], "book string, ord bigint, level int, title string, page bigint")
    total = spark.createDataFrame([("b", 30)], "book string, pages bigint")
    got = rows(B.part_chapters(toc, total), "title", "start_page", "end_page", "include")
    assert got == [("Cover", 1, 5, False), ("Last", 20, 30, True), ("Part II - Index", 9, 20, False), ("Part II - One", 5, 9, True), ("Part empty", 20, 30, True)]
    assert rows(B.chapter_ranges(toc, total), "ord", "end_page") == [(1, 5), (2, 20), (5, 20), (6, 30)]


def test_upper_median(spark):
    s = spark.createDataFrame([("b", 1, x) for x in (1.0, 2.0, 3.0, 4.0)] + [("b", 2, x) for x in (1.0, 2.0, 3.0)], "book string, page int, size double")
    assert rows(B.page_medians(s), "page", "median_size") == [(1, 3.0), (2, 2.0)]


def test_images(spark):
    d = spark.createDataFrame([(1, "![a](https://x/a.png) ![a](https://x/a.png)")], "id int, md string")
    m = spark.createDataFrame([(1, "https://x/a.png", "/p/a.png"), (1, "k", "k")], "id int, src string, path string")
    out = IM.rewrite_images(d, "id", "md", m).collect()[0]
    assert out["md"] == "![a](/p/a.png) ![a](/p/a.png)" and out["footer"].endswith("- `https://x/a.png` -> `/p/a.png`\n")


# --- search -------------------------------------------------------------------------------------------------

def _index(spark):
    docs = spark.createDataFrame([
        ("1", "s", "spark engine guide", "kr", "fast data", "2024-01-01"), ("2", "s", "guide to the spark", "us", "engine", "2024-01-03"),
        ("3", "t", "sparkling water", "kr", "no engine here", "2024-01-02"), ("4", "t", "spork engine", "us", "x", "2024-01-04")],
        "doc_id string, site string, title string, geo string, content string, published_at string")
    posts = SE.postings(docs)
    return docs, posts, SE.vocabulary(posts)


def _ids(df):
    return [r["doc_id"] for r in df.collect()]


def test_ranking_order(spark):
    d, p, v = _index(spark)
    assert _ids(SE.search(d, p, v, "spark engine")) == ["1", "2", "3", "4"]
    assert set(_ids(SE.search(d, p, v, "spark engine", typos=False))) == {"1", "2", "3"}
    assert _ids(SE.search(d, p, v, "")) == ["4", "2", "3", "1"] and _ids(SE.search(d, p, v, "", limit=2, offset=1)) == ["2", "3"]
    assert _ids(SE.search(d, p, v, "engine", filters={"geo": "us"})) == ["4", "2"]
    assert SE.total_hits(d, p, v, "engine").collect()[0]["total"] == 4


def test_undeclared_fields_are_refused(spark):
    d, p, v = _index(spark)
    with pytest.raises(ValueError):
        SE.search(d, p, v, "x", filters={"title": "a"})
    with pytest.raises(ValueError):
        SE.search(d, p, v, "x", sort="title")


def test_postings_partitions_follow_the_bytes(spark, monkeypatch):
    """A task counts the words of a bounded number of bytes, and rows of one document still meet."""
    from corpusflow.operators import search as SE
    docs = spark.createDataFrame([(i // 2, f"w{i} the") for i in range(400)], "doc_id int, content string")
    monkeypatch.setattr(SE, "POSTINGS_BYTES", 100)
    posts = SE.postings(docs)
    assert "hashpartitioning(doc_id" in posts._jdf.queryExecution().executedPlan().toString()
    assert posts.rdd.getNumPartitions() == sum(len(f"w{i} the") for i in range(400)) // 100 + 1
    assert posts.where("term = 'the' AND tf = 2").count() == 200 and posts.count() == 600


def test_search_moves_only_asked_postings(spark):
    """Terms that answer no word are left out before the join with the vocabulary."""
    from corpusflow.operators import search as SE
    posts = spark.createDataFrame([("the", 1, 4, 1, 0), ("then", 2, 4, 1, 0), ("other", 1, 4, 1, 1)], "term string, doc_id int, field int, tf int, first_pos int")
    hits = SE.match_documents(posts, SE.vocabulary(posts), "the")
    assert "StartsWith(term" in hits._jdf.queryExecution().optimizedPlan().toString().split("Join")[1].replace("startswith(", "StartsWith(")
    assert {r["doc_id"] for r in hits.collect()} == {1, 2}


def _unsplit(spark, fn):
    """Row counts of the tasks of what ``fn`` gives, with no help from run-time splits or broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return [r["count"] for r in fn().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_term_of_all_documents_meets_its_word_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(SE, "TERM_ROWS", 100)
    words = [(w, i, 4, 1, 0) for i in range(4000) for w in ("the", f"the{i}")] + [("other", 1, 4, 1, 1), ("the", None, 4, 1, 0), (None, 1, 4, 1, 0)]
    posts = spark.createDataFrame(words, "term string, doc_id int, field int, tf int, first_pos int")
    terms = SE.expand_query(SE.vocabulary(posts), ["the"], False)
    plan = SE.with_terms(posts, terms)._jdf.queryExecution().executedPlan().toString()
    assert all("_part" in x for x in plan.split("hashpartitioning(term")[1:3])
    each = _unsplit(spark, lambda: SE.with_terms(posts, terms))
    assert sum(each) == 8001 and max(each) < 400
    got = SE.match_documents(posts, SE.vocabulary(posts), "the")
    assert got.where("words = 1 AND exact = 1 AND best_field = 4").count() == 4001 == got.count()


def test_issues_meet_their_topics_in_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(FR, "ITEM_ROWS", 100)
    issues = spark.createDataFrame([(f"i{k}",) for k in range(500)] + [("i1",), (None,)], "issue_id string")
    topics = spark.createDataFrame([(f"i{k % 600}", f"t{k % 900}") for k in range(4000)] + [("i1", None), (None, "t1")], "issue_id string, topic_id string")
    done = spark.createDataFrame([("i3",), ("t5",), ("t5",)], "id string")
    out = FR.expand_issues(issues, topics, done)
    plan, parts = out._jdf.queryExecution().executedPlan().toString(), (502 + 4002) // 100 + 1
    assert plan.count(f", {parts}), ") >= 5
    want = {(f"i{k % 600}", f"t{k % 900}") for k in range(4000) if k % 600 < 500 and k % 600 != 3 and k % 900 != 5}
    want |= {(f"i{k}", f"i{k}") for k in range(500) if k != 3} | {("i1", None), (None, None)}
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
