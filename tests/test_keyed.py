"""Schedules, alias tables, bucketed tables, sketches and counts against plain versions and plan rules."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import geo as G
from corpusflow.operators import places as PL
from corpusflow.operators import search as SE
from corpusflow.operators import sketches as SK
from corpusflow.operators import stats as ST
from corpusflow.operators.upsert import upsert
from corpusflow.sources import buckets as BK
from corpusflow.sources import ingest as IN


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- schedule ----

def brute_schedule(rows, slack):
    out, last = {}, {}
    for site, t, tie in sorted((r for r in rows if r[0] and r[1]), key=lambda r: (r[0], r[1], r[2])):
        at = t if site not in last else max(t, last[site] + dt.timedelta(seconds=slack.get(site) or 0))
        out[tie], last[site] = at, at
    return out


def test_schedule_of_a_hot_site_equals_the_step_by_step_rule(spark):
    rng, start = random.Random(2), dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(seconds=rng.randrange(90_000), microseconds=rng.randrange(10**6))
    rows = [("hot", at(), i) for i in range(900)] + [(rng.choice(["a", "b", "none"]), at(), 1000 + i) for i in range(300)]
    rows += [("a", start, 2000 + i) for i in range(20)] + [(None, start, 3000), ("a", None, 3001)]
    slack = {"hot": 120, "a": 3, "b": 0.5 and 1}
    rate = F.when(F.col("site") == "hot", 120).when(F.col("site") == "a", 3).when(F.col("site") == "b", 1)
    out = ST.rate_schedule(spark.createDataFrame(rows, "site string, ts timestamp, n int"), "site", "ts", "n", rate)
    want = brute_schedule(rows, slack)
    assert {r["n"]: r["allowed_at"] for r in out.collect()} == want
    assert all(abs(r["wait_s"] - (want[r["n"]] - r["ts"]).total_seconds()) < 1e-6 for r in out.collect())
    # The hot site is spread: a window partition is one hour of it.
    assert "_bucket" in plan(out).split("Window")[-1]


# ---- aliases ----

def test_alias_join_equals_the_column_rule(spark):
    texts = ["Berlin, Germany", "moscow, russia", "USA", "us", "Kyiv / Ukraine", "  Seoul ", "전라도", "", None, "No info", "zürich", "DUBAI", "x", "East Asia", "a.b*c", "Cape  Town", "Türkiye"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "id int, loc string").withColumn("country", F.lit("old"))
    for mode in ("substring", "word"):
        got = PL.standardize_locations(df, "loc", PL.alias_rows(spark, G.COUNTRY_ALIASES), mode=mode)
        assert got.columns == ["id", "loc", "country"]
        want = df.drop("country").withColumn("country", G.standardize_location("loc", mode=mode))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_ten_thousand_aliases_without_a_nested_loop(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 4, 6, 7])))
    aliases = [(f"C{i}", [word() + (" " + word() if i % 3 == 0 else "") for _ in range(10)]) for i in range(1000)]
    table = PL.alias_rows(spark, aliases)
    texts = [" ".join(word() for _ in range(3)).title() for _ in range(150)] + ["same place"] * 200
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, loc string")
    out = PL.standardize_locations(df, "loc", table)
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out) and "ArrowEval" not in plan(out)
    first = {}
    for t in set(texts):
        first[t] = next((c for c, names in aliases if any(n and n.lower() in t.lower() for n in names)), t)
    assert {r["id"]: r["country"] for r in out.collect()} == {i: first[t] for i, t in enumerate(texts)}


def test_no_aliases_and_no_rows(spark):
    none = spark.createDataFrame([], "alias string, country string, priority int")
    df = spark.createDataFrame([(1, "Paris"), (2, "서울")], "id int, loc string")
    assert [r["country"] for r in PL.standardize_locations(df, "loc", none).orderBy("id").collect()] == ["Paris", "South Korea"]
    assert PL.standardize_locations(df.limit(0), "loc", PL.alias_rows(spark, G.COUNTRY_ALIASES)).collect() == []


# ---- bucketed index ----

def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "id string, doc_id string, title string")


def test_index_update_leaves_other_buckets_alone(spark, tmp_path):
    path, rows = str(tmp_path / "index"), [(f"s/{i}", f"d{i}", f"word{i % 5} common") for i in range(200)]
    docs = docs_of(spark, rows)
    BK.create_index(docs, SE.postings(docs, fields=["title"]), path, 16)
    before = files(path)
    change = docs_of(spark, [("s/3", "d3b", "fresh"), ("new/1", "n1", "common"), ("s/7", "d7", "")])
    BK.update_index(spark, path, change, SE.postings(change, fields=["title"]))
    after = files(path)
    got = {(r["doc_id"], r["term"]) for r in spark.read.parquet(f"{path}/postings").collect()}
    want = {(d, w) for i, d, t in rows if i not in ("s/3", "s/7") for w in t.split()} | {("d3b", "fresh"), ("n1", "common")}
    assert got == want
    ids = {r["id"]: r["doc_id"] for r in spark.read.parquet(f"{path}/docs").collect()}
    assert len(ids) == 201 and ids["s_3"] == "d3b" and ids["new_1"] == "n1"
    touched = {f"bucket={r['b']}" for r in change.select(F.pmod(F.xxhash64(F.regexp_replace("id", "/", "_")), F.lit(16)).alias("b")).collect()}
    assert 1 <= len(touched) <= 3
    same = {f: m for f, m in before.items() if not any(f"{b}{os.sep}" in f for b in touched)}
    assert same and all(after.get(f) == m for f, m in same.items())
    assert any(f not in after for f in before)


def test_a_bucket_that_loses_all_postings(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = docs_of(spark, [("a", "1", "one two")])
    BK.create_index(docs, SE.postings(docs, fields=["title"]), path, 4)
    bare = docs_of(spark, [("a", "1", "")])
    BK.update_index(spark, path, bare, SE.postings(bare, fields=["title"]))
    assert spark.read.parquet(f"{path}/docs").count() == 1 and spark.read.parquet(f"{path}/postings").count() == 0


# ---- bucketed upsert ----

def way_to(node, name):
    """Names of the plan nodes from the root to the first one of a name."""
    own = node.nodeName()
    if name in node.simpleString(200):
        return [own]
    kids = node.children()
    for i in range(kids.size()):
        below = way_to(kids.apply(i), name)
        if below:
            return [own, *below]
    return []


def test_upsert_does_not_move_the_table(spark, tmp_path):
    target = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("kept"), F.lit("a").alias("once"))
    updates = spark.createDataFrame([(5, "x", "b"), (5, "y", "b"), (9999, "new", "b")], "k long, name string, once string")
    BK.create_keyed(target, "keyed_test", str(tmp_path / "t0"), ["k"], 8)
    table = spark.table("keyed_test")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        way = way_to(BK.merged(table, updates, ["k"], ["name"], ["once"])._jdf.queryExecution().executedPlan(), "FileScan")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert any("SortMergeJoin" in n for n in way) and not any("Exchange" in n for n in way), way
    name = BK.upsert_keyed(spark, "keyed_test", updates, str(tmp_path), ["k"], ["name"], ["once"])
    got = sorted(map(tuple, spark.table(name).collect()))
    want = sorted(map(tuple, upsert(target, updates.where("name <> 'x'"), ["k"], ["name"], ["once"]).collect()))
    assert got == want and (5, "y", 1, "a") in got and len(got) == 2001
    # The next version is bucketed as well and can be updated in turn.
    again = BK.upsert_keyed(spark, name, updates.limit(0), str(tmp_path), ["k"], ["name"])
    assert sorted(map(tuple, spark.table(again).collect())) == want
    for t in ("keyed_test", name, again):
        spark.sql(f"DROP TABLE {t}")


# ---- sketches ----

def test_sketches_are_exact_while_small_and_near_beyond(spark):
    urls = spark.range(60_000).select(F.lit("big").alias("site"), "id", (F.col("id") % 4).alias("day"))
    urls = urls.union(urls.where("id < 500").withColumn("site", F.lit("small"))).union(urls.where("id < 100").withColumn("site", F.lit("small")))
    html = urls.where("id % 3 = 0")
    s = SK.summarize(urls, "urls", "id", "site", "day").union(SK.summarize(html, "html", "id", "site", "day"))
    got = {r["site"]: r for r in SK.funnel(s, ["urls", "html"], [("urls", "html")]).collect()}
    assert (got["small"]["urls"], got["small"]["html"], got["small"]["urls_not_html"]) == (500, 167, 333)
    for c, n in (("urls", 60_000), ("html", 20_000), ("urls_not_html", 40_000)):
        assert abs(got["big"][c] - n) <= 4 * 60_000 / (1 << (SK.LG // 2))
    # Summaries of parts merge to what one summary of all rows says.
    whole = SK.summarize(urls.withColumn("day", F.lit(0)), "urls", "id", "site", "day")
    assert {r["site"]: r["urls"] for r in SK.funnel(whole, ["urls"]).collect()} == {k: v["urls"] for k, v in got.items()}
    assert SK.funnel(s.limit(0), ["urls"]).collect() == []


# ---- counts of the same pass ----

def test_ingest_reads_its_source_once_and_counts_a_replay_once(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "src"))
    source, path = spark.read.parquet(str(tmp_path / "src")), str(tmp_path / "out")
    keep = lambda rows: rows.where("id % 4 = 0")
    rows, _ = IN.counted(source, "x1")
    both, _ = IN.counted(keep(rows), "x2")
    assert plan(both).count("FileScan") == 1
    for batch in (0, 1, 1):
        IN.ingest(source, keep, path, batch)
    got = IN.ingest_counts(spark, path).first()
    assert (got["original"], got["new"]) == (200, 50) and spark.read.parquet(f"{path}/log").count() == 50
    IN.ingest(source.limit(0), keep, path, 2)
    assert tuple(IN.ingest_counts(spark, path).first()) == (200, 50)
