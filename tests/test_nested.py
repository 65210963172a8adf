"""Variants, comment trees and sitemaps against plain versions and plan rules."""

import json

from pyspark.sql import functions as F

from corpusflow.functions import variant as V
from corpusflow.operators import comments as CM
from corpusflow.operators import extract as X
from corpusflow.sources import sitemaps as SM


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scalars_lists_objects_and_broken_texts(spark):
    texts = ['{"a": {"b": "x"}, "n": 7, "l": [1, {"c": 2}]}', '{"a": {"b": ""}, "alt": "y", "l": 5}', "[1, 2]", '"text"', "null", "{broken", "", None, '{"l": null}', '{"a": 1.50, "n": "12", "l": [], "d": {"k": [1]}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", V.parsed("t").alias("v"))
    out = df.select("i", V.text_at("v", "$.a.b", "$.alt").alias("s"), V.value_at("v", "$.n", "int").alias("n"), F.size(V.items("v", "$.l")).alias("l"), F.size(V.items("v")).alias("top"),
                    V.is_object("v").alias("o"), V.text_at("v", "$.d").alias("d"))
    got = {r["i"]: tuple(r)[1:] for r in out.collect()}
    assert got == {0: ("x", 7, 2, 1, True, None), 1: ("y", None, 1, 1, True, None), 2: (None, None, 0, 2, False, None), 3: (None, None, 0, 1, False, None),
                   4: (None, None, 0, 0, False, None), 5: (None, None, 0, 0, False, None), 6: (None, None, 0, 0, False, None), 7: (None, None, 0, 0, False, None),
                   8: (None, None, 0, 1, True, None), 9: (None, 12, 0, 1, True, '{"k":[1]}')}
    # All fields come from one parse of the text.
    assert plan(out).count("parseJson") == 1


def test_records_and_pairs(spark):
    texts = ['{"site": "s", "n": 3, "extra": 1}', "oops", '{"n": "x"}', "[1]", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", V.parsed("t").alias("v"))
    out = df.select("i", V.record("v", {"site": "string", "n": "int"}, site=F.lit("?"), n=F.lit(1)).alias("r"))
    assert {r["i"]: tuple(r["r"]) for r in out.collect()} == {0: ("s", 3), 1: ("?", 1), 2: (None, None), 3: ("?", 1), 4: ("?", 1)}
    lists = ['{"f": [{"key": "a", "value": "1"}, {"key": "b", "value": null}, {"key": "a", "value": 2}, {"value": "x"}]}', '{"f": {"key": "one", "value": "v"}}', '{"f": 5}', "{}"]
    m = spark.createDataFrame([(t,) for t in lists], "t string").select(V.pairs(V.parsed("t"), "$.f").alias("m"))
    assert [r["m"] for r in m.collect()] == [{"b": None, "a": "2"}, {"one": "v"}, {}, {}]


def chain(depth):
    node = {"text": f"c{depth}", "url": f"http://x?id={depth}"}
    for d in range(depth - 1, 0, -1):
        node = {"text": f"c{d}" if d % 7 else "", "url": f"http://x?id={d}&y=1", "author": {"name": f"a{d}"} if d % 3 else None, "comment": node if d % 2 else [node]}
    return {"comment": [node, {"text": "second"}]}


def test_comment_rows_equal_the_recursive_rule(spark):
    """Sixty levels, wide pages, one object for a list, texts that are missing, malformed and null."""
    docs = [chain(60), {"comment": {"text": "only", "comment": [1, "x", None, {"text": "r"}]}}, {"comment": []}, {}, [1], {"comment": [{"text": f"w{i}", "comment": [{"text": "k"}]} for i in range(300)]}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, "{broken"), (91, None)]
    df = spark.createDataFrame(rows, "page int, j string")
    out = CM.comment_rows(df, "page", "j")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "Arrow" not in out._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["page"], r["path"])):
        assert r["depth"] == len(r["path"])
        got.setdefault(r["page"], []).append((r["comment_id"], r["author"], r["content"]))
    want = {r["page"]: [tuple(c) for c in r["c"]] for r in df.select("page", X.flatten_comments(F.col("j")).alias("c")).collect() if r["c"]}
    assert got == want and max(r["depth"] for r in out.collect()) == 60


def test_a_page_of_a_hundred_thousand_comments(spark):
    page = json.dumps({"comment": [{"text": f"c{i}", "comment": [{"text": "r"}]} for i in range(50_000)]})
    out = CM.comment_rows(spark.createDataFrame([(1, page)], "page int, j string"), "page", "j")
    assert out.count() == 100_000 and CM.comment_rows(spark.createDataFrame([], "page int, j string"), "page", "j").collect() == []


def test_sitemaps_through_indexes(spark):
    """Indexes that name each other, namespaces, one entry, blanks, a broken text, an empty map, one never captured."""
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    files = [("r", f'<?xml version="1.0"?><sitemapindex {ns}><sitemap><loc>a</loc></sitemap><sitemap><loc> b </loc><lastmod>2024</lastmod></sitemap><sitemap><loc>gone</loc></sitemap></sitemapindex>'),
             ("b", "<sitemapindex><sitemap><loc>r</loc></sitemap><sitemap><loc>c</loc></sitemap><sitemap><loc>bad</loc></sitemap><sitemap><loc>none</loc></sitemap></sitemapindex>"),
             ("a", f"<urlset {ns}><url><loc>http://1?x=1&amp;y=2</loc></url></urlset>"), ("c", "<urlset><url><loc>\nhttp://2 </loc><lastmod>2024-05-06</lastmod></url><url><loc></loc></url><url><loc>http://1?x=1&amp;y=2</loc></url></urlset>"),
             ("bad", "<urlset><url><loc>http://3</loc>"), ("none", "<urlset></urlset>"), ("alone", "<urlset><url><loc>http://9</loc></url></urlset>"), ("null", None)]
    df = spark.createDataFrame(files, "url string, xml string")
    roots = spark.createDataFrame([("r",), ("null",), ("r",)], "url string")
    got = sorted(map(tuple, SM.sitemap_entries(df, roots).collect()), key=repr)
    assert got == sorted([("a", "http://1?x=1&y=2", None, None), ("c", "http://2", "2024-05-06", None), ("c", "http://1?x=1&y=2", None, None),
                          ("bad", None, None, "not well-formed"), ("none", None, None, "no entries"), ("gone", None, None, "not captured"), ("null", None, None, "not well-formed")], key=repr)
    shallow = {tuple(r) for r in SM.sitemap_entries(df, roots, depth=1).collect()}
    assert ("c", None, None, "too deep") in shallow and ("a", "http://1?x=1&y=2", None, None) in shallow
    assert SM.sitemap_entries(df, roots.limit(0)).collect() == []
