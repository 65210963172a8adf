"""Values that must not end a job, and rows that must not be lost."""

from pyspark.sql import functions as F

from corpusflow.functions import dates as D, jsonx as J, text as T
from corpusflow.operators import audit as A, books as B, links as L, lookup as LK
from corpusflow.streaming import streams as S


def test_numbers_too_long_are_no_numbers(ev, spark):
    assert ev(D.days_ago, "99999999999 days ago") is None and ev(D.days_ago, "3 weeks ago") == 21
    assert ev(lambda c: D.published_fallback(F.lit("2024-05-05"), c), "2024.01.02x").isoformat()[:10] == "2024-05-05"
    files = spark.createDataFrame([("b", "20240102030405 x.md"), ("b", "7 y.md")], "book string, file string")
    assert [r["chapter_index"] for r in B.chapter_records(files, "book", "file").orderBy("file").collect()] == [0, 7]


def test_pairs_without_a_key(spark):
    df = spark.createDataFrame([([(None, "x"), ("a", "1"), ("a", "2")],)], "p array<struct<key:string,value:string>>")
    assert df.select(J.pairs_to_map("p").alias("m")).first()["m"] == {"a": "2"}


def test_long_digit_runs_sort_by_value(ev):
    a, b = "v" + "9" * 24, "v1" + "0" * 24
    assert ev(T.natural_key, a) < ev(T.natural_key, b) and ev(T.natural_key, "v007") == ev(T.natural_key, "v7")


def test_anchor_attributes(spark):
    html = '<a data-href="no" href="z">1</a><a title="a>b" href=\'y\'>2</a><a href=x>3</a><a name="href=q">4</a><abbr href="w">5</abbr>' + '<a class="' + "c " * 5000 + '" href="v">6</a>'
    got = L.anchors(spark.createDataFrame([(1, html)], "id int, html string"))
    assert [r["href"] for r in got.orderBy("pos").collect()] == ["z", "y", "x", "v"]


def test_rows_without_a_title_are_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "t")], "id int, title string")
    assert sorted((r["id"], r["group_size"]) for r in A.duplicate_groups(df, "title").collect()) == [(1, 2), (2, 2)]


def test_find_returns_all_rows_unless_asked(spark):
    df = spark.range(300)
    assert LK.find(df, [F.col("id") >= 100]).count() == 200 and LK.find(df, [], limit=120).count() == 120


def test_one_version_of_a_document_in_a_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("d", "old words", "2024-01-01"), ("d", "new text", "2024-01-05")], "id string, t string, at string").selectExpr(
        "id", "'s' AS site", "'u' AS url", "'n' AS title", "t AS content", "t AS summary", "'a' AS author", "array('c') AS categories", "array('g') AS tags",
        "CAST(at AS timestamp) AS published_at", "CAST(at AS timestamp) AS updated_at").write.parquet(src)
    rows = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    try:
        S.index_stream(rows, out, F.lit("2024-02-01").cast("timestamp")).awaitTermination()
    except Exception as e:                                  # a field the index wants and this row lacks
        raise AssertionError(str(e)[:300]) from e
    terms = {r["term"] for r in S.current_postings(spark, out).collect()}
    assert "text" in terms and "old" not in terms
