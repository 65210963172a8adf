"""Queries over nested captures: JSON records with fallbacks, comment trees, sitemaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.base import first_filled
from ..functions.jsonx import unescape
from ..operators import comments as CM
from ..sources import sitemaps as SM
from . import conversion as CV
from . import texts as TX
from .registry import query
from .texts import S, C


@query("variant_post", CV.POST_SQL)
def variant_post(t):
    """Posts with fallback paths, doubly encoded summaries and key-value lists, each parsed once."""
    rows = CV.post_payloads(t).select("doc_id", V.parsed("raw_json").alias("v"))
    field = F.element_at(V.pairs("v", "$.fields"), "content")
    return rows.select("doc_id", V.text_at("v", "$.title").alias("title"), F.coalesce(V.text_at("v", "$.author.name", "$.createdBy.member.name"), F.lit("Unknown")).alias("author"),
                       unescape(first_filled(V.text_at("v", "$.shortContent"), field)).alias("summary"), F.coalesce(V.value_at("v", "$.reactionsCount", "int"), F.lit(0)).alias("reactions_count"),
                       F.substring(V.text_at("v", "$.createdAt"), 1, 10).alias("published"),
                       S("https://www.gpters.org/news/post/", V.text_at("v", "$.slug"), "-", C("doc_id")).alias("url"))


@query("variant_record", TX.TOLERANT_SQL)
def variant_record(t):
    """Queue items as typed records, a broken one as the default record."""
    rows = TX.queue_payloads(t).select("event_id", "p", V.parsed("p").alias("v"))
    task = V.record("v", {"site": "string", "url": "string", "attempt": "int"}, site=F.lit("Unknown"), url=F.col("p"), attempt=F.lit(1))
    return rows.select("event_id", task.alias("r")).select("event_id", "r.*")


@query("variant_items", """
SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 2 ELSE 1 END AS n, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS first FROM events""")
def variant_items(t):
    """One object, a list, or nothing, as lists."""
    kind = F.col("event_type")
    v = F.when(kind == "view", S('[{"k":1}, ', F.col("props"), "]")).when(kind != "error", F.col("props"))
    rows = t.events.select("event_id", V.parsed(v).alias("v"))
    a = V.items("v")
    return rows.select("event_id", F.size(a).alias("n"), V.value_at(F.get(a, F.lit(0)), "$.k", "bigint").alias("first"))


@query("comment_rows", """
WITH c AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS depth FROM conversations)
SELECT conv_id, depth, repeat('0.', CAST(depth AS INTEGER)) AS path, CAST(turn AS VARCHAR) AS comment_id, text AS content FROM c WHERE text <> ''""")
def comment_rows(t):
    """Each turn is the reply to the turn before: nested comment objects as rows."""
    rows = CM.comment_rows(CV.comment_trees(t), "conv_id", "tree")
    return rows.select("conv_id", "depth", F.concat(F.array_join("path", "."), F.lit(".")).alias("path"), "comment_id", "content")


@query("sitemap_index", """
WITH f AS (SELECT page_id, url, page_id % 7 AS m FROM pages)
SELECT 'https://maps.test/' || m || '.xml' AS sitemap, url AS loc, CASE WHEN page_id % 2 = 0 THEN '2024-01-02' END AS lastmod, CAST(NULL AS VARCHAR) AS error FROM f WHERE m < 5
UNION ALL SELECT 'https://maps.test/5.xml', NULL, NULL, 'not well-formed' UNION ALL SELECT 'https://maps.test/lost.xml', NULL, NULL, 'not captured'""")
def sitemap_index(t):
    """Pages listed by sitemaps that an index and an index of the index name; one is broken, one missing, one named by none."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    at = lambda m: S("https://maps.test/", m, ".xml")
    entry = S("<url><loc> ", esc(F.col("url")), " </loc>", F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-01-02</lastmod>").otherwise(""), "</url>")
    per = t.pages.groupBy((F.col("page_id") % 7).alias("m")).agg(F.array_join(F.collect_list(entry), "").alias("body"))
    maps = per.select(at(F.col("m").cast("string")).alias("url"), F.when(F.col("m") == 5, S("<urlset><url><loc>", F.substring("body", 1, 20))).otherwise(
        S('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', F.col("body"), "</urlset>")).alias("xml"))

    def index(name, *members):
        body = "".join(f"<sitemap><loc>https://maps.test/{m}.xml</loc></sitemap>" for m in members)
        return t.spark.range(1).select(F.lit(f"https://maps.test/{name}.xml").alias("url"), F.lit(f"<sitemapindex>{body}</sitemapindex>").alias("xml"))
    files = maps.union(index("root", "0", "1", "second", "root")).union(index("second", "2", "3", "4", "5", "lost", "root"))
    return SM.sitemap_entries(files, t.spark.range(1).select(F.lit("https://maps.test/root.xml").alias("url")))
