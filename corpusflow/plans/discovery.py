"""Link discovery, frontier and table-maintenance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import url as U
from ..operators import frontier as FR
from ..operators import links as L
from ..operators import upsert as UP
from ..operators.scan import ordinal_bucket
from ..session import cut_lineage
from ..sites import SiteSpec
from . import sqlparts as Q
from .registry import query

PAGES_SITE = SiteSpec("pages", "Test pages", U.job_id, exclude=["favicon", "login", "logout", "signup"])


def page_links(t):
    """Anchors of all pages with their outcome against the host of the page."""
    rows = L.anchors(t.spread("pages").select("page_id", F.col("url").alias("page_url"), "html"))
    return L.link_outcomes(rows, U.host_of("page_url"), PAGES_SITE)


def known(t, links):
    """Frontier, queue and completed ids of the pages table: ids of the page addresses, plus every
    id linked from feed captures (addresses with a campaign tag)."""
    from_pages = t.pages.select(U.job_id("url"))
    linked = links.where((F.col("outcome") == "ok") & F.contains("page_url", F.lit("utm_source"))).select("dst_id")
    return L.known_ids(from_pages, linked)


_KNOWN = f"""known AS (SELECT {Q.job_id('url')} AS dst_id FROM pages
  UNION SELECT dst_id FROM links WHERE outcome = 'ok' AND contains(page_url, 'utm_source'))"""


@query("anchors", f"WITH {Q.ANCHORS} SELECT page_id, pos, href FROM anchors")
def anchors(t):
    return L.anchors(t.spread("pages", "page_id", "html"))


@query("link_outcomes", f"WITH {Q.LINKS} SELECT page_id, pos, href, url, dst_id, outcome FROM links")
def link_outcomes(t):
    return page_links(t).select("page_id", "pos", "href", "url", "dst_id", "outcome")


@query("discover_new", f"""
WITH {Q.LINKS}, {_KNOWN}
SELECT dst_id, arg_min(url, (page_id, pos)) AS url FROM links WHERE outcome = 'ok'
  AND dst_id NOT IN (SELECT dst_id FROM known WHERE dst_id IS NOT NULL) GROUP BY dst_id""")
def discover_new(t):
    # Read twice, for the known ids as well: the outcomes are worked out once and stored.
    links = cut_lineage(page_links(t), "links")
    return L.discover_new(links, known(t, links), ["page_id", "pos"])


@query("link_funnel", f"""
WITH {Q.LINKS}, {_KNOWN},
 f AS (SELECT *, outcome = 'ok' AND dst_id NOT IN (SELECT dst_id FROM known WHERE dst_id IS NOT NULL) AS fresh FROM links)
SELECT count(*) FILTER (outcome <> 'empty') AS total_anchors, count(*) FILTER (outcome = 'malformed') AS malformed_skipped,
 count(*) FILTER (outcome = 'excluded') AS exclude_skipped, count(*) FILTER (outcome = 'protocol') AS protocol_skipped,
 count(*) FILTER (outcome = 'domain') AS domain_skipped, count(*) FILTER (outcome IN ('binary','filtered','id_null','ok')) AS domain_matched,
 0 AS share_extracted, count(*) FILTER (outcome = 'binary') AS binary_skipped,
 count(*) FILTER (outcome IN ('id_null','ok')) AS after_clean, count(*) FILTER (outcome = 'id_null') AS id_null,
 count(*) FILTER (outcome = 'ok') - count(DISTINCT dst_id) FILTER (fresh) AS dedup_skipped,
 count(DISTINCT dst_id) FILTER (fresh) AS new_urls FROM f""")
def link_funnel(t):
    links = cut_lineage(page_links(t), "links")
    return L.link_funnel(links, known(t, links))


@query("first_seen", f"""
WITH {Q.LINKS} SELECT dst_id, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos, arg_min(url, (page_id, pos)) AS url
FROM links WHERE outcome = 'ok' GROUP BY dst_id""")
def first_seen(t):
    rows = page_links(t).where("outcome = 'ok'").select("dst_id", "page_id", "pos", "url")
    return L.first_by_id(rows, ["page_id", "pos"]).select("dst_id", "page_id", "pos", "url")


@query("company_links", r"""
WITH m AS (SELECT '<a href="' || CASE WHEN url LIKE 'http:%' THEN '/compay/' ELSE 'https://kr.linkedin.com/company/' END
              || regexp_extract(url, '([a-z-]+)\.example', 1) || '/?trk=1">' AS html FROM pages),
u AS (SELECT DISTINCT split_part(regexp_replace(split_part(regexp_extract(html, 'href="([^"]*)"', 1), '?', 1), '/$', ''), '/', -1) AS company_id FROM m)
SELECT company_id, 'https://www.linkedin.com/company/' || company_id AS url FROM u WHERE company_id <> ''""")
def company_links(t):
    """Company links planted into every page, both spellings."""
    lead = F.when(F.startswith("url", F.lit("http:")), "/compay/").otherwise("https://kr.linkedin.com/company/")
    name = F.regexp_extract("url", r"([a-z-]+)\.example", 1)
    planted = F.concat("html", F.lit(' <a href="'), lead, name, F.lit('/?trk=1">'))
    return L.company_links(t.pages.select(planted.alias("html")))


def order_frontier(t):
    """Orders as frontier rows: priority decides the status, clerk-less columns stay out."""
    status = (F.when(F.col("o_orderpriority") == "1-URGENT", "failed").when(F.col("o_orderpriority") == "2-HIGH", "failed_permanent")
              .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise("new"))
    return t.orders.select(F.col("o_orderkey").cast("string").alias("id"),
                           F.concat(F.lit("https://s.test/o/"), "o_orderkey").alias("url"), status.alias("status"),
                           "o_orderstatus", "o_totalprice")


_FRONTIER = """fr AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'https://s.test/o/' || o_orderkey AS url,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'failed' WHEN '2-HIGH' THEN 'failed_permanent' WHEN '3-MEDIUM' THEN NULL ELSE 'new' END AS status,
  o_orderstatus, o_totalprice FROM orders),
 done AS (SELECT id FROM fr WHERE o_orderstatus = 'F'), q AS (SELECT url FROM fr WHERE o_totalprice > 400000)"""


@query("select_work", f"""WITH {_FRONTIER}
SELECT 'default' AS mode, id, url FROM fr WHERE (status IS NULL OR status NOT IN ('failed','failed_permanent'))
   AND id NOT IN (SELECT id FROM done) AND url NOT IN (SELECT url FROM q)
UNION ALL SELECT 'overwrite', id, url FROM fr WHERE status IS NULL OR status NOT IN ('failed','failed_permanent')
UNION ALL SELECT 'error_reset', id, url FROM fr WHERE status = 'failed' AND url NOT IN (SELECT url FROM q)""")
def select_work(t):
    """All three selection modes; finished orders are completed, expensive ones queued."""
    fr = order_frontier(t)
    done, queued = fr.where("o_orderstatus = 'F'"), fr.where("o_totalprice > 400000")
    runs = [FR.select_work(fr, done, queued).withColumn("mode", F.lit("default")),
            FR.select_work(fr, done, queued, overwrite=True).withColumn("mode", F.lit("overwrite")),
            FR.select_work(fr, done, queued, error_reset=True).withColumn("mode", F.lit("error_reset"))]
    return runs[0].union(runs[1]).union(runs[2]).select("mode", "id", "url")


UPSERT_SQL = """
WITH u AS (SELECT o_custkey AS c_custkey, 'seen ' || count(*) AS c_name, round(sum(o_totalprice), 2) AS c_acctbal FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
  UNION ALL SELECT s_suppkey + 10000000, s_name, s_acctbal FROM supplier)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, coalesce(u.c_name, c.c_name) AS c_name,
       CASE WHEN c.c_custkey IS NOT NULL THEN c.c_acctbal ELSE u.c_acctbal END AS c_acctbal, c.c_mktsegment
FROM customer c FULL JOIN u ON c.c_custkey = u.c_custkey"""


def upsert_rows(t):
    """Customers as a keyed table and updates to it."""
    seen = (t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.concat(F.lit("seen "), F.count("*")).alias("c_name"), F.round(F.sum("o_totalprice"), 2).alias("c_acctbal")))
    extra = t.supplier.select((F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    return t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), seen.unionByName(extra)


@query("upsert_merge", UPSERT_SQL)
def upsert_merge(t):
    """Names overwritten, balances only set on insert, segments untouched."""
    target, updates = upsert_rows(t)
    return UP.upsert(target, updates, ["c_custkey"], ["c_name"], ["c_acctbal"])


@query("frontier_upsert", """
WITH it AS (SELECT CAST(o_custkey AS VARCHAR) AS id, max(o_orderkey) AS k FROM orders GROUP BY 1),
 done AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_mktsegment = 'BUILDING'),
 fr AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title, 'failed' AS status, true AS pushed FROM customer WHERE c_acctbal > 5000)
SELECT coalesce(fr.id, it.id) AS id, CASE WHEN it.id IS NOT NULL THEN 'order ' || k ELSE fr.title END AS title,
  CASE WHEN it.id IS NULL THEN fr.status WHEN it.id IN (SELECT id FROM done) THEN 'completed' ELSE 'new' END AS status,
  CASE WHEN fr.id IS NOT NULL THEN fr.pushed ELSE it.id IN (SELECT id FROM done) END AS pushed
FROM fr FULL JOIN it ON fr.id = it.id""")
def frontier_upsert(t):
    """Customers with a balance are the frontier, orders the listing items (latest order wins)."""
    fr = t.customer.where("c_acctbal > 5000").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("u").alias("url"), F.col("c_name").alias("title"),
        F.lit("failed").alias("status"), F.lit(True).alias("pushed"), F.lit(0).cast("bigint").alias("updated_at"))
    items = t.orders.select(F.col("o_custkey").cast("string").alias("id"), F.lit("u").alias("url"),
                            F.concat(F.lit("order "), "o_orderkey").alias("title"), F.col("o_orderkey").alias("updated_at"))
    done = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id"))
    return FR.upsert_frontier(fr, items, done).select("id", "title", "status", "pushed")


@query("seed_urls", """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS title FROM supplier),
 fr AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title, 'completed' AS status FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o, coalesce(fr.id, s.id) AS id, coalesce(fr.title, s.title) AS title,
  CASE WHEN fr.id IS NULL OR (o AND s.id IS NOT NULL) THEN 'new' ELSE fr.status END AS status
FROM (fr FULL JOIN s ON fr.id = s.id), (VALUES (false), (true)) v(o)""")
def seed_urls(t):
    """Suppliers seed a frontier of customers, with and without the reset mode."""
    fr = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("u").alias("url"), F.col("c_name").alias("title"),
        F.lit("completed").alias("status"), F.lit(True).alias("pushed"), F.lit(0).alias("updated_at"))
    seeds = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.lit("s").alias("url"),
                              F.col("s_name").alias("title"), F.lit(1).alias("updated_at"))
    each = [FR.seed_frontier(fr, seeds, o).select(F.lit(o).alias("o"), "id", "title", "status") for o in (False, True)]
    return each[0].union(each[1])


@query("completed_ids", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders UNION SELECT DISTINCT regexp_extract(url, '([^/]*)$', 1) FROM pages
WHERE regexp_matches(regexp_extract(url, '([^/]*)$', 1), '^[0-9]+$')""")
def completed_ids(t):
    a = FR.completed_ids(t.orders, "o_custkey")
    b = FR.completed_ids(t.pages.select(F.regexp_extract("url", r"([^/]*)\z", 1).alias("id")), numeric_only=True)
    return a.union(b).distinct()


@query("geo_target_filter", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'https://c.test/' || c_custkey AS url FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING' AND n_name IN ('NATION_1', 'NATION_2', 'NATION_3') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def geo_target_filter(t):
    items = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("https://c.test/"), "c_custkey").alias("url"),
        F.col("n_name").alias("geo"), F.when(F.col("c_mktsegment") == "BUILDING", "DIRECT").otherwise("LIST").alias("source")))
    done = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("id"))
    return FR.geo_targets(items, done, ["NATION_1", "NATION_2", "NATION_3"])


@query("admission", f"""
WITH c AS (SELECT page_id, {Q.strip_tracking('url')} AS url FROM pages UNION ALL SELECT page_id, 'not a url ' || page_id FROM pages),
 e AS (SELECT *, {Q.host('url')} AS h, {Q.job_id('url')} AS id FROM c)
SELECT page_id, url, id, CASE WHEN h IS NULL THEN 'invalid' WHEN NOT {Q.same_domain('h', "'example.com'")} THEN 'domain'
  WHEN NOT regexp_matches(url, '/(en|de)/') THEN 'filter' WHEN contains(url, 'cheap') THEN 'exclude' WHEN coalesce(id, '') = '' THEN 'no_id' END AS reject_reason FROM e""")
def admission(t):
    site = SiteSpec("x", "x", U.job_id, exclude=["cheap"], url_filter=lambda u: u.rlike("/(en|de)/"))
    tasks = t.pages.select("page_id", "url").union(t.pages.select("page_id", F.concat(F.lit("not a url "), "page_id")))
    return FR.admission(tasks, F.lit("example.com"), site).select("page_id", "url", "id", "reject_reason")


@query("convert_backlog", """
SELECT CAST(doc_id AS VARCHAR) AS id, 'missing' AS mode FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'all' FROM documents""")
def convert_backlog(t):
    bronze, silver = t.documents.select(F.col("doc_id").alias("id")), t.labels.select(F.col("doc_id").alias("id"))
    return FR.convert_backlog(bronze, silver).withColumn("mode", F.lit("missing")).union(
        FR.convert_backlog(bronze, silver, overwrite=True).withColumn("mode", F.lit("all")))


@query("reindex_tasks", "SELECT source AS site, CAST(doc_id AS VARCHAR) AS id FROM documents")
def reindex_tasks(t):
    return FR.reindex_tasks(t.documents.select(F.col("source").alias("site"), F.col("doc_id").alias("id")))


@query("listing_exhausted", """
WITH p AS (SELECT l_suppkey AS listing, l_partkey AS page, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS BIGINT) AS items FROM lineitem GROUP BY 1, 2),
 e AS (SELECT listing, min(page) AS stop FROM p WHERE items = 0 GROUP BY 1)
SELECT p.listing, p.page, p.items FROM p LEFT JOIN e USING (listing) WHERE e.stop IS NULL OR p.page < e.stop""")
def listing_exhausted(t):
    """Lineitem relabelled: supplier = listing, part = page, lines not returned = items found."""
    pages = t.lineitem.groupBy(F.col("l_suppkey").alias("listing"), F.col("l_partkey").alias("page")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", 0).otherwise(1)).alias("items"))
    return FR.exhausted_listings(pages, ["listing"], "page", "items", ordinal_bucket("page"))


@query("issue_expand", """
WITH i AS (SELECT 'weekly-' || o_orderkey AS issue_id FROM orders WHERE o_orderstatus <> 'F'),
 tp AS (SELECT DISTINCT 'weekly-' || l_orderkey AS issue_id, CAST(l_partkey AS VARCHAR) AS id FROM lineitem),
 done AS (SELECT CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size < 10 UNION SELECT 'weekly-' || o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'),
 o AS (SELECT issue_id FROM i WHERE issue_id NOT IN (SELECT id FROM done))
SELECT issue_id, id FROM tp WHERE issue_id IN (SELECT issue_id FROM o) AND id NOT IN (SELECT id FROM done)
UNION SELECT issue_id, issue_id FROM o""")
def issue_expand(t):
    """Orders are issues, their parts the topics; small parts and low-priority orders are done."""
    issue = lambda c: F.concat(F.lit("weekly-"), c)
    issues = t.orders.where("o_orderstatus <> 'F'").select(issue("o_orderkey").alias("issue_id"))
    topics = t.lineitem.select(issue("l_orderkey").alias("issue_id"), F.col("l_partkey").cast("string").alias("topic_id"))
    done = t.part.where("p_size < 10").select(F.col("p_partkey").cast("string").alias("id")).union(
        t.orders.where("o_orderpriority = '5-LOW'").select(issue("o_orderkey")))
    return FR.expand_issues(issues, topics, done)


@query("drain_order", """
WITH x AS (SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'none' ELSE 'low' END AS priority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 2 ELSE 1 END AS attempt, o_orderstatus AS site, o_orderdate FROM orders)
SELECT id, CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END AS priority_rank,
  CASE WHEN priority = 'high' AND attempt > 1 THEN 0 ELSE 1 END AS retry_rank, md5(site || 'batch-1') AS site_shuffle FROM x
""")
def drain_order(t):
    """All tasks of a batch with the keys of the drain order."""
    p = F.col("o_orderpriority")
    tasks = t.orders.select(
        F.col("o_orderkey").alias("id"), F.when(p.isin("1-URGENT", "2-HIGH"), "high").when(p == "3-MEDIUM", "medium")
        .when(p == "4-NOT SPECIFIED", "none").otherwise("low").alias("priority"),
        F.when(p == "1-URGENT", 2).otherwise(1).alias("attempt"), F.col("o_orderstatus").alias("site"),
        F.col("o_orderdate").alias("enqueued_at"))
    return FR.drain_order(tasks, "batch-1").select("id", "priority_rank", "retry_rank", "site_shuffle")


@query("index_doc_key", "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS key FROM pages")
def index_doc_key(t):
    return t.pages.select("page_id", UP.index_key(F.col("url")).alias("key"))


@query("date_partition_keys", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y') END AS year,
       CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%m') END AS month FROM orders""")
def date_partition_keys(t):
    return t.orders.select("o_orderkey", *D.date_partition(F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))))
