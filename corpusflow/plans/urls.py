"""URL and identity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import url as U
from ..functions.base import contains_any
from ..operators import generate as G
from ..operators import links as L
from .. import sites as S
from . import sqlparts as Q
from .registry import query


@query("url_strip_tracking", f"""
SELECT page_id, {Q.strip_tracking('url')} AS clean,
       {Q.strip_tracking("(url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'a=1&utm_term=z&a=2&b=3')")} AS clean_more
FROM pages WHERE NOT contains(url, '#')
UNION ALL SELECT page_id, {Q.strip_tracking('url')}, {Q.strip_tracking('url')} FROM pages WHERE contains(url, '#')""")
def url_strip_tracking(t):
    """Tracking parameters out; the second column adds repeated and tracking parameters."""
    url = F.col("url")
    more = F.when(F.contains(url, F.lit("#")), url).otherwise(F.concat(
        url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("a=1&utm_term=z&a=2&b=3")))
    return t.pages.select("page_id", U.strip_tracking("url").alias("clean"), U.strip_tracking(more).alias("clean_more"))


@query("url_is_binary", f"""
WITH {Q.ANCHORS}, u AS (SELECT page_id, pos, 'https://' || {Q.host('page_url')} || href AS url FROM anchors)
SELECT page_id, pos, regexp_matches({Q.path('url')}, '{Q.BINARY}') AS is_binary,
       regexp_matches({Q.path("(url || '.PDF')")}, '{Q.BINARY}') AS is_binary_pdf FROM u""")
def url_is_binary(t):
    rows = L.anchors(t.pages, keep=["page_id", "url"])
    u = F.concat(F.lit("https://"), U.host_of("url"), F.col("href"))
    return rows.withColumn("u", u).select(
        "page_id", "pos", U.is_binary_url("u").alias("is_binary"),
        U.is_binary_url(F.concat("u", F.lit(".PDF"))).alias("is_binary_pdf"))


@query("url_same_domain", f"""
SELECT page_id, {Q.same_domain(Q.host('url'), "'example.com'")} AS own,
       {Q.same_domain("'example.net'", Q.host('url'))} AS parent FROM pages""")
def url_same_domain(t):
    return t.pages.select("page_id", U.same_domain(U.host_of("url"), F.lit("example.com")).alias("own"),
                          U.same_domain(F.lit("example.net"), U.host_of("url")).alias("parent"))


@query("url_share_target", f"""
SELECT page_id, CASE WHEN {Q.same_domain(Q.host('url'), "'example.org'")} THEN url END AS target,
       CAST(NULL AS VARCHAR) AS foreign_target FROM pages""")
def url_share_target(t):
    """Each page address wrapped in a share link, resolved against one domain."""
    wrapped = F.concat(F.lit("https://share.test/s?x=1&u="), F.url_encode("url"))
    foreign = F.concat(F.lit("https://share.test/s?url="), F.url_encode("url"))
    return t.pages.select("page_id", U.shared_target(wrapped, F.lit("example.org")).alias("target"),
                          U.shared_target(foreign, F.lit("other.test")).alias("foreign_target"))


@query("url_resolve", f"""
WITH {Q.LINKS} SELECT page_id, pos, href, full_url AS url FROM l3""")
def url_resolve(t):
    rows = L.anchors(t.pages, keep=["page_id", "url"]).withColumnRenamed("url", "page_url")
    return rows.withColumn("dom", U.host_of("page_url")).select(
        "page_id", "pos", "href", U.resolve_href("href", "dom").alias("url"))


@query("url_exclude", """
SELECT page_id, contains(url, 'cheap-pills') OR contains(url, 'utm_') OR contains(url, '/fr/') AS excluded FROM pages""")
def url_exclude(t):
    return t.pages.select("page_id", contains_any("url", ["cheap-pills", "utm_", "/fr/"]).alias("excluded"))


@query("url_allow", r"""
SELECT page_id, regexp_matches(split_part(url, '?', 1), '^https://blog\.[a-z]+\.example\.(com|net)/[a-z]{2}/[0-9]+$') AS allowed,
       regexp_matches(split_part('https://maily.so/josh/posts/' || regexp_replace(url, '^.*/', ''), '?', 1),
                      '^https://maily\.so/josh/posts/[a-zA-Z0-9]+$') AS is_post FROM pages""")
def url_allow(t):
    post = F.concat(F.lit("https://maily.so/josh/posts/"), F.regexp_replace("url", "^.*/", ""))
    return t.pages.select(
        "page_id", F.substring_index("url", "?", 1).rlike(r"^https://blog\.[a-z]+\.example\.(com|net)/[a-z]{2}/[0-9]+\z").alias("allowed"),
        S.newsletter_post_filter(post).alias("is_post"))


_RULE = f"""CASE WHEN NOT regexp_matches(u, '{Q.HTTP}') THEN false
 WHEN contains(p, 'login') OR contains(p, 'join') OR contains(p, 'signup') OR contains(p, 'favicon') OR contains(p, 'logout')
   OR contains(p, '/category/') OR contains(p, '/tag/') OR contains(p, '/author/') OR contains(p, '/page/')
   OR contains(p, 'download.cm') OR contains(p, 'unsubscribe') THEN false
 WHEN regexp_matches(q, '(^|&)bmode=view(&|$)') THEN true
 WHEN regexp_replace(p, '/$', '') = '' THEN false
 WHEN regexp_matches(p, '^/(newsletter|column-before|economy-dictionary|economy-news|2030-research|serial|moneyletter_archive|careerletter_archive|moneylog|news|notice|uppitag|bamboo_forest|column|partnership)(/|$)') THEN false
 WHEN regexp_matches(regexp_replace(p, '/$', ''), '/\\d+$') THEN false
 WHEN q <> '' THEN false ELSE true END""".replace("\\\\", "\\")


@query("url_rule_filter", f"""
WITH u0 AS (SELECT page_id, 0 AS k, url AS u FROM pages
            UNION ALL SELECT page_id, 1, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'bmode=view' FROM pages WHERE NOT contains(url, '#')
            UNION ALL SELECT page_id, 2, regexp_replace(url, '/[a-z]+/[0-9].*$', '/news/x') FROM pages),
     u1 AS (SELECT *, {Q.path('u')} AS p, {Q.part('u', 5)} AS q FROM u0)
SELECT page_id, k, {_RULE} AS detail FROM u1""")
def url_rule_filter(t):
    """Archive rule tree on page addresses, on board views of them and on archive children."""
    url = F.col("url")
    plain = t.pages.select("page_id", F.lit(0).alias("k"), url.alias("u"))
    board = t.pages.where(~F.contains(url, F.lit("#"))).select("page_id", F.lit(1), F.concat(
        url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("bmode=view")))
    news = t.pages.select("page_id", F.lit(2), F.regexp_replace(url, r"/[a-z]+/[0-9].*\z", "/news/x"))
    return plain.union(board).union(news).select("page_id", "k", S.archive_url_filter(F.col("u")).alias("detail"))


@query("id_cascade", f"""
WITH u AS (SELECT page_id, url AS u FROM pages UNION ALL SELECT page_id, url || '-at-x-' || (page_id + 1000000) FROM pages
           UNION ALL SELECT page_id, split_part(url, '?', 1) || 'v' || (page_id + 10000000) || 'z' FROM pages)
SELECT page_id, u, {Q.job_id('u')} AS id FROM u""")
def id_cascade(t):
    n = lambda base: (F.col("page_id") + base).cast("string")
    u = (t.pages.select("page_id", F.col("url").alias("u"))
         .union(t.pages.select("page_id", F.concat("url", F.lit("-at-x-"), n(1000000))))
         .union(t.pages.select("page_id", F.concat(F.substring_index("url", "?", 1), F.lit("v"), n(10000000), F.lit("z")))))
    return u.select("page_id", "u", U.job_id("u").alias("id"))


@query("id_after_segment", r"""
WITH u AS (SELECT page_id, regexp_replace(url, '/([a-z]{2})/', CASE WHEN lang = 'fr' THEN '/compay/' ELSE '/company/' END) || '%20x' AS u
           FROM (SELECT *, regexp_extract(url, '/([a-z]{2})/', 1) AS lang FROM pages)
           UNION ALL SELECT page_id, url FROM pages),
     s AS (SELECT page_id, u, string_split(split_part(regexp_replace(u, '/$', ''), '?', 1), '/') AS segs FROM u),
     k AS (SELECT *, coalesce(nullif(list_position(segs, 'company'), 0), nullif(list_position(segs, 'compay'), 0)) AS i FROM s)
SELECT page_id, u, url_decode(CASE WHEN i IS NOT NULL AND coalesce(segs[i + 1], '') <> '' THEN segs[i + 1] ELSE segs[-1] END) AS id FROM k""")
def id_after_segment(t):
    lang = F.regexp_extract("url", "/([a-z]{2})/", 1)
    typed = F.when(lang == "fr", F.regexp_replace("url", "/([a-z]{2})/", "/compay/")).otherwise(
        F.regexp_replace("url", "/([a-z]{2})/", "/company/"))
    u = t.pages.select("page_id", F.concat(typed, F.lit("%20x")).alias("u")).union(t.pages.select("page_id", "url"))
    return u.select("page_id", "u", U.company_id("u").alias("id"))


@query("id_regex_rules", r"""
SELECT page_id,
  regexp_extract(regexp_replace(url, '/[a-z]{2}/', '/setup/'), '/setup/(\d+)', 1) AS setup_id,
  coalesce('weekly-' || nullif(regexp_extract(regexp_replace(url, '/[a-z]{2}/', '/weekly/'), '/weekly/(\d+)$', 1), ''),
           regexp_extract(regexp_replace(regexp_replace(url, '/[a-z]{2}/', '/weekly/'), 'page=', 'id='), '[?&]id=(\d+)', 1)) AS topic_id,
  regexp_extract(url, '/(\d+)(?:\?|$)', 1) AS number_id,
  regexp_extract(regexp_replace(url, '/[a-z]{2}/', '/detail/'), '/detail/(\d+)/', 1) AS detail_id,
  CASE WHEN regexp_matches(split_part(url || '-' || substr(md5(url), 1, 15), '-', -1), '^[a-zA-Z0-9]{15}$')
       THEN split_part(url || '-' || substr(md5(url), 1, 15), '-', -1) ELSE '' END AS dash_id,
  split_part(regexp_replace(url, '/$', ''), '/', -1) AS segment_id, substr(md5(url), 1, 10) AS short_id FROM pages""")
def id_regex_rules(t):
    swap = lambda word: F.regexp_replace("url", "/[a-z]{2}/", f"/{word}/")
    return t.pages.select(
        "page_id", S.site("aicasebook").id_rule(swap("setup")).alias("setup_id"),
        U.topic_id(F.regexp_replace(swap("weekly"), "page=", "id=")).alias("topic_id"),
        S.site("pytorch_kr").id_rule(F.col("url")).alias("number_id"),
        S.site("yozm").id_rule(swap("detail")).alias("detail_id"),
        U.dash_tail_id(F.concat("url", F.lit("-"), F.substring(F.md5("url"), 1, 15))).alias("dash_id"),
        U.last_segment("url").alias("segment_id"), U.short_md5("url").alias("short_id"))


@query("id_md5_canonical", f"""
SELECT page_id, md5({Q.canonical('url')}) AS id, md5({Q.canonical('url', True)}) AS id_without_page FROM pages""")
def id_md5_canonical(t):
    return t.pages.select("page_id", U.canonical_md5("url").alias("id"),
                          U.canonical_md5("url", drop_page_number=True).alias("id_without_page"))


@query("id_base64", f"""
SELECT page_id, regexp_replace(to_base64(encode({Q.canonical('url')})), '[^a-zA-Z0-9]', '', 'g') AS id FROM pages""")
def id_base64(t):
    return t.pages.select("page_id", U.canonical_base64("url").alias("id"))


@query("site_key_map", r"""
WITH c AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN 'linkedin.jobs' WHEN lang = 'de' THEN 'silver/linkedin.companies'
                               WHEN lang = 'es' THEN 'silver/geeknews.contents' ELSE 'silver/' || source || '.contents' END AS collection FROM documents),
     s AS (SELECT *, CASE WHEN collection = 'linkedin.jobs' THEN 'linkedin' WHEN collection = 'silver/linkedin.companies'
                     THEN 'linkedin_company' ELSE split_part(regexp_replace(collection, '^(silver|bronze)/', ''), '.', 1) END AS site FROM c)
SELECT doc_id, collection, site, CASE WHEN site = 'linkedin' THEN 'linkedin_jobs' ELSE site END AS index_name FROM s""")
def site_key_map(t):
    c = (F.when(F.col("lang") == "fr", "linkedin.jobs").when(F.col("lang") == "de", "silver/linkedin.companies")
         .when(F.col("lang") == "es", "silver/geeknews.contents")
         .otherwise(F.concat(F.lit("silver/"), "source", F.lit(".contents"))))
    d = t.documents.select("doc_id", c.alias("collection")).withColumn("site", S.site_key_of_collection("collection"))
    return d.withColumn("index_name", S.index_of_site(F.col("site")))


@query("gen_search_urls", r"""
WITH tgt AS (SELECT c_custkey, c_name, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0),
 one AS (SELECT c_custkey, kw, f, s, d, i,
   'https://www.linkedin.com/jobs/search/?keywords=' || replace(kw, ' ', '+') ||
   CASE WHEN n_name = 'NATION_1' THEN '&geoId=101' ELSE '&location=' || n_name END || '&distance=' || d ||
   CASE WHEN f = 'any time' THEN '' ELSE '&f_TPR=' || CASE WHEN f = 'past week' THEN 'r604800' ELSE f END END || '&sortBy=' || s ||
   CASE WHEN i > 0 THEN '&start=' || (i * 25) ELSE '' END AS url
  FROM tgt, unnest([lower(c_mktsegment), 'data ' || lower(c_mktsegment)]) k(kw), unnest(['past week', 'any time']) x(f),
       unnest(['DD', 'R']) y(s), unnest(['10', '25']) z(d), generate_series(0, 1) g(i))
SELECT url, 'search' AS kind, count(*) AS targets FROM one GROUP BY url
UNION ALL SELECT 'https://example.com/' || lower(s_name), 'direct', count(*) FROM supplier GROUP BY 1""")
def gen_search_urls(t):
    """Every paying customer is a search target: segment keywords, nation as location. Direct
    addresses (suppliers) are appended."""
    targets = (t.customer.where("c_acctbal > 0").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.array(F.lower("c_mktsegment"), F.concat(F.lit("data "), F.lower("c_mktsegment"))).alias("keywords"),
                       F.col("n_name").alias("location"), F.lit(None).cast("string").alias("geo_id"),
                       F.lit(True).alias("enabled"), F.lit(None).cast("int").alias("start"),
                       F.lit(None).cast("int").alias("max_page")))
    urls = G.search_urls(
        targets, geo_registry={"NATION_1": "101"}, parameter_registry={"f_TPR": {"past week": "r604800"}},
        settings={"f_TPR": ["past week", "any time"], "sortBy": ["DD", "R"], "distance": ["10", "25"], "max_page": 2})
    direct = t.supplier.select(F.concat(F.lit("https://example.com/"), F.lower("s_name")).alias("url"))
    return (urls.withColumn("kind", F.lit("search")).unionByName(direct.withColumn("kind", F.lit("direct")))
            .groupBy("url", "kind").agg(F.count("*").alias("targets")))


@query("gen_page_urls", r"""
WITH c AS (SELECT o_custkey, count(*) AS pages FROM orders GROUP BY 1), p AS (SELECT o_custkey, unnest(generate_series(1, pages)) AS page FROM c),
u AS (SELECT o_custkey, page, 'uppity' AS site, CASE WHEN page = 1 THEN 'https://uppity.co.kr/economy-news/'
        ELSE 'https://uppity.co.kr/economy-news/page/' || page || '/' END AS url FROM p
 UNION ALL SELECT o_custkey, page, 'pytorch_kr', 'https://discuss.pytorch.kr/latest.json?no_definitions=true&page=' || page FROM p
 UNION ALL SELECT o_custkey, page, 'geeknews', 'https://news.hada.io/' || x FROM p, unnest(['', 'new', 'weekly/page/1', 'plus', 'show']) z(x) WHERE page = 1
 UNION ALL SELECT o_custkey, page, 'geeknews', 'https://news.hada.io/' || x || page FROM p, unnest(['weekly/page/', 'plus?page=', 'show?page=']) z(x) WHERE page > 1
 UNION ALL SELECT o_custkey, page, 'geeknews', 'https://news.hada.io/?page=' || page FROM p WHERE page BETWEEN 2 AND 5)
SELECT o_custkey, page, site, url FROM u""")
def gen_page_urls(t):
    """One listing per customer with as many pages as the customer has orders."""
    pages = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return G.page_urls(pages.select("o_custkey", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("page")),
                       ["uppity", "pytorch_kr", "geeknews"]).select("o_custkey", "page", "site", "url")


@query("gen_day_range", """
WITH r AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) a, max(CAST(o_orderdate AS DATE)) b FROM orders GROUP BY 1),
d AS (SELECT o_custkey, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM r)
SELECT o_custkey, year(day) AS year, month(day) AS month, count(*) AS days, CAST(CAST(min(day) AS DATE) AS VARCHAR) AS first_day,
       CAST(CAST(max(day) AS DATE) AS VARCHAR) AS last_day FROM d GROUP BY ALL""")
def gen_day_range(t):
    """Every calendar day between a customer's first and last order, summed up per month."""
    r = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    days = r.select("o_custkey", F.explode(D.day_range("a", "b", descending=True)).alias("day"))
    return days.groupBy("o_custkey", F.year("day").alias("year"), F.month("day").alias("month")).agg(
        F.count("*").alias("days"), F.min("day").cast("string").alias("first_day"),
        F.max("day").cast("string").alias("last_day"))


@query("listing_key", rf"""
SELECT page_id, regexp_replace(regexp_replace(url || CASE WHEN contains(url, '?') THEN '&start=25' ELSE '?start=25' END, '([?&])start=[^&#]*&?', '\1', 'g'), '[?&]$', '') AS listing,
       CASE WHEN {Q.path('url')} LIKE '/fr%' THEN '/weekly' ELSE {Q.path('url')} END AS base_path
FROM pages WHERE NOT contains(url, '#')""")
def listing_key(t):
    u = F.col("url")
    paged = F.concat(u, F.when(F.contains(u, F.lit("?")), "&start=25").otherwise("?start=25"))
    weekly = U.listing_path(F.regexp_replace(u, "/fr/.*", "/weekly/page/2"))
    return t.pages.where(~F.contains(u, F.lit("#"))).select(
        "page_id", U.listing_key(paged).alias("listing"), weekly.alias("base_path"))
