"""Join, set, integrity and repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from ..operators import audit as A
from ..operators import lookup as LK
from ..operators import stats as ST
from . import sqlparts as Q
from .registry import query


@query("presence_flags", """
SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS labelled, doc_id IN (SELECT item_id FROM benchmark) AS benchmarked FROM documents""")
def presence_flags(t):
    return A.presence_flags(t.documents.select("doc_id"), "doc_id",
                            {"labelled": t.labels.select("doc_id"), "benchmarked": t.benchmark.select("item_id")})


@query("orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def orphans(t):
    """Orders whose customer has no credit are orphans of the credit table."""
    base = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return A.orphans(t.orders.select("o_orderkey", "o_custkey"), base, "o_custkey")


_TITLE = "split_part(text, chr(10), 1)"


@query("dup_titles", f"""
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, {_TITLE} AS title, 'https://d.test/' || source || '/' || lang || '%20' || n_chars AS url FROM documents),
 g AS (SELECT title, count(*) AS group_size FROM d GROUP BY 1 HAVING count(*) > 1)
SELECT d.id, d.title, d.url, group_size, d.id = substr(md5(d.url), 1, 10) AS id_match, true AS encoded_url, lower(hex(encode(d.url))) AS url_hex,
  d.id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS in_urls, d.id IN (SELECT CAST(item_id AS VARCHAR) FROM benchmark) AS in_html
FROM d JOIN g ON d.title IS NOT DISTINCT FROM g.title""")
def dup_titles(t):
    url = F.concat(F.lit("https://d.test/"), "source", F.lit("/"), "lang", F.lit("%20"), "n_chars")
    d = t.documents.select(F.col("doc_id").cast("string").alias("id"), T.first_heading_or_line("text").alias("title"), url.alias("url"))
    return A.duplicate_report(d, "title", U.short_md5("url"), {
        "in_urls": t.labels.select(F.col("doc_id").cast("string")), "in_html": t.benchmark.select(F.col("item_id").cast("string"))})


@query("null_audit", f"""
WITH d AS (SELECT CASE WHEN lang = 'fr' THEN 'Untitled' WHEN lang = 'de' THEN NULL ELSE {_TITLE} END AS title, CASE WHEN source = 'src1' THEN '' ELSE source END AS url,
  text AS content, CASE WHEN n_chars > 1000 THEN text END AS markdown FROM documents)
SELECT count(*) AS rows, count(*) FILTER (title IS NULL OR title IN ('', 'Untitled')) AS missing_title, count(*) FILTER (url IS NULL OR url = '') AS missing_url,
  count(*) FILTER (content IS NULL OR markdown IS NULL) AS missing_body FROM d""")
def null_audit(t):
    lang = F.col("lang")
    d = t.documents.select(
        F.when(lang == "fr", "Untitled").when(lang == "de", F.lit(None)).otherwise(T.first_heading_or_line("text")).alias("title"),
        F.when(F.col("source") == "src1", "").otherwise(F.col("source")).alias("url"),
        F.col("text").alias("content"), F.when(F.col("n_chars") > 1000, F.col("text")).alias("markdown"))
    return ST.null_audit(d, "title", "url", "content", "markdown")


@query("column_matrix", """
WITH d AS (SELECT source AS site, CASE WHEN lang = 'fr' THEN doc_id END AS french, CASE WHEN n_chars > 50000 THEN text END AS long_text, text, CAST(NULL AS VARCHAR) AS author FROM documents),
 w AS (SELECT site, count(french) > 0 AS french, count(long_text) > 0 AS long_text, count(text) > 0 AS text, count(author) > 0 AS author FROM d GROUP BY site)
UNPIVOT w ON french, long_text, text, author INTO NAME field VALUE present""")
def column_matrix(t):
    d = t.documents.select(F.col("source").alias("site"), F.when(F.col("lang") == "fr", F.col("doc_id")).alias("french"),
                           F.when(F.col("n_chars") > 50000, F.col("text")).alias("long_text"), "text",
                           F.lit(None).cast("string").alias("author"))
    return ST.column_matrix(d, "site", ["french", "long_text", "text", "author"])


@query("layer_counts", """
SELECT 'silver' AS layer, count(*) AS n FROM documents UNION ALL SELECT 'urls', count(*) FROM labels UNION ALL SELECT 'html', count(*) FROM pages""")
def layer_counts(t):
    return ST.layer_counts({"silver": t.documents, "urls": t.labels, "html": t.pages})


@query("key_unique", """
SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def key_unique(t):
    return A.key_violations(t.orders, ["o_custkey", "o_orderpriority"])


@query("id_mismatch", f"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '([0-9]+)[^0-9]*$', 1) AS id FROM pages)
SELECT page_id, id, {Q.job_id('url')} AS expected_id FROM p WHERE id IS DISTINCT FROM {Q.job_id('url')}""")
def id_mismatch(t):
    p = t.pages.select("page_id", "url", F.regexp_extract("url", r"([0-9]+)[^0-9]*\z", 1).alias("id"))
    return A.id_mismatches(p, U.job_id("url")).select("page_id", "id", "expected_id")


@query("suspicious_urls", f"""
WITH p AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, 'https://' || {Q.host('url')} || CASE WHEN url LIKE '%/fr/%' THEN '/newsletter-x' ELSE '/' || page_id END FROM pages)
SELECT page_id, url, len(list_filter(string_split({Q.path('url')}, '/'), lambda s: s <> '')) > 1 OR contains({Q.path('url')}, '/newsletter') AS suspicious FROM p""")
def suspicious_urls(t):
    short = F.concat(F.lit("https://"), U.host_of("url"), F.when(F.contains("url", F.lit("/fr/")), F.lit("/newsletter-x"))
                     .otherwise(F.concat(F.lit("/"), "page_id")))
    p = t.pages.select("page_id", "url").union(t.pages.select("page_id", short))
    return p.select("page_id", "url", A.is_suspicious_url("url").alias("suspicious"))


@query("clean_errors", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'HTTP 404: Document NOT found ' || user_id WHEN 'view' THEN 'timeout' END AS error FROM events)
SELECT event_id, error FROM e WHERE error IS NULL OR NOT regexp_matches(error, '(?i)document not found')""")
def clean_errors(t):
    error = F.when(F.col("event_type") == "error", F.concat(F.lit("HTTP 404: Document NOT found "), "user_id")).when(
        F.col("event_type") == "view", "timeout")
    return A.clean_errors(t.events.select("event_id", error.alias("error")))


@query("purge_urls", r"""
WITH q AS (SELECT page_id, 0 AS k, 'pages' AS site, url AS u, url AS payload FROM pages
  UNION ALL SELECT page_id, 1, CASE WHEN url LIKE 'https%' THEN 'pages' ELSE 'other' END, url, '{"site": "x", "url": "' || url || '"}' FROM pages)
SELECT page_id, k, NOT regexp_matches(u, '/(en|fr)/[0-9]+$') AS removed FROM q WHERE k = 0
UNION ALL SELECT page_id, k, site = 'pages' AND regexp_matches(u, 'utm_source') FROM q WHERE k = 1
UNION ALL SELECT page_id, 2, regexp_matches('broken ' || url, 'utm_source') FROM pages""")
def purge_urls(t):
    """Negated purge on the table; purge of matching queue items of one site, broken ones as text."""
    table = A.split_by_pattern(t.pages, F.col("url"), r"/(en|fr)/[0-9]+\z", negate=True).select("page_id", F.lit(0).alias("k"), "removed")
    site = F.when(F.startswith("url", F.lit("https")), "pages").otherwise("other")
    payload = F.concat(F.lit('{"site": "'), site, F.lit('", "url": "'), "url", F.lit('"}'))
    queue = t.pages.select("page_id", F.lit(1).alias("k"), payload.alias("p")).union(
        t.pages.select("page_id", F.lit(2), F.concat(F.lit("broken "), "url")))
    purged = A.split_by_pattern(queue, A.queue_item_url("p", "pages"), "utm_source")
    return table.union(purged.select("page_id", "k", "removed"))


_NOISY = f"""n AS (SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN regexp_replace(url, '[?#].*$', '') || '한글' ELSE url END AS url FROM pages),
 r AS (SELECT page_id, url, CASE WHEN url LIKE '%한글' THEN '한글' || page_id ELSE {Q.job_id('url')} END AS id, CASE WHEN url LIKE 'https%' THEN 'T' || page_id END AS title FROM n)"""


@query("noise_ids", f"""WITH {_NOISY},
 c AS (SELECT *, {Q.strip_tracking('url')} AS clean_url FROM r WHERE regexp_matches(id, '[{Q.HANGUL}%]')),
 m AS (SELECT {Q.job_id('clean_url')} AS id, arg_min(clean_url, id) AS url, arg_min(coalesce(title, 'Recovered Clean Target'), id) AS title FROM c GROUP BY 1)
SELECT id, url, title, 'done' AS status FROM r WHERE NOT regexp_matches(id, '[{Q.HANGUL}%]')
UNION ALL SELECT id, url, title, 'new' FROM m WHERE id NOT IN (SELECT id FROM r WHERE NOT regexp_matches(id, '[{Q.HANGUL}%]'))""")
def noise_ids(t):
    """French pages get a Hangul tail and a noisy id; the repair must bring back the clean ids."""
    noisy = F.contains("url", F.lit("/fr/"))
    url = F.when(noisy, F.concat(F.regexp_replace("url", r"[?#].*\z", ""), F.lit("한글"))).otherwise(F.col("url"))
    rows = t.pages.select("page_id", url.alias("url"), noisy.alias("noisy"), F.startswith("url", F.lit("https")).alias("secure"))
    rows = rows.select(F.when(F.col("noisy"), F.concat(F.lit("한글"), "page_id")).otherwise(U.job_id("url")).alias("id"), "url",
                       F.when(F.col("secure"), F.concat(F.lit("T"), "page_id")).alias("title"), F.lit("done").alias("status"))
    return A.repair_noise_ids(rows, U.job_id)


@query("id_migration", f"""
WITH r AS (SELECT page_id, url, CASE WHEN url LIKE '%/en/%' THEN {Q.job_id('url')} ELSE 'old' || page_id END AS id, {Q.job_id('url')} AS expected_id FROM pages),
 o AS (SELECT *, CASE WHEN id = expected_id THEN 'ok' WHEN expected_id IN (SELECT id FROM r) THEN 'duplicate'
   WHEN page_id = min(page_id) FILTER (id <> expected_id) OVER (PARTITION BY expected_id) THEN 'migrated' ELSE 'duplicate' END AS outcome FROM r)
SELECT page_id, id, expected_id, outcome FROM o""")
def id_migration(t):
    rows = t.pages.select("page_id", "url", F.when(F.contains("url", F.lit("/en/")), U.job_id("url"))
                          .otherwise(F.concat(F.lit("old"), "page_id")).alias("id"))
    return A.migrate_ids(rows, U.job_id("url"), "page_id").select("page_id", "id", "expected_id", "outcome")


@query("migration_summary", f"""
WITH r AS (SELECT page_id, url, CASE WHEN url LIKE '%/en/%' THEN {Q.job_id('url')} ELSE 'old' || page_id END AS id, {Q.job_id('url')} AS expected_id FROM pages),
 o AS (SELECT *, CASE WHEN id = expected_id THEN 'ok' WHEN expected_id IN (SELECT id FROM r) THEN 'duplicate'
   WHEN page_id = min(page_id) FILTER (id <> expected_id) OVER (PARTITION BY expected_id) THEN 'migrated' ELSE 'duplicate' END AS outcome FROM r)
SELECT outcome, count(*) AS n FROM o GROUP BY 1""")
def migration_summary(t):
    rows = t.pages.select("page_id", "url", F.when(F.contains("url", F.lit("/en/")), U.job_id("url"))
                          .otherwise(F.concat(F.lit("old"), "page_id")).alias("id"))
    return A.migration_summary(A.migrate_ids(rows, U.job_id("url"), "page_id"))


@query("id_samples", """
WITH d AS (SELECT source AS site, CAST(doc_id AS VARCHAR) AS id, 'https://d.test/' || doc_id AS url FROM documents),
 s AS (SELECT site, count(*) AS n, min(id) AS id FROM d GROUP BY 1)
SELECT site, n, id, id AS expected_id, true AS id_match, id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS completed FROM s""")
def id_samples(t):
    d = t.documents.select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("id"),
                           F.concat(F.lit("https://d.test/"), "doc_id").alias("url"))
    return A.id_samples(d, "site", U.job_id("url"), t.labels.select(F.col("doc_id").cast("string")))


@query("spa_shell", """
SELECT page_id, (contains(h, 'id="main-outlet"') OR contains(h, 'id="discourse-comments"')) AND NOT contains(h, 'itemprop="text"') AS shell
FROM (SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN '<div id="main-outlet">' || html WHEN url LIKE '%/de/%' THEN '<div id="discourse-comments"><p itemprop="text">' || html ELSE html END AS h FROM pages)""")
def spa_shell(t):
    h = (F.when(F.contains("url", F.lit("/fr/")), F.concat(F.lit('<div id="main-outlet">'), "html"))
         .when(F.contains("url", F.lit("/de/")), F.concat(F.lit('<div id="discourse-comments"><p itemprop="text">'), "html")).otherwise(F.col("html")))
    return t.pages.select("page_id", A.is_spa_shell(h).alias("shell"))


@query("prune_empty", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS keep FROM customer")
def prune_empty(t):
    """Customers are sessions, pending orders their transcripts."""
    return A.prune_empty(t.customer.select("c_custkey"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# --- look-ups and sets ------------------------------------------------------------------------------------

@query("any_key_lookup", """
WITH k AS (SELECT CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT DISTINCT o_orderkey, key FROM orders, k WHERE CAST(o_orderkey AS VARCHAR) = key
UNION SELECT DISTINCT o_orderkey, key FROM orders, k WHERE CAST(o_custkey AS VARCHAR) = key""")
def any_key_lookup(t):
    """Orders found by order key or by customer key."""
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("key"))
    return LK.match_any_key(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], wanted).select("o_orderkey", "key")


@query("silver_bronze", """
SELECT l.doc_id, quality, source, lang, n_chars FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id AND d.lang <> 'fr'""")
def silver_bronze(t):
    """Labels as silver, documents as bronze; French captures are missing."""
    return LK.stitch(t.labels.select("doc_id", "quality"), t.documents.where("lang <> 'fr'"), ["doc_id"], ["source", "lang", "n_chars"])


@query("key_union", "SELECT doc_id AS key FROM documents UNION SELECT doc_id FROM labels UNION SELECT item_id FROM benchmark")
def key_union(t):
    return LK.key_union(t.documents.select("doc_id"), t.labels.select("doc_id"), t.benchmark.select("item_id"))


@query("id_except", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def id_except(t):
    return t.documents.select("doc_id").join(t.labels.where("quality = 1").select("doc_id"), "doc_id", "left_anti").distinct()


@query("prefer_variant", """
WITH f AS (SELECT doc_id, 'Ch ' || n_chars || CASE lang WHEN 'fr' THEN '.en-ko.md' WHEN 'de' THEN '.txt' ELSE '.md' END AS file, source AS book FROM documents
   UNION ALL SELECT doc_id, CASE lang WHEN 'en' THEN 'INDEX.md' ELSE 'readme.MD' END, source FROM documents WHERE lang <> 'fr'),
 m AS (SELECT *, lower(regexp_replace(file, '(?i)(\\.en-ko)?\\.md$', '')) AS base, lower(file) LIKE '%.en-ko.md' AS tr FROM f
   WHERE lower(file) LIKE '%.md' AND upper(regexp_replace(file, '(?i)\\.md$', '')) NOT IN ('INDEX', 'README'))
SELECT doc_id, book, file FROM (SELECT *, bool_or(tr) OVER (PARTITION BY book, base) AS has_tr FROM m) WHERE tr OR NOT has_tr""".replace("\\\\", "\\"))
def prefer_variant(t):
    ending = F.when(F.col("lang") == "fr", ".en-ko.md").when(F.col("lang") == "de", ".txt").otherwise(".md")
    f = t.documents.select("doc_id", F.concat(F.lit("Ch "), "n_chars", ending).alias("file"), F.col("source").alias("book")).union(
        t.documents.where("lang <> 'fr'").select("doc_id", F.when(F.col("lang") == "en", "INDEX.md").otherwise("readme.MD"), "source"))
    return LK.prefer_translation(f, "book", "file").select("doc_id", "book", "file")
