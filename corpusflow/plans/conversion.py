"""Conversion queries: pages, and JSON payloads and markup built from other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import decode_entities, first_heading_or_line, strip_tags
from ..operators import company as CO
from ..operators import convert as CV
from ..operators import extract as X
from . import sqlparts as Q
from .registry import query
from .texts import NL, S, TITLE, C


def captures(t):
    """Pages as captures."""
    return t.spread("pages").select(C("page_id").alias("id"), "url", F.col("html").alias("raw_html"), F.lit(None).cast("string").alias("raw_json"),
                          F.lit("2024-02-01").cast("timestamp").alias("scraped_at"))


_PARSED_TITLE = Q.parsed_text("trim(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1))".replace("\\\\", "\\"))
_RE_TITLE = Q.decode_entities("trim(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1))".replace("\\\\", "\\"))


@query("html_extract", f"""WITH {Q.ANCHORS}, a AS (SELECT page_id, count(*) AS links FROM anchors GROUP BY 1)
SELECT CAST(p.page_id AS VARCHAR) AS id, {_PARSED_TITLE} AS title, coalesce(links, 0) AS links, true AS same_h1, CAST(NULL AS VARCHAR) AS canonical FROM pages p LEFT JOIN a USING (page_id)""")
def html_extract(t):
    """One parse per page; the title and the number of links have a regex counterpart."""
    x = captures(t).select("id", X.page_fields(content=["article"])(F.col("raw_html")).alias("x"))
    return x.select("id", "x.title", F.size("x.links").alias("links"), (F.col("x.title") == F.col("x.h1")).alias("same_h1"), "x.canonical")


@query("title_cascade", f"""
SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN 'OG ' || page_id ELSE coalesce(nullif({_RE_TITLE}, ''), 'Unknown Title') END AS title,
  CASE WHEN url LIKE '%/de/%' THEN 'https://c.test/' || page_id ELSE url END AS link FROM pages""")
def title_cascade(t):
    og = F.when(F.contains("url", F.lit("/fr/")), S('<meta property="og:title" content="OG ', C("page_id"), '">')).otherwise("")
    canonical = F.when(F.contains("url", F.lit("/de/")), S("https://c.test/", C("page_id")))
    h = t.spread("pages").select("page_id", "url", F.concat(og, "html").alias("html"), canonical.alias("canonical"))
    title = F.coalesce(CV.meta_content("html", "og:title"), CV.tag_text("html", "title"), F.lit("Unknown Title"))
    return h.select("page_id", title.alias("title"), F.coalesce("canonical", "url").alias("link"))


@query("html_to_markdown", rf"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '{Q.INVISIBLE}|<nav>.*?</nav>|<[^>]*>', '', 'g'), '&amp;?|&[a-zA-Z0-9#]+;', '', 'g'), '[^\p{{L}}\p{{N}}]+', '', 'g') AS letters FROM pages""")
def html_to_markdown(t):
    """Markdown of every page, reduced to its letters and digits for the comparison."""
    md = X.markdown()(F.col("html"))
    return t.spread("pages").select("page_id", F.regexp_replace(md, r"[^\p{L}\p{N}]+", "").alias("letters"))


@query("html_minify", f"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(html, '&quot;', '"'), '&(?:amp;?)?', '&amp;', 'g'), '{Q.INVISIBLE}|<nav>.*?</nav>|<footer>.*?</footer>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS txt FROM pages""".replace("\\\\", "\\"))
def html_minify(t):
    """Visible text of minified pages."""
    return t.spread("pages").select("page_id", strip_tags(X.minify()(F.col("html"))).alias("txt"))


_VISIBLE = f"regexp_replace(html, '{Q.INVISIBLE}', ' ', 'g')"
@query("content_select")
def content_select(t):
    """Body markup by selector order, the whole body when the article has 50 characters or less."""
    x = X.page_fields(content=["main", "article"], min_content=50, links=False)
    rows = t.spread("pages").select("page_id", x(F.col("html")).alias("x"))
    return rows.select("page_id", "x.content_rank", decode_entities(strip_tags("x.content_html")).alias("txt"))


@query("main_container", f"SELECT page_id, 'article' AS label, len(regexp_extract_all({_VISIBLE}, '<p>')) AS paragraphs FROM pages")
def main_container(t):
    return CV.main_containers(t.spread("pages"), "page_id", "html", "p").select("page_id", "label", "paragraphs")


@query("selector_audit", f"""WITH {Q.ANCHORS}
SELECT 'a' AS selector, (SELECT count(*) FROM anchors) AS matches, (SELECT count(DISTINCT page_id) FROM anchors) AS pages
UNION ALL SELECT 'h1', count(*), count(*) FROM pages UNION ALL SELECT 'table.none', 0, 0""")
def selector_audit(t):
    """Matches per selector over the whole corpus: a drift monitor."""
    rows = t.spread("pages").select(F.explode(X.selector_audit(["a", "h1", "table.none"])(F.col("html"))).alias("s")).select("s.*")
    return rows.groupBy("selector").agg(F.sum("count").alias("matches"), F.count_if(F.col("count") > 0).alias("pages"))


_RUN = Q.parsed_text("r")


@query("dense_elements", rf"""
WITH x AS (SELECT page_id, unnest(regexp_extract_all({_VISIBLE}, '>([^<]+)<', 1)) AS r FROM pages), y AS (SELECT page_id, trim({_RUN}, ' ' || chr(10)) AS t FROM x)
SELECT page_id, length(t) AS text_length, substr(t, 1, 100) || '...' AS preview FROM y WHERE length(t) >= 200""")
def dense_elements(t):
    rows = t.spread("pages").select("page_id", F.explode(X.dense_elements(200)(F.col("html"))).alias("e"))
    return rows.select("page_id", "e.text_length", "e.preview")


@query("listing_items", f"""WITH {Q.ANCHORS} SELECT page_id, href, min(pos) AS pos FROM anchors WHERE href <> '' GROUP BY 1, 2""")
def listing_items(t):
    return CV.listing(t.spread("pages"), "page_id", "html", [".post-title a", "nav li a", "a"], "body").select("page_id", "href", "pos")


@query("job_cards", r"""
SELECT page_id, CAST(4000000 + page_id AS VARCHAR) AS job_id, 'Engineer ' || page_id AS title, 'Acme' AS company, 'Berlin' AS location, 'Germany' AS geo, true AS matches_target FROM pages
UNION ALL SELECT page_id, CAST(9000000 + page_id AS VARCHAR), 'Other', '정보 없음', '정보 없음', 'Others', false FROM pages""")
def job_cards(t):
    """Two cards planted into every page, one of them twice."""
    n = F.col("page_id")
    card = S('<ul><li><a href="/jobs/view/engineer-at-acme-', (n + 4000000).cast("string"), '?x=1"> Engineer  ', C("page_id"),
             '</a><h4 class="base-subtitle">Acme</h4><span class="job-location">Berlin 3 days ago</span></li>')
    again = S('<li><a href="/jobs/view/', (n + 4000000).cast("string"), '">Again</a><li><a href="https://x/jobs/view/', (n + 9000000).cast("string"), '">Other</a></ul>')
    p = t.spread("pages").select("page_id", F.concat(card, again, "html").alias("html"))
    return CV.job_cards(p, "page_id", "html", ["Germany"]).select("page_id", "job_id", "title", "company", "location", "geo", "matches_target")


@query("job_fields", f"""SELECT CAST(page_id AS VARCHAR) AS id, CAST(page_id AS VARCHAR) AS job_id, regexp_replace({_PARSED_TITLE}, '\\s+', ' ', 'g') AS job_title,
  '정보 없음' AS workplace_type, '일반 지원 (External Apply)' AS apply_type, '2024-02-01 09:00:00' AS posted_date FROM pages""")
def job_fields(t):
    """Pages as job postings: they carry a title and nothing else a posting has."""
    return CV.convert(captures(t), "linkedin").select("id", "job_id", "job_title", "workplace_type", "apply_type", "posted_date")


@query("course_links", "SELECT page_id, 'https://x.example.com/c/' || page_id AS href FROM pages")
def course_links(t):
    x = X.page_fields()(F.concat(S('<a href="https://x.example.com/c/', C("page_id"), '">A Course</a>'), F.col("html")))
    rows = t.spread("pages").select("page_id", x.alias("x"))
    return rows.select("page_id", F.explode(CV.course_links(F.col("x.links"), F.lit("example.com"))).alias("href"))


@query("first_external_link", f"""WITH {Q.ANCHORS}, e AS (SELECT page_id, min(pos) AS pos FROM anchors WHERE href LIKE 'http%' GROUP BY 1)
SELECT page_id, 'https://out.test/' || page_id AS source_link, CAST(page_id AS INTEGER) AS views FROM pages""")
def first_external_link(t):
    """Two links and a view counter planted after each page's own links."""
    planted = S('<body><a href="https://aicasebook.dev/x">own</a><a href="https://out.test/', C("page_id"), '">out</a>조회 ', C("page_id"), "</body>")
    links = F.transform(F.regexp_extract_all(planted, F.lit('href="([^"]*)"'), F.lit(1)), lambda h: F.struct(h.alias("href")))
    views = F.regexp_extract(planted, r"조회\s*(\d+)", 1).cast("int")
    return t.spread("pages").select("page_id", CV.first_external_link(links, F.lit("aicasebook.dev")).alias("source_link"), views.alias("views"))


@query("raw_payload", """
SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN NULL ELSE md5(CASE WHEN url LIKE '%/de/%' THEN '{"u":"' || url || '"}' ELSE html END) END AS payload,
  CASE WHEN url LIKE '%/fr/%' THEN 'No rawHtml or rawJson found' END AS error FROM pages""")
def raw_payload(t):
    fr, de = F.contains("url", F.lit("/fr/")), F.contains("url", F.lit("/de/"))
    p = t.spread("pages").select("page_id", F.when(~fr & ~de, F.col("html")).when(de, "").alias("raw_html"), F.when(de, S('{"u":"', F.col("url"), '"}')).alias("raw_json"))
    payload, error = CV.raw_payload()
    return p.select("page_id", F.md5(payload).alias("payload"), error.alias("error"))


# --- JSON payloads -----------------------------------------------------------------------------------------

@query("jsonld_blocks", """
SELECT event_id, 0 AS i, 'NewsArticle' AS kind, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
UNION ALL SELECT event_id, 1, 'NewsArticle', CAST(json_extract(props, '$.k') AS INTEGER) + 1 FROM events WHERE event_type = 'view'""")
def jsonld_blocks(t):
    """Event properties as structured-data blocks: one object, one list, one broken text."""
    k = F.get_json_object("props", "$.k").cast("int")
    one = S('<script type="application/ld+json">{"@type": "NewsArticle", "k": ', k.cast("string"), "}</script>")
    many = S('<script id="x" type="application/ld+json">[{"@type": "Thing"}, {"@type": "NewsArticle", "k": ', (k + 1).cast("string"), "}]</script>")
    html = S("<p>", one, F.when(F.col("event_type") == "view", many).otherwise(""), '<script type="application/ld+json">{broken</script>')
    items = CV.json_ld_items(CV.json_ld_blocks(html), "NewsArticle")
    rows = t.events.select("event_id", F.posexplode(items).alias("i", "j"))
    return rows.select("event_id", "i", F.get_json_object("j", "$['@type']").alias("kind"), F.get_json_object("j", "$.k").cast("int").alias("k"))


def comment_trees(t):
    """Conversations as comment trees, each turn the reply to the turn before."""
    nest = t.conversations.withColumn("j", F.to_json(F.struct(F.col("text"), S("https://x?id=", C("turn"), "&z=1").alias("url"))))
    g = nest.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "j"))).alias("a"))
    opening = F.array_join(F.transform("a", lambda x: F.regexp_replace(x["j"], r"\}\z", ', "comment": [')), "")
    tree = S('{"comment": ', opening, F.repeat(F.lit("]}"), F.size("a")), "}")
    return g.select("conv_id", tree.alias("tree"))


@query("comment_flatten", """
WITH c AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations)
SELECT conv_id, pos, CAST(turn AS VARCHAR) AS comment_id, text AS content FROM c WHERE text <> ''""")
def comment_flatten(t):
    """Each turn is the reply to the turn before: nested comment objects, flattened again."""
    g = comment_trees(t)
    rows = g.select("conv_id", F.posexplode(X.flatten_comments(F.col("tree"))).alias("pos", "c"))
    return rows.select("conv_id", "pos", "c.comment_id", "c.content")


POST_SQL = f"""
SELECT doc_id, {TITLE} AS title, CASE lang WHEN 'fr' THEN 'Ann' WHEN 'de' THEN 'Bob' ELSE 'Unknown' END AS author, CASE WHEN lang = 'en' THEN 'short "q"' ELSE 'long' || {NL} || source END AS summary,
  CASE WHEN lang = 'es' THEN 7 ELSE 0 END AS reactions_count, '2024-01-02' AS published, 'https://www.gpters.org/news/post/s-' || doc_id AS url FROM documents"""


def post_payloads(t):
    """Documents as captured posts: ``doc_id, raw_json``."""
    q = F.to_json(F.struct(first_heading_or_line("text").alias("title")))
    lang = F.col("lang")
    who = F.when(lang == "fr", ', "author": {"name": "Ann"}').when(lang == "de", ', "createdBy": {"member": {"name": "Bob"}}').otherwise("")
    body = F.when(lang == "en", ', "shortContent": "short \\\\\\"q\\\\\\""').otherwise(
        S(', "fields": [{"key": "content", "value": "old"}, {"key": "content", "value": "long\\\\n', F.col("source"), '"}]'))
    likes = F.when(lang == "es", ', "reactionsCount": 7').otherwise("")
    payload = S(F.regexp_replace(q, r"\}\z", ""), who, body, likes, ', "slug": "s", "createdAt": "2024-01-02T03:04:05.000Z"}')
    return t.documents.select("doc_id", payload.alias("raw_json"))


@query("json_post", POST_SQL)
def json_post(t):
    none = F.lit(None).cast("string")
    b = post_payloads(t).select("doc_id", C("doc_id").alias("id"), none.alias("url"), none.alias("raw_html"), "raw_json", F.lit("2024-02-01").cast("timestamp").alias("scraped_at"))
    m = CV.convert(b, "gpters")
    return m.select(F.col("id").cast("bigint").alias("doc_id"), "title", "author", "summary", "reactions_count",
                    F.date_format("published_at", "yyyy-MM-dd").alias("published"), "url")


@query("json_topic", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'raw' ELSE 'topic &lt;' || event_id END AS title, CASE WHEN event_type = 'error' THEN NULL ELSE 'cooked ' || user_id END AS body FROM events""")
def json_topic(t):
    """Captured topic responses rebuilt as pages; a response without content keeps its capture."""
    posts = F.when(F.col("event_type") == "error", "[]").otherwise(S('[{"cooked": "<p>cooked ', C("user_id"), '</p>"}]'))
    j = S('{"title": "topic <', C("event_id"), '", "created_at": "2024-01-01", "post_stream": {"posts": ', posts, "}}")
    caps = t.events.select("event_id", C("event_id").alias("id"), F.lit("https://t").alias("url"), F.lit("<title>raw</title>").alias("raw_html"))
    fixed = CV.with_topic_fallback(caps, t.events.select(C("event_id").alias("id"), j.alias("topic_json")), F.lit(True))
    title = F.regexp_replace(F.regexp_extract("raw_html", "<title>(.*?)</title>", 1), r" - PyTorchKR\z", "")
    return fixed.select("event_id", title.alias("title"), F.nullif(F.regexp_extract("raw_html", "<p>(.*?)</p>", 1), F.lit("")).alias("body"))


@query("company_entity", """
SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'Supplier' ELSE s_name END AS company_name, CASE WHEN s_acctbal < 0 THEN '정보 없음' ELSE n_name END AS industry,
  CASE WHEN s_acctbal < 0 THEN '정보 없음' ELSE 'L1, ' || n_name END AS hq_location, CASE WHEN s_acctbal < 0 THEN '정보 없음' ELSE s_suppkey || '+ employees' END AS company_size FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey > 0""")
def company_entity(t):
    """Suppliers as profile pages whose data block holds a decoy, the company and its nation as
    industry; suppliers in debt have a broken block."""
    k = C("s_suppkey")
    ent = S('{"$type": "x.organization.Company", "universalName": "S-', k, '", "name": "', F.col("s_name"), '", "*industry": ["urn:', C("s_nationkey"),
            '"], "employeeCountRange": {"start": ', k, '}, "headquarter": {"address": {"line1": " L1", "country": "', F.col("n_name"), '"}}}')
    block = S('{"included": [{"$type": "x.organization.Company", "universalName": "decoy", "name": "Decoy"}, ', ent, ', {"$type": "x.Industry", "entityUrn": "urn:',
              C("s_nationkey"), '", "name": "', F.col("n_name"), '"}, {"$type": "x.Industry", "entityUrn": "urn:none", "name": "No"}]}')
    html = S("<title>Supplier: About | LinkedIn</title><code id=\"a\"><!--not json--></code><code id=\"b\"><!--", F.when(F.col("s_acctbal") < 0, "{x").otherwise(block), "--></code>")
    j = t.supplier.where("s_suppkey > 0").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = j.select(S("s-", k).alias("id"), F.lit("u").alias("url"), html.alias("raw_html"))
    out = CO.company_records(rows)
    return out.select(F.regexp_replace("id", "^s-", "").cast("bigint").alias("s_suppkey"), "company_name", "industry", "hq_location", "company_size")


@query("company_silver", """
SELECT s_suppkey, s_name AS company_name, 'http://w/' || s_suppkey AS source_link, n_name AS category FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 0""")
def company_silver(t):
    """Suppliers as profile pages without a data block, whose definition list fills the record; those of the first
    region are captures without payload."""
    html = S("<title>", F.col("s_name"), ": About | LinkedIn</title><dl><dt>Industry</dt><dd>", F.col("n_name"), "</dd><dt>Website</dt><dd>http://w/", C("s_suppkey"), "</dd></dl>")
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        C("s_suppkey").alias("id"), F.lit("u").alias("url"), F.when(F.col("n_regionkey") != 0, html).alias("raw_html"),
        F.lit(None).cast("string").alias("raw_json"), F.lit("2024-01-02").alias("scraped_at"))
    out = CV.silver(CV.convert(rows, "linkedin_company"), "linkedin_company")
    return out.select(F.col("id").cast("bigint").alias("s_suppkey"), "company_name", "source_link", "category")


@query("dl_pairs", "SELECT p_partkey, p_brand AS website, CAST(p_size AS VARCHAR) || ' staff' AS company_size, CAST(NULL AS VARCHAR) AS founded FROM part")
def dl_pairs(t):
    html = S("<dl><dt>Website:</dt><dd> ", F.col("p_brand"), " </dd><dt>Company size</dt><dd>", C("p_size"), "\n staff</dd><dt>Founded</dt></dl>")
    rows = t.part.select("p_partkey", X.definition_pairs()(html).alias("pairs"))
    f = CO.definition_fields(F.col("pairs"))
    return rows.select("p_partkey", f["website"].alias("website"), f["company_size"].alias("company_size"), F.nullif(f["founded"], F.lit("")).alias("founded"))


@query("md_assemble", f"""
SELECT doc_id, '# ' || {TITLE} || {NL} || {NL} || CASE WHEN lang = 'fr' THEN '* **카테고리:** ' || source || {NL} ELSE '' END || '* **작성일:** ' || CASE WHEN lang = 'de' THEN '정보 없음' ELSE '2024-01-02T00:00:00.000Z' END
  || {NL} || '* **원본 링크:** [바로가기](https://d/' || doc_id || ')' || {NL} || {NL} || '## 내용' || {NL} || {NL} || text || {NL} AS md FROM documents""")
def md_assemble(t):
    at = F.when(F.col("lang") != "de", F.lit("2024-01-02").cast("timestamp"))
    category = F.when(F.col("lang") == "fr", F.col("source"))
    md = CV.assemble(S("# ", first_heading_or_line("text")), [CV._line("카테고리", category), CV._must("작성일", CV.iso(at)), CV._go("원본 링크", S("https://d/", C("doc_id")))],
                     ["\n## 내용\n\n", F.col("text"), "\n"])
    return t.documents.select("doc_id", md.alias("md"))


@query("silver_build", f"""
SELECT 'uppity' AS site, CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'fr' THEN 'Untitled' ELSE {TITLE} END AS title, CASE WHEN lang = 'de' THEN NULL ELSE 'https://d/' || doc_id END AS url,
   md5(text) AS content, CAST(NULL AS INTEGER) AS reactions_count, CAST(NULL AS VARCHAR) AS geo FROM documents WHERE {TITLE} <> ''
UNION ALL SELECT 'linkedin', CAST(doc_id AS VARCHAR), CASE WHEN lang = 'fr' THEN 'Untitled' ELSE {TITLE} END, 'https://www.linkedin.com/jobs/view/' || doc_id, md5(text), NULL, CASE lang WHEN 'de' THEN 'Germany' ELSE 'unknown-location' END FROM documents WHERE {TITLE} <> ''
UNION ALL SELECT 'gpters', CAST(doc_id AS VARCHAR), CASE WHEN lang = 'fr' THEN 'Untitled' ELSE {TITLE} END, CASE WHEN lang = 'de' THEN NULL ELSE 'https://d/' || doc_id END, NULL, 0, NULL FROM documents WHERE {TITLE} <> ''""")
def silver_build(t):
    """Documents as converted meta of three sites, brought to one silver table."""
    no, lang = F.lit(None).cast("string"), F.col("lang")
    d = t.documents.where(first_heading_or_line("text") != "")
    head = F.when(lang == "fr", "").otherwise(first_heading_or_line("text"))
    url = F.when(lang == "de", "").otherwise(S("https://d/", C("doc_id")))
    base = d.select(C("doc_id").alias("id"), head.alias("title"), url.alias("url"), F.lit(None).cast("timestamp").alias("published_at"), F.col("text").alias("content"),
                    F.col("text").alias("raw_content"), F.lit(None).cast("timestamp").alias("updated_at"), no.alias("error"), "lang")
    job = base.withColumn("job_title", F.col("title")).withColumn("company", no).withColumn("raw_location", F.when(lang == "de", "Berlin"))
    post = base.withColumn("author", no).withColumn("summary", no).withColumn("reactions_count", F.lit(None).cast("int")).withColumn(
        "replies_count", F.lit(None).cast("int")).withColumn("space_id", no).withColumn("space_name", no).withColumn("space_slug", no)
    out = CV.silver_table({"uppity": base, "linkedin": job, "gpters": post})
    return out.select("site", "id", "title", "url", F.md5("content").alias("content"), "reactions_count", "geo")


@query("convert_pages", f"SELECT CAST(page_id AS VARCHAR) AS id, {_PARSED_TITLE} AS title, url, true AS has_text FROM pages")
def convert_pages(t):
    """Every page converted as an article of one site, up to the silver record."""
    s = CV.silver(CV.convert(captures(t), "uppity"), "uppity")
    return s.select("id", "title", "url", (F.length("markdown") > F.length("title")).alias("has_text"))
