"""Text, date, geography and JSON scalar queries. Documents carry few of the marks the rules look
for, so the inputs are built from document columns on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import geo as G
from ..functions import jsonx as J
from ..functions import text as T
from ..operators import images as IM
from . import sqlparts as Q
from .registry import query

NL = "chr(10)"
TITLE = f"split_part(text, {NL}, 1)"


def S(*parts):
    """Concatenate literals and columns (columns are given as Column objects)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def C(name):
    return F.col(name).cast("string")


def title():
    return T.first_heading_or_line("text")


@query("md_clean_links", f"""
SELECT doc_id, ')[' || trim({TITLE}) || ' more](https://x/' || doc_id || ') [![a b](i.png)](u) [esc_' || {NL} || text AS md FROM documents""")
def md_clean_links(t):
    md = S("[go](javascript:void(0))[ ", title(), " \n more ]( https://x/ ", C("doc_id"), " ) [ ![a b](i.png)\n\n ]( u ) \\[esc\\_\n", F.col("text"))
    return t.spread("documents").select("doc_id", T.clean_markdown_links(md).alias("md"))


_CC = rf"""
 b0 AS (SELECT doc_id, k, regexp_replace(c, '<[^>]*>', '', 'g') AS c FROM b),
 b1 AS (SELECT doc_id, k, c, list_transform(regexp_split_to_array(c, '\s+-\s+'), lambda p: trim(p, ' ' || chr(10) || chr(9))) AS parts,
   len(regexp_extract_all(c, '\s+-\s+')) AS dashes, length(c) - length(replace(c, chr(10), '')) AS nls FROM b0),
 b2 AS (SELECT doc_id, k, CASE WHEN dashes >= 3 AND nls <= 1 AND len(list_filter(parts, lambda p: length(p) < 3)) = 0
   THEN '- ' || array_to_string(parts, chr(10) || '- ') ELSE c END AS c FROM b1)"""


@query("md_clean_content", rf"""
WITH b AS (SELECT doc_id, 0 AS k, text AS c FROM documents
  UNION ALL SELECT doc_id, 1, '* ''#' || doc_id || '''' || {NL} || '## H' || {NL} || '  * one' || {NL} || '\- two <b>x</b>' || {NL} || text FROM documents
  UNION ALL SELECT doc_id, 2, 'aaa - ' || {TITLE} || ' - ccc - ' || lang || ' - dddd' FROM documents), {_CC}
SELECT doc_id, k, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(c,
   '^\*?\s*[''"#]*\d+\s*[''"]*\s*\n?', ''), '(?m)^[ \t]*\*[ \t]', '- ', 'g'), '(?m)^\\- ', '- ', 'g'), '(?m)^(#{{2,}})\s', '#\1 ', 'g'), '^\s+', '') AS c FROM b2""")
def md_clean_content(t):
    d = t.spread("documents")
    rows = d.select("doc_id", F.lit(0).alias("k"), F.col("text").alias("c")).union(d.select("doc_id", F.lit(1), S(
        "* '#", C("doc_id"), "'\n## H\n  * one\n\\- two <b>x</b>\n", F.col("text")))).union(
        d.select("doc_id", F.lit(2), S("aaa - ", title(), " - ccc - ", F.col("lang"), " - dddd")))
    return rows.select("doc_id", "k", T.clean_content("c").alias("c"))


@query("md_view_clean", f"""
SELECT doc_id, CASE WHEN lang = 'fr' THEN trim(text) WHEN lang = 'de' THEN '## 📝 jd' || {NL} || trim({TITLE}) ELSE 'x' END AS md FROM documents""")
def md_view_clean(t):
    md = (F.when(F.col("lang") == "fr", S("---\ntitle: ", C("doc_id"), "\n---\n", F.col("text"), "\n## 💬 Comments\nno"))
          .when(F.col("lang") == "de", S("intro\n## 📝 jd\n", title(), "\n## 💬 댓글 (3)\n", F.col("text")))
          .otherwise(S("---a---\nx\n## 💬 discussion ", F.col("text"))))
    return t.spread("documents").select("doc_id", T.view_markdown(md).alias("md"))


@query("md_meta_table", f"""
SELECT doc_id, {NL} || {NL} || '---' || {NL} || {NL} || '### 📋 LLM Wiki Metadata' || {NL} || {NL} || '| Key (속성) | Value (값) |' || {NL} || '| :--- | :--- |' || {NL} ||
 '| **Title (제목)** | ' || {TITLE} || ' |' || CASE WHEN lang = 'fr' THEN '' ELSE {NL} || '| **Company (회사)** | ' || source || ' |' END ||
 {NL} || '| **Document ID** | `' || doc_id || '` |' || {NL} || '| **Source (출처)** | Src x (`silver/src_x.contents`) |' ||
 {NL} || '| **URL** | [Link ↗](https://u/' || doc_id || ') |' || {NL} AS md FROM documents WHERE {TITLE} <> ''
UNION ALL SELECT doc_id, 'no title' FROM documents WHERE {TITLE} = ''""")
def md_meta_table(t):
    no = F.lit(None).cast("string")
    md = T.metadata_table(title(), F.when(F.col("lang") != "fr", F.col("source")), no, C("doc_id"),
                          F.lit("silver/src_x.contents"), no, S("https://u/", C("doc_id")), no)
    return t.spread("documents").select("doc_id", F.when(title() == "", F.lit("no title")).otherwise(md).alias("md"))


@query("safe_name", r"""
WITH x AS (SELECT p_partkey, p_name || CASE WHEN p_size > 25 THEN ' / a:b*c' ELSE '' END || repeat(' long', p_size) AS title,
   CASE WHEN p_size < 5 THEN '' ELSE p_brand || ' &amp; Co' END AS company FROM part),
 n AS (SELECT *, trim(regexp_replace(regexp_replace(replace(CASE WHEN company = '' THEN '정보 없음' ELSE company END, '&amp;', '&') || ' - ' || trim(title), '[/\\:*?"<>|]', ' ', 'g'), '\s+', ' ', 'g')) AS n FROM x)
SELECT p_partkey, trim(substr(n, 1, 80)) AS safe, substr(trim(regexp_replace(regexp_replace(title, '[\\/:*?"<>|]', '', 'g'), '\s+', ' ', 'g')), 1, 120) AS book,
 trim(regexp_replace(title, '[\\/:*?"<>|]', '_', 'g')) AS export, CASE WHEN title = '' THEN 'Untitled_Mail' ELSE substr(trim(regexp_replace(title, '[\\/*?:"<>|]', '', 'g')), 1, 100) END AS mail FROM n""")
def safe_name(t):
    name = S(F.col("p_name"), F.when(F.col("p_size") > 25, " / a:b*c").otherwise(""), F.repeat(F.lit(" long"), F.col("p_size")))
    company = F.when(F.col("p_size") < 5, "").otherwise(S(F.col("p_brand"), " &amp; Co"))
    x = t.part.select("p_partkey", name.alias("title"), company.alias("company"))
    return x.select("p_partkey", T.safe_file_name("title", "company").alias("safe"), T.book_file_name("title").alias("book"),
                    T.export_file_name("title").alias("export"), T.mail_file_name("title").alias("mail"))


_PLACES = "['Berlin, Germany', 'Greater London', '서울특별시', 'Sydney, Australia', 'Lima/Peru', '', 'São Paulo', '전라도', 'Abu Dhabi - UAE', 'Kyiv, Ukraine']"
_PLACE_LIST = ["Berlin, Germany", "Greater London", "서울특별시", "Sydney, Australia", "Lima/Peru", "", "São Paulo", "전라도",
               "Abu Dhabi - UAE", "Kyiv, Ukraine"]
_COUNTRY = "CASE " + " ".join(
    f"WHEN regexp_matches(loc, '(?i)({'|'.join(names)})') THEN '{c}'" for c, names in G.COUNTRY_ALIASES) + " END"
_WORD = "CASE " + " ".join(
    f"WHEN regexp_matches(loc, '(?i)\\b({'|'.join(names)})\\b') THEN '{c}'" for c, names in G.COUNTRY_ALIASES
    if c not in ("South Korea", "Türkiye", "Switzerland")) + " END"
_KNOWN = "(" + ", ".join(f"'{c}'" for c, _ in G.COUNTRY_ALIASES) + ")"
_LOC = f"l AS (SELECT c_custkey, {_PLACES}[c_nationkey % 10 + 1] || CASE WHEN c_acctbal < 0 THEN ' ' || n_name ELSE '' END AS loc FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_STD = f"""CASE WHEN loc IN ('', '정보 없음', 'No info') THEN 'unknown-location' ELSE coalesce({_COUNTRY},
  CASE WHEN regexp_matches(loc, '[{Q.HANGUL}]') THEN 'South Korea' END, trim(regexp_replace(loc, '[/\\\\:*?"<>|]', ' ', 'g'))) END""".replace("\\\\\\\\", "\\\\")


def places(t):
    city = F.element_at(F.array(*[F.lit(p) for p in _PLACE_LIST]), (F.col("c_nationkey") % 10 + 1).cast("int"))
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", F.concat(city, F.when(F.col("c_acctbal") < 0, S(" ", F.col("n_name"))).otherwise("")).alias("loc"))


GEO_SQL = f"WITH {_LOC} SELECT c_custkey, {_STD} AS country FROM l"


@query("geo_standardize", GEO_SQL)
def geo_standardize(t):
    return places(t).select("c_custkey", G.standardize_location("loc").alias("country"))


@query("geo_bucket", f"WITH {_LOC}, s AS (SELECT c_custkey, {_STD} AS c FROM l) SELECT c_custkey, CASE WHEN c IN {_KNOWN} THEN c ELSE 'Others' END AS geo FROM s")
def geo_bucket(t):
    return places(t).select("c_custkey", G.geo_bucket("loc").alias("geo"))


_CODES = ["kr", "US ", "GB", "xx", "", "BR", "oo", "JP", "DE", "ZZ"]


@query("country_code", "WITH m(code, name) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in G.COUNTRY_CODES.items()) + f"""),
 c AS (SELECT c_custkey, {_CODES}[c_nationkey % 10 + 1] AS code FROM customer)
SELECT c_custkey, CASE WHEN c.code = '' THEN 'Unknown' ELSE coalesce(name, upper(trim(c.code))) END AS country FROM c LEFT JOIN m ON m.code = upper(trim(c.code))""")
def country_code(t):
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("c_nationkey") % 10 + 1).cast("int"))
    return t.customer.select("c_custkey", G.country_name(code).alias("country"))


@query("fmt_scalars", r"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice * 100 AS BIGINT) AS n, CAST(l_quantity * l_partkey AS BIGINT) AS s FROM lineitem),
 y AS (SELECT *, n * CASE WHEN l_suppkey > 50 THEN 1 ELSE 1000 END AS b FROM x),
 z AS (SELECT *, CASE WHEN b >= 1073741824 THEN 3 WHEN b >= 1048576 THEN 2 WHEN b >= 1024 THEN 1 ELSE 0 END AS i FROM y)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, format('{:,}', n) AS thousands,
 CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS duration,
 CASE WHEN b = 0 THEN '0 B' ELSE regexp_replace(printf('%.2f', round(b / pow(1024.0, i), 2)), '\.?0+$', '') || ' ' || ['B', 'KB', 'MB', 'GB'][i + 1] END AS size FROM z""")
def fmt_scalars(t):
    n = (F.col("l_extendedprice") * 100).cast("decimal(20,0)").cast("bigint")
    s = (F.col("l_quantity") * F.col("l_partkey")).cast("bigint")
    b = n * F.when(F.col("l_suppkey") > 50, 1).otherwise(1000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.thousands(n).alias("thousands"),
                             T.duration_text(s).alias("duration"), T.bytes_text(b).alias("size"))


@query("mail_noise", f"""
SELECT doc_id, trim({TITLE} || ' [go there](u) ' || lang || ' &x ' || trim(text, ' ' || {NL}), ' ' || {NL}) AS md FROM documents WHERE NOT contains(text, '{{') AND NOT contains(text, '[')""")
def mail_noise(t):
    md = S("@media print {a:b}", title(), ".cls {x:y}![](i.png)[](u) [ go \r\n\n there ]( u )[Unsubscribe](z) ", F.col("lang"), "&nbsp;&x ", F.col("text"))
    d = t.spread("documents").where(~F.contains("text", F.lit("{")) & ~F.contains("text", F.lit("[")))
    return d.select("doc_id", T.mail_noise(md).alias("md"))


@query("plain_text", rf"""
WITH x AS (SELECT doc_id, '# T [' || source || '](http://x) **b** `c`' || {NL} || text AS md FROM documents),
 p AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(md, '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[*_`#-]', '', 'g'), '\s+', ' ', 'g')) AS plain FROM x)
SELECT doc_id, plain, length(plain) AS chars, 'a' || {NL} || {NL} || source AS description FROM p JOIN documents USING (doc_id)""")
def plain_text(t):
    p = T.plain_text(S("# T [", F.col("source"), "](http://x) **b** `c`\n", F.col("text")))
    desc = T.clean_description(S("a\n \n\n\n", F.col("source"), "Show more \n Show less"))
    return t.spread("documents").select("doc_id", p.alias("plain"), F.length(p).alias("chars"), desc.alias("description"))


_REFLOW = rf"""list_transform(ls, lambda x, i: CASE
   WHEN i = 1 THEN CASE WHEN trim(x) = '' THEN '' ELSE x END
   WHEN trim(x) = '' OR trim(ls[i - 1]) = '' OR regexp_matches(trim(ls[i - 1]), '[.?!:;]$') OR regexp_matches(trim(x), '^([#\-*`\[]|\d+\.)')
   THEN {NL} || CASE WHEN trim(x) = '' THEN '' ELSE x END ELSE ' ' || trim(x) END)"""


@query("md_reflow", rf"""
WITH l AS (SELECT doc_id, string_split(regexp_replace('# H' || {NL} || {NL} || {NL} || {NL} || 'a  b' || {NL} || '  c' || {NL} || '- d' || {NL} || replace(text, ', ', {NL}), '\n$', ''), {NL}) AS ls FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(array_to_string({_REFLOW}, ''), ' {{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS md FROM l""")
def md_reflow(t):
    md = S("# H\n\n\n\na  b\n  c\n- d\n", F.replace("text", F.lit(", "), F.lit("\n")))
    return t.spread("documents").select("doc_id", T.reflow_markdown(md).alias("md"))


@query("truncate_lines", f"""
WITH l AS (SELECT doc_id, string_split(replace(text, ' ', {NL}), {NL}) AS ls FROM documents)
SELECT doc_id, CASE WHEN len(ls) > 150 THEN array_to_string(ls[1:50], {NL}) || {NL} || {NL} || '... [Truncated ' || (len(ls) - 150) || ' lines of output. Full log copied to tasks/ directory] ...' || {NL} || {NL} || array_to_string(ls[len(ls) - 99:], {NL})
  ELSE array_to_string(ls, {NL}) END AS cut FROM l""")
def truncate_lines(t):
    return t.spread("documents").select("doc_id", T.truncate_lines(F.replace("text", F.lit(" "), F.lit("\n"))).alias("cut"))


@query("compact_lines", f"""
SELECT doc_id, array_to_string(list_filter(list_transform(string_split('<!-- a' || {NL} || '  ' || text || {NL} || {NL} || 'x -->', {NL}), lambda x: trim(x)),
  lambda x: x <> '' AND NOT starts_with(x, '<!--') AND NOT ends_with(x, '-->')), {NL}) AS rules FROM documents""")
def compact_lines(t):
    return t.spread("documents").select("doc_id", T.compact_lines(S("<!-- a\n  ", F.col("text"), "\n\nx -->")).alias("rules"))


@query("relativize", r"SELECT page_id, regexp_replace('see ' || url || ' in https://www.ththwh.example.org', 'https://www\.ththwh\.example\.org/?', './', 'g') AS txt FROM pages")
def relativize(t):
    txt = S("see ", F.col("url"), " in https://www.ththwh.example.org")
    return t.spread("pages").select("page_id", T.relativize(txt, "https://www.ththwh.example.org").alias("txt"))


@query("link_lint", rf"""
WITH m AS (SELECT doc_id, string_split(text || {NL} || '[a](https://x) b [c](./d) [e](FILE://f)' || {NL} || '[g](www.h)', {NL}) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS no FROM m)
SELECT doc_id, no, unnest(regexp_extract_all(line, '(?i)\[.*?\]\((?:file://|http://|https://|www\.)')) AS found FROM l""")
def link_lint(t):
    md = S(F.col("text"), "\n[a](https://x) b [c](./d) [e](FILE://f)\n[g](www.h)")
    rows = t.spread("documents").select("doc_id", F.posexplode(T.lines_of(md)).alias("no", "line"))
    return rows.select("doc_id", (F.col("no") + 1).alias("no"), F.explode(T.absolute_links("line")).alias("found"))


@query("display_name", r"""
WITH x AS (SELECT doc_id, 'silver/' || source || 'NewsFeed_' || lang || '.contents' AS c FROM documents)
SELECT doc_id, upper(substr(l, 1, 1)) || substr(l, 2) AS label, upper(substr(s, 1, 1)) || substr(s, 2) AS short FROM (SELECT *,
  regexp_replace(regexp_replace(replace(replace(c, 'silver/', ''), '.contents', ''), '([a-z])([A-Z])', '\1 \2', 'g'), '[_-]', ' ', 'g') AS l,
  replace(replace(c, '.contents', ''), 'silver/', '') AS s FROM x)""")
def display_name(t):
    c = S("silver/", F.col("source"), "NewsFeed_", F.col("lang"), ".contents")
    return t.spread("documents").select("doc_id", T.collection_label(c).alias("label"), T.dashboard_label(c).alias("short"))


@query("resource_links", f"""
SELECT doc_id, 'a (images/' || md5(source) || CASE WHEN lang = 'fr' THEN '.jpg' ELSE '.png' END || ') ' || {TITLE} || ' (images/' || md5(source) || CASE WHEN lang = 'fr' THEN '.jpg' ELSE '.png' END || ') (:/' || md5(text) || ')' AS md FROM documents""")
def resource_links(t):
    """Resource links of a document rewritten through a resource table; unknown ids stay."""
    md = S("a (:/", F.md5("source"), ") ", title(), " (:/", F.md5("source"), ") (:/", F.md5("text"), ")")
    docs = t.spread("documents").select("doc_id", "lang", md.alias("md"))
    kinds = t.spread("documents").select(F.md5("source").alias("id")).distinct()
    ext = F.when(F.col("lang") == "fr", "jpg")
    out = IM.rewrite_resources(docs.withColumn("ext", ext), "doc_id", "md", kinds, "ext")
    return out.select("doc_id", "md")


@query("natural_sort", r"""
WITH p AS (SELECT DISTINCT p_name || ' ' || p_size AS title FROM part)
SELECT title, lower(regexp_replace(title, '[0-9].*$', '')) || lpad(length(regexp_extract(title, '([0-9]+)$', 1))::VARCHAR, 10, '0') || regexp_extract(title, '([0-9]+)$', 1) AS sort_key FROM p""")
def natural_sort(t):
    """All titles with the key they sort by: digits compare by value."""
    p = t.part.select(S(F.col("p_name"), " ", C("p_size")).alias("title")).distinct()
    return p.select("title", T.natural_key("title").alias("sort_key"))


_BODY = rf"regexp_replace(regexp_replace(regexp_extract(html, '(?is)<body\b[^>]*>(.*)', 1), '{Q.INVISIBLE}|</body\s*>.*$', '', 'g'), '<[^>]*>', '', 'g')"


@query("text_preview", rf"""
SELECT page_id, substr(trim(regexp_replace({Q.decode_entities(_BODY)}, '\s+', ' ', 'g')), 1, 500) AS preview FROM pages""")
def text_preview(t):
    return t.spread("pages").select("page_id", T.body_preview("html").alias("preview"))


_IMG = f"""i AS (SELECT doc_id, '<p><img class="a" src="/a/' || doc_id || '.png"><IMG src=''data:x''><img src="//cdn.x/' || lang || '.jpg"><img src="/favicon.png">' AS html,
  {TITLE} || ' ![z](https://m.x/' || source || '.gif) ![q](rel.png)' AS md FROM documents),
 u AS (SELECT doc_id, list_distinct(list_concat(regexp_extract_all(html, '(?i)<img[^>]+src=["'']([^"'']+)["''][^>]*>', 1), regexp_extract_all(md, '(?i)!\\[.*?\\]\\((https?://[^)]+)\\)', 1))) AS l FROM i),
 e AS (SELECT doc_id, unnest(l) AS src FROM u)""".replace("\\\\", "\\")


@query("image_refs", f"""WITH {_IMG}
SELECT doc_id, src, CASE WHEN src LIKE 'data:%' THEN src WHEN src LIKE '//%' THEN 'https:' || src WHEN src LIKE '/%' THEN 'https://d.test' || src ELSE src END AS url,
  CASE WHEN contains(lower(src), 'favicon') THEN 'favicon' WHEN src LIKE 'data:%' THEN 'keep' ELSE 'download' END AS action FROM e""")
def image_refs(t):
    html = S('<p><img class="a" src="/a/', C("doc_id"), '.png"><IMG src=\'data:x\'><img src="//cdn.x/', F.col("lang"), '.jpg"><img src="/favicon.png">')
    md = S(title(), " ![z](https://m.x/", F.col("source"), ".gif) ![q](rel.png)")
    d = t.spread("documents").select("doc_id", html.alias("html"), md.alias("md"))
    return IM.image_references(d, ["doc_id"], "html", "md", F.lit("d.test")).select("doc_id", "src", "url", "action")


@query("image_rewrite", f"""
SELECT doc_id, replace({TITLE} || ' ![z](https://m.x/' || source || '.gif) https://n.x/' || lang, 'https://m.x/' || source || '.gif', '/s/' || source || '.gif')
  || {NL} || {NL} || '---' || {NL} || '### Collected Images' || {NL} || '- `https://m.x/' || source || '.gif` -> `/s/' || source || '.gif`' || {NL} AS md FROM documents""")
def image_rewrite(t):
    md = S(title(), " ![z](https://m.x/", F.col("source"), ".gif) https://n.x/", F.col("lang"))
    docs = t.spread("documents").select("doc_id", md.alias("md"))
    mapping = t.spread("documents").select("doc_id", S("https://m.x/", F.col("source"), ".gif").alias("src"), S("/s/", F.col("source"), ".gif").alias("path"))
    out = IM.rewrite_images(docs, "doc_id", "md", mapping)
    return out.select("doc_id", F.concat("md", "footer").alias("md"))


@query("jd_split", f"""
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'Job Description:' || {NL} || trim(text) WHEN lang = 'de' THEN 'Requirements' || {NL} || trim(text)
  ELSE 'short' || {NL} || 'Requirements' || {NL} || trim(text) END AS jd FROM documents WHERE NOT regexp_matches(text, '[\\r]|\\n\\n\\n')""".replace("\\\\", "\\"))
def jd_split(t):
    body = F.col("text")
    md = (F.when(F.col("lang") == "fr", S("hello\n## About Src\nwe are\nJob Description:\n", body))
          .when(F.col("lang") == "de", S("a long enough opening text\nRequirements\n", body)).otherwise(S("short\nRequirements\n", body)))
    d = t.spread("documents").where(~F.col("text").rlike(r"[\r]|\n\n\n"))
    return d.select("doc_id", T.jd_split(md, F.lit("Src")).alias("jd"))


# --- dates -----------------------------------------------------------------------------------------------

_REL = ["3 weeks ago", "2일 전", "1 month", "5 hours ago", "10 Years ago", "", "posted 4 days", "7개월 전", "soon"]
_REL_DAYS = [21, 2, 30, 0, 3650, 1, 4, 210, 1]


@query("relative_date", f"""
SELECT event_id, strftime(ts + INTERVAL 9 HOUR - to_days({_REL_DAYS}[user_id % 9 + 1]), '%Y-%m-%d %H:%M:%S') AS posted FROM events""")
def relative_date(t):
    text = F.element_at(F.array(*[F.lit(x) for x in _REL]), (F.col("user_id") % 9 + 1).cast("int"))
    return t.events.select("event_id", D.relative_date(text, F.lit("Posted 1 day ago."), "ts").alias("posted"))


@query("safe_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00')
  ELSE strftime(o_orderdate, '%Y-%m-%d 01:02:03') END AS d FROM orders""")
def safe_date(t):
    s = F.col("o_orderstatus")
    text = (F.when(s == "P", F.lit("next week")).when(s == "F", F.date_format("o_orderdate", " yyyy.MM.dd "))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'01:02:03.000'Z'")))
    return t.orders.select("o_orderkey", F.date_format(D.safe_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("d"))


@query("published_cascade", """
SELECT event_id, CASE event_type WHEN 'error' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 'view' THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 'signup' THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS published FROM events""")
def published_cascade(t):
    kind, no = F.col("event_type"), F.lit(None).cast("string")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ld = F.when(kind == "error", iso).otherwise(no)
    meta = F.when(kind == "click", F.unix_millis(F.col("ts").cast("timestamp")).cast("string")).otherwise(no)
    attr = F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd")).otherwise(F.lit("not a date"))
    text = F.when(kind == "signup", S("on ", F.date_format("ts", "yyyy. MM. dd"), " by")).otherwise(no)
    return t.events.select("event_id", F.date_format(D.published_at(ld, meta, attr, text), "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("published_fallback", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'R' THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 'A' THEN strftime(o_orderdate, '%Y-%m-%d')
  ELSE CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE '2024-02-01' END END AS published FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def published_fallback(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    body = F.when(F.col("l_linestatus") == "O", S('posted_date: "', F.date_format("l_shipdate", "yyyy-MM-dd"), '"')).otherwise("**작성일:** 정보 없음")
    p = D.published_fallback(F.lit("2024-02-01"), F.when(flag == "R", F.col("l_shipdate")), F.when(flag == "A", F.col("o_orderdate")), body=body)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", F.date_format(p, "yyyy-MM-dd").alias("published"))


@query("published_by_site", """
SELECT o_orderkey, CASE WHEN (o_orderstatus = 'F') = (o_orderpriority <> '1-URGENT') AND o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2024-02-01' END AS published FROM orders""")
def published_by_site(t):
    """Both ways of writing a date in the bodies of three sites; each counts for one site alone."""
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    site = F.when(status == "F", "linkedin").when(status == "O", "geeknews").otherwise("yozm")
    body = F.when(F.col("o_orderpriority") != "1-URGENT", S('posted_date: "', day, '"')).otherwise(S("**작성일:** ", day))
    return t.orders.select("o_orderkey", F.date_format(D.published_fallback(F.lit("2024-02-01"), body=body, site=site), "yyyy-MM-dd").alias("published"))


# --- JSON --------------------------------------------------------------------------------------------------

@query("src_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src_json(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


TOLERANT_SQL = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Unknown' ELSE 's' || CAST(json_extract(props, '$.k') AS VARCHAR) END AS site,
  CASE WHEN event_type = 'error' THEN 'oops ' || event_id ELSE 'u' END AS url, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS attempt FROM events"""


def queue_payloads(t):
    """Events as queue items, a broken text for some: ``event_id, p``."""
    bad = F.col("event_type") == "error"
    payload = F.when(bad, S("oops ", C("event_id"))).otherwise(
        S('{"site": "s', F.get_json_object("props", "$.k"), '", "url": "u", "attempt": 2}'))
    return t.events.select("event_id", payload.alias("p"))


@query("json_tolerant", TOLERANT_SQL)
def json_tolerant(t):
    rows = queue_payloads(t)
    task = J.tolerant_struct("p", "site string, url string, attempt int", site=F.lit("Unknown"), url=F.col("p"), attempt=F.lit(1))
    return rows.select("event_id", task["site"].alias("site"), task["url"].alias("url"), task["attempt"].alias("attempt"))


@query("to_array", """
SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 2 ELSE 1 END AS n, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '{"k":1}' ELSE props END AS first FROM events""")
def to_array(t):
    kind = F.col("event_type")
    v = F.when(kind == "view", S('[{"k":1}, ', F.col("props"), "]")).when(kind != "error", F.col("props"))
    a = J.as_json_array(v)
    return t.events.select("event_id", F.size(a).alias("n"), F.get(a, F.lit(0)).alias("first"))


@query("kv_map", "SELECT p_partkey, p_type AS kind, CAST(p_size AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS none FROM part")
def kv_map(t):
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    m = J.pairs_to_map(F.array(pair("kind", F.col("p_brand")), pair("size", C("p_size")), pair("kind", F.col("p_type"))))
    return t.part.select("p_partkey", F.element_at(m, "kind").alias("kind"), F.element_at(m, "size").alias("size"), F.element_at(m, "none").alias("none"))


@query("tags_categories", """
WITH x AS (SELECT p_partkey, list_filter(list_transform(string_split(p_type || ' , LLM_APPLICATION,, ' || p_brand, ','), lambda s: trim(s)), lambda s: s <> '') AS tags, p_size FROM part)
SELECT p_partkey, array_to_string(tags, '|') AS tags, CASE WHEN p_size > 25 THEN 'LLM 응용' ELSE 'LLM 응용|개발 효율성' END AS categories FROM x""")
def tags_categories(t):
    from ..operators.convert import infer_categories, split_tags
    keywords = S(F.col("p_type"), " , LLM_APPLICATION,, ", F.col("p_brand"))
    more = F.when(F.col("p_size") > 25, keywords).otherwise(S(keywords, ",DEV_EFFICIENCY"))
    return t.part.select("p_partkey", F.array_join(split_tags(keywords), "|").alias("tags"),
                         F.array_join(infer_categories(split_tags(more)), "|").alias("categories"))
