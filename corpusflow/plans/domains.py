"""Book, mail and conversation queries. TPC-H tables are relabelled as documents of these domains;
each docstring says how."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import books as B
from ..operators import convo as CV
from ..operators import mail as M
from ..session import cut_lineage
from .registry import query
from .texts import NL, S, TITLE, C, title

# --- books -----------------------------------------------------------------------------------------------


def toc(t):
    """Orders as a table of contents: customer = book, days since 1992 = page, priority = level."""
    page = F.datediff("o_orderdate", F.lit("1992-01-01")).cast("bigint")
    level = F.when(F.col("o_orderpriority") < "3", 1).when(F.col("o_orderpriority") < "5", 2).otherwise(3)
    s, k = F.col("o_orderstatus"), C("o_orderkey")
    top = F.when(s == "F", S("Part IV. Orders ", k)).when(s == "O", S("Index of ", k)).otherwise(S("part-time . ", k))
    low = F.when(s == "P", S("Foreword ", k)).otherwise(S("Chapter ", k))
    return t.orders.select(F.col("o_custkey").alias("book"), (page * 100000000 + F.col("o_orderkey")).alias("ord"), level.alias("level"),
                           F.when(level == 1, top).otherwise(low).alias("title"), page.alias("page"))


def totals(t):
    return toc(t).groupBy("book").agg((F.max("page") + 30).alias("pages"))


_TOC = """o AS (SELECT o_custkey AS book, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS page, o_orderkey AS k, o_orderstatus AS s,
   CASE WHEN o_orderpriority < '3' THEN 1 WHEN o_orderpriority < '5' THEN 2 ELSE 3 END AS level FROM orders),
 toc AS (SELECT book, page * 100000000 + k AS ord, level, page, CASE WHEN level = 1 THEN CASE s WHEN 'F' THEN 'Part IV. Orders ' || k WHEN 'O' THEN 'Index of ' || k ELSE 'part-time . ' || k END
   ELSE CASE s WHEN 'P' THEN 'Foreword ' || k ELSE 'Chapter ' || k END END AS title FROM o),
 tot AS (SELECT book, max(page) + 30 AS pages FROM toc GROUP BY 1)"""
_EXCL = "NOT regexp_matches(lower({}), 'cover|copyright|contents|index|about the author|colophon|foreword')"


@query("toc_include", f"SELECT p_partkey, {_EXCL.format('t')} AS include FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'About the AUTHORs' WHEN p_size < 20 THEN 'Contents' ELSE p_name END AS t FROM part)")
def toc_include(t):
    name = F.when(F.col("p_size") < 10, "About the AUTHORs").when(F.col("p_size") < 20, "Contents").otherwise(F.col("p_name"))
    return t.part.select("p_partkey", B.is_included(name).alias("include"))


@query("toc_ranges", f"WITH {_TOC} SELECT book, ord, title, page AS start_page, coalesce(lead(page) OVER (PARTITION BY book ORDER BY ord), pages) AS end_page FROM toc JOIN tot USING (book) WHERE level = 1")
def toc_ranges(t):
    return B.chapter_ranges(toc(t), totals(t))


@query("toc_parts", rf"""WITH {_TOC},
 tops AS (SELECT toc.*, coalesce(min(page) OVER (PARTITION BY book ORDER BY page RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), pages) AS end_page,
    contains(lower(title), 'part') AS is_part FROM toc JOIN tot USING (book) WHERE level = 1),
 kids AS (SELECT p.book, p.ord AS part_ord, k.ord, k.title, k.page, p.end_page, lead(k.page) OVER (PARTITION BY p.book, p.ord ORDER BY k.ord) AS nxt,
   CASE WHEN regexp_matches(p.title, '(Part|PART)\s+([IVXLCDM]+|\d+)') THEN 'Part ' || regexp_extract(p.title, '(Part|PART)\s+([IVXLCDM]+|\d+)', 2) ELSE trim(split_part(p.title, '.', 1)) END AS prefix
   FROM tops p JOIN toc k ON p.book = k.book AND k.level = 2 AND k.page >= p.page AND k.page < p.end_page WHERE p.is_part)
SELECT book, part_ord, ord, prefix || ' - ' || title AS title, page AS start_page, coalesce(nxt, end_page) AS end_page, {_EXCL.format('title')} AS include FROM kids
UNION ALL SELECT book, ord, ord, title, page, end_page, {_EXCL.format('title')} FROM tops WHERE NOT is_part OR (book, ord) NOT IN (SELECT (book, part_ord) FROM kids)""")
def toc_parts(t):
    return B.part_chapters(toc(t), totals(t))


@query("book_summary", f"""WITH {_TOC}, r AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY ord) AS r FROM toc WHERE level = 1)
SELECT tot.book, pages, count(r.r) AS chapters, string_agg(title || ' (p.' || page || ')', ' | ' ORDER BY r) FILTER (r <= 20) AS first FROM tot LEFT JOIN r ON r.book = tot.book GROUP BY 1, 2""")
def book_summary(t):
    return B.book_summary(toc(t), totals(t))


def page_texts(t):
    """Documents as pages: source = book, id = page; French pages open a chapter, German ones carry a
    heading without number."""
    head = F.when(F.col("lang") == "fr", S("intro\nChapter ", C("doc_id"), ". go\n")).when(F.col("lang") == "de", "PART x\n").otherwise("")
    return t.documents.select(F.col("source").alias("book"), F.col("doc_id").alias("page"), S(head, F.col("text")).alias("text"))


@query("chapter_detect", """
WITH p AS (SELECT source AS book, doc_id AS page, lang FROM documents WHERE lang IN ('fr', 'de')), tot AS (SELECT source AS book, max(doc_id) + 1 AS pages FROM documents GROUP BY 1),
 n AS (SELECT *, lead(page) OVER (PARTITION BY book ORDER BY page) AS nxt FROM p)
SELECT book, 'Chapter ' || page || '.' AS title, page AS start_page, coalesce(nxt, pages) AS end_page FROM n JOIN tot USING (book) WHERE lang = 'fr'""")
def chapter_detect(t):
    pages = page_texts(t)
    return B.detect_chapters(pages, pages.groupBy("book").agg((F.max("page") + 1).alias("pages")))


@query("toc_offset", f"""
WITH c AS (SELECT doc_id, trim(lower(substr({TITLE}, 1, 40))) AS key, doc_id + CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN -2 WHEN 'es' THEN 9 ELSE 0 END AS start_page FROM documents)
SELECT c.doc_id, coalesce(min(d.doc_id - start_page), 0) AS offset FROM c LEFT JOIN documents d ON d.doc_id BETWEEN start_page - 2 AND start_page + 3 AND contains(lower(d.text), key) GROUP BY 1""")
def toc_offset(t):
    """Every document is a page of one book and a chapter whose start page is off by its language."""
    shift = F.when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", -2).when(F.col("lang") == "es", 9).otherwise(0)
    chapters = t.documents.select("doc_id", F.lit("all").alias("book"), title().alias("title"), (F.col("doc_id") + shift).alias("start_page"))
    pages = t.documents.select(F.lit("all").alias("book"), F.col("doc_id").alias("page"), "text")
    return B.title_offsets(chapters, pages, ["doc_id"])


@query("range_clamp", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) - 5 AS start_page, l_linenumber * 8 AS end_page FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, greatest(start_page - 1, 0) AS from_page, least(end_page - 1, 39) AS to_page FROM x WHERE greatest(start_page - 1, 0) <= least(end_page - 1, 39)""")
def range_clamp(t):
    """Lineitem as chapter ranges of books with 40 pages."""
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity").cast("int") - 5).alias("start_page"),
                          (F.col("l_linenumber") * 8).alias("end_page"), F.lit(40).alias("pages"))
    return B.clamp_ranges(x).select("l_orderkey", "l_linenumber", "l_partkey", "from_page", "to_page")


def spans(t):
    """Lineitem as text spans: supplier = book, order = page, line number = block, part = line."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("book"), F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("block"), F.col("l_partkey").alias("line"),
        F.datediff("l_shipdate", F.lit("1992-01-01")).alias("span"), F.round(F.col("l_discount") * 10, 0).alias("x"), F.col("l_tax").alias("y"),
        F.col("l_quantity").alias("size"), F.when(F.col("l_returnflag") == "R", 20).otherwise(4).alias("flags"),
        S(" ", F.col("l_linestatus"), C("l_linenumber"), " ").alias("text"))


_SPANS = """sp AS (SELECT l_suppkey AS book, l_orderkey AS page, l_linenumber AS block, l_partkey AS line, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS span,
   round(l_discount * 10, 0) AS x, l_tax AS y, l_quantity AS size, CASE WHEN l_returnflag = 'R' THEN 20 ELSE 4 END AS flags, ' ' || l_linestatus || l_linenumber || ' ' AS text FROM lineitem)"""


@query("upper_median", f"""WITH {_SPANS}, m AS (SELECT page, list_sort(list(size)) AS s FROM sp GROUP BY 1)
SELECT page, s[len(s) // 2 + 1] AS median_size FROM m""")
def upper_median(t):
    one = spans(t).withColumn("book", F.lit(1))
    return B.page_medians(one).select("page", "median_size")


@query("body_font", f"""WITH {_SPANS}, b AS (SELECT DISTINCT book FROM sp), m AS (SELECT book, list_sort(list(size)) AS s FROM sp WHERE page IN (10, 30, 50, 80, 100) AND size > 8 AND size < 16 GROUP BY 1)
SELECT book, coalesce(s[len(s) // 2 + 1], 11.0) AS body_size FROM b LEFT JOIN m USING (book)""")
def body_font(t):
    return B.body_font(spans(t), spans(t))


@query("span_dedupe", f"""WITH {_SPANS}
SELECT page, round(x, 1) AS x, round(y, 1) AS y, trim(text) AS text, min((block, line, span)).block AS block, min((block, line, span)).line AS line, min((block, line, span)).span AS span
FROM (SELECT *, {{'block': block, 'line': line, 'span': span}} AS z FROM sp) GROUP BY 1, 2, 3, 4""".replace("min((block, line, span))", "min(z)"))
def span_dedupe(t):
    one = spans(t).withColumn("book", F.lit(1))
    return B.dedupe_spans(one).select("page", F.round("x", 1).alias("x"), F.round("y", 1).alias("y"), F.trim("text").alias("text"), "block", "line", "span")


_BLOCKS = f"""{_SPANS}, ln AS (SELECT page, block, line, trim(string_agg(text, '' ORDER BY span, flags)) AS t, sum(size) AS s, count(*) AS n, max(flags) = 20 AS bold FROM sp GROUP BY 1, 2, 3),
 bl AS (SELECT page, block, string_agg(t, ' ' ORDER BY line) AS text, sum(s) / sum(n) AS avg_size, bool_or(bold) AS bold FROM ln WHERE t <> '' GROUP BY 1, 2)"""


@query("block_text", f"WITH {_BLOCKS} SELECT page, block, text, round(avg_size, 4) AS avg_size, bold FROM bl")
def block_text(t):
    return B.block_texts(spans(t).withColumn("book", F.lit(1))).select("page", "block", "text", F.round("avg_size", 4).alias("avg_size"), "bold")


@query("block_class", f"""WITH {_BLOCKS}, m AS (SELECT page, list_sort(list(size)) AS l FROM sp GROUP BY 1), md AS (SELECT page, l[len(l) // 2 + 1] * 1.25 AS lim FROM m)
SELECT page, block, CASE WHEN avg_size >= lim * 1.5 THEN 'h1' WHEN avg_size >= lim THEN 'h2' WHEN bold THEN 'strong' ELSE 'p' END AS tag FROM bl JOIN md USING (page)""")
def block_class(t):
    one = spans(t).withColumn("book", F.lit(1))
    return B.classify_blocks(B.block_texts(one), B.page_medians(one)).select("page", "block", "tag")


@query("chapter_records", r"""
WITH f AS (SELECT p_partkey, p_brand AS book, CASE WHEN p_size < 20 THEN 'chapter ' || p_size || '. ' || p_name || '.md' WHEN p_size < 35 THEN p_size || ' ' || p_name || '.md' ELSE p_name || '.md' END AS file FROM part)
SELECT p_partkey, regexp_replace(file, '\.md$', '') AS title, coalesce(TRY_CAST(nullif(regexp_extract(file, '(?:chapter )?(\d+)', 1), '') AS INTEGER), 0) AS chapter_index,
  md5(book || '_' || regexp_replace(file, '\.md$', '')) AS id FROM f""")
def chapter_records(t):
    size, name = F.col("p_size"), F.col("p_name")
    file = F.when(size < 20, S("chapter ", C("p_size"), ". ", name, ".md")).when(size < 35, S(C("p_size"), " ", name, ".md")).otherwise(S(name, ".md"))
    f = t.part.select("p_partkey", F.col("p_brand").alias("book"), file.alias("file"))
    return B.chapter_records(f, "book", "file").select("p_partkey", "title", "chapter_index", "id")


@query("book_index", r"""
WITH c AS (SELECT DISTINCT source AS book, 'Ch ' || n_chars || '/' || lang AS title FROM documents), b AS (SELECT DISTINCT book FROM c)
SELECT book, 0 AS section, '# 📚 ' || book AS line FROM b UNION ALL SELECT book, 0, '' FROM b UNION ALL SELECT book, 0, '## 📑 Chapters' FROM b UNION ALL SELECT book, 0, '' FROM b
UNION ALL SELECT book, 1, '- [' || title || '](./' || replace(title, '/', '_') || '.md)' FROM c""")
def book_index(t):
    c = t.documents.select(F.col("source").alias("book"), S("Ch ", C("n_chars"), "/", F.col("lang")).alias("title")).distinct()
    return B.index_lines(c).select("book", "section", "line")


@query("strip_inline_images", rf"""
WITH x AS (SELECT page_id, '<img a="1" src="data:image/jpeg;base64,' || to_base64(encode(url)) || '"><div class="page-separator">Page 2</div>' || html AS h FROM pages)
SELECT page_id, md5(regexp_replace(regexp_replace(h, '(?is)<(?:style|script)\b[^>]*>.*?</(?:style|script)\s*>|<div[^>]*class=["'']page-separator["''][^>]*>.*?</div>', '', 'g'), '(?is)(<img[^>]*src=["''])\s*data:image/[^"'']*(["''])', '\1images/inline\2', 'g')) AS clean,
  'jpeg' AS ext, octet_length(encode((SELECT p.url FROM pages p WHERE p.page_id = x.page_id))) AS bytes FROM x""")
def strip_inline_images(t):
    x = t.pages.select("page_id", S('<img a="1" src="data:image/jpeg;base64,', F.base64(F.encode("url", "UTF-8")), '"><div class="page-separator">Page 2</div>', F.col("html")).alias("h"))
    clean = x.select("page_id", F.md5(B.strip_inline_images("h")).alias("clean"))
    return clean.join(B.inline_images(x, ["page_id"], "h").drop("pos"), "page_id")


# --- mail ------------------------------------------------------------------------------------------------

@query("mail_kst", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Unknown-Date' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+09:00') END AS iso, CASE WHEN event_type = 'error' THEN 'Unknown-Date' ELSE strftime(ts + INTERVAL 9 HOUR, '%Y-%m') END AS month,
 CASE WHEN event_type = 'error' THEN 'Unknown-Date' ELSE strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d_%H-%M-%S') END AS stamp FROM events""")
def mail_kst(t):
    return t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts")).select("event_id", D.mail_stamps("ts")["iso"].alias("iso"), D.mail_stamps("ts")["month"].alias("month"), D.mail_stamps("ts")["stamp"].alias("stamp"))


_MAIL = """m AS (SELECT event_id, ts, 'User ' || user_id || ' <U' || user_id || '@' || event_type || '.mail.example.com>' AS sender, CASE event_type WHEN 'view' THEN '' ELSE 'U' || user_id || '@' || event_type || '.example.com' END AS addr FROM events)"""


def mail(t):
    """Events as mail headers: user = sender, type = host."""
    u = C("user_id")
    return t.events.select("event_id", "ts", S("User ", u, " <U", u, "@", F.col("event_type"), ".mail.example.com>").alias("sender"),
                           F.when(F.col("event_type") != "view", S("U", u, "@", F.col("event_type"), ".example.com")).otherwise("").alias("addr"))


@query("mail_uid", f"WITH {_MAIL} SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y%m%d_%H%M%S') || '_' || substr(md5(CASE WHEN addr = '' THEN 'unknown' ELSE lower(addr) END), 1, 8) AS uid FROM m")
def mail_uid(t):
    return mail(t).select("event_id", D.mail_uid("ts", "addr").alias("uid"))


@query("mail_tag", "SELECT page_id, 'from/' || split_part(h, '.', -2) AS tag, 'from/unknown' AS none FROM (SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS h FROM pages)")
def mail_tag(t):
    sender = S("x <a@", F.regexp_extract("url", "://([^/?#]+)", 1), ">")
    return t.pages.select("page_id", M.sender_tag(sender).alias("tag"), M.sender_tag(F.lit("nobody")).alias("none"))


@query("mail_label", """
WITH l AS (SELECT doc_id, CASE lang WHEN 'fr' THEN '[Gmail]/All Mail' WHEN 'de' THEN '[gmail]/' || source || ' Box' ELSE source END AS label FROM documents),
 a AS (SELECT doc_id, lower(replace(regexp_replace(label, '(?i)^\\[Gmail\\]/', ''), ' ', '_')) AS alias FROM l) SELECT doc_id, alias FROM a WHERE alias NOT IN ('all_mail', 'all_mails', 'gmail')""".replace("\\\\", "\\"))
def mail_label(t):
    label = F.when(F.col("lang") == "fr", "[Gmail]/All Mail").when(F.col("lang") == "de", S("[gmail]/", F.col("source"), " Box")).otherwise(F.col("source"))
    return M.synced_labels(t.documents.select("doc_id", label.alias("label"))).select("doc_id", "alias")


@query("mail_index", """
WITH p AS (SELECT 'inbox/u' || user_id || '/' || event_id || '_subject_' || CASE event_type WHEN 'view' THEN 'short' ELSE substr(md5(CAST(user_id AS VARCHAR)), 1, 12) END AS path FROM events),
 i AS (SELECT regexp_extract(path, '([^_]*)$', 1) AS uid, path FROM p) SELECT uid, max(path) AS path, 'index' AS kind FROM i WHERE length(uid) >= 8 GROUP BY 1
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), '', 'fetch' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def mail_index(t):
    """Index of exported folders, and the orders (as mail) that have no lineitem (as export)."""
    uid = F.when(F.col("event_type") == "view", "short").otherwise(F.substring(F.md5(C("user_id")), 1, 12))
    paths = t.events.select(S("inbox/u", C("user_id"), "/", C("event_id"), "_subject_", uid).alias("path"))
    fetch = M.not_exported(t.orders.select(C("o_orderkey").alias("uid"), F.col("o_orderdate").alias("ts")), t.lineitem.select(C("l_orderkey").alias("uid")))
    return M.mail_index(paths).withColumn("kind", F.lit("index")).unionByName(fetch.select("uid", F.lit("").alias("path"), F.lit("fetch").alias("kind")))


@query("mail_record", f"""
WITH x AS (SELECT conv_id, turn, role, '**' || role || '** [](x)' || trim(text, ' ' || {NL}) AS md FROM conversations), b AS (SELECT *, trim(replace(md, '[](x)', ''), ' ' || {NL}) AS body FROM x)
SELECT conv_id, turn, CASE role WHEN 'system' THEN 'No Subject' ELSE role END AS title, 'from/' || role AS tag, length(body) AS character_count,
  trim(regexp_replace(regexp_replace(body, '[*_`#-]', '', 'g'), '\\s+', ' ', 'g')) AS plain_text, 'a b.txt,application/octet-stream,3' AS files FROM b""".replace("\\\\", "\\"))
def mail_record(t):
    """Conversation turns as mail; the role is subject and sender domain."""
    att = F.array(F.struct(F.lit("a/ b.txt").alias("filename"), F.lit("").alias("content_type"), F.lit(3).cast("bigint").alias("size")))
    m = t.conversations.select(
        S(C("conv_id"), "-", C("turn")).alias("uid"), "conv_id", "turn", F.lit("2024-01-01").cast("timestamp").alias("ts"),
        S("a@", F.col("role"), ".com").alias("sender"), F.when(F.col("role") != "system", F.col("role")).alias("subject"),
        S("**", F.col("role"), "** [](x)", F.col("text")).alias("body_md"), F.lit("inbox").alias("folder"), F.lit(None).cast("string").alias("message_id"),
        F.lit(None).cast("string").alias("in_reply_to"), F.lit(None).cast("array<string>").alias("refs"), att.alias("attachments"))
    r = M.mail_records(m)
    files = F.array_join(F.transform("attachments", lambda a: F.concat_ws(",", a["filename"], a["content_type"], a["size"].cast("string"))), ";")
    return r.select(F.substring_index("id", "-", 1).cast("bigint").alias("conv_id"), F.substring_index("id", "-", -1).cast("bigint").alias("turn"),
                    "title", F.col("tags")[1].alias("tag"), "character_count", "plain_text", files.alias("files"))


# --- conversations ------------------------------------------------------------------------------------------

def conv_messages(t):
    return t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("step"), "role", F.col("text").alias("content"))


_TURNS = """m AS (SELECT *, count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn) AS tn FROM conversations WHERE role IN ('user', 'assistant')),
 tr AS (SELECT conv_id AS session_id, tn AS turn, coalesce(max(turn) FILTER (role = 'user'), min(turn) - 1) AS user_step, coalesce(trim(arg_max(text, turn) FILTER (role = 'user'), ' ' || chr(10)), 'N/A') AS request,
   coalesce(trim(arg_max(text, turn) FILTER (role = 'assistant'), ' ' || chr(10)), 'N/A') AS answer FROM m GROUP BY 1, 2)"""


@query("turns", f"WITH {_TURNS} SELECT * FROM tr")
def turns(t):
    return CV.turns(conv_messages(t))


@query("turn_summary", f"""WITH {_TURNS} SELECT session_id, turn, coalesce(nullif(substr(split_part(request, chr(10), 1), 1, 60), ''), 'Turn ' || turn) AS summary,
  CASE WHEN answer <> 'N/A' THEN '## Learnings' || chr(10) || answer ELSE 'N/A' END AS learnings FROM tr""")
def turn_summary(t):
    rows = CV.turns(conv_messages(t))
    planted = F.when(F.col("answer") != "N/A", S("done\n## Learnings\n", F.col("answer"))).otherwise(F.col("answer"))
    return CV.turn_summaries(rows.withColumn("answer", planted)).select("session_id", "turn", "summary", "learnings")


def _with_calls(t):
    """Assistant messages get calls by the words they hold."""
    c = F.col("text")
    call = lambda name, args: F.struct(F.lit(name).alias("name"), F.lit(args).alias("args"))
    options = F.array_compact(F.array(
        F.when(F.contains(c, F.lit(" the ")), call("run_command", '{"CommandLine": "git commit -m x"}')),
        F.when(F.contains(c, F.lit("que")), call("edit", '{"TargetFile": "/ws/src/database/mongo.ts"}')),
        F.when(F.contains(c, F.lit("der")), call("edit", '{"AbsolutePath": "/ws/lib/a.js"}')),
        F.when(F.contains(c, F.lit("los")), call("edit", '{"TargetFile": "/other/.agents/x.md"}'))))
    return t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("step"), "role", F.col("text").alias("content"),
                                  F.when(F.col("role") == "assistant", options).alias("tool_calls"))


@query("turn_category", f"""WITH {_TURNS}, a AS (SELECT session_id, turn, arg_max(text, m.turn) FILTER (role = 'assistant') AS x FROM m, tr WHERE m.conv_id = tr.session_id AND m.tn = tr.turn GROUP BY 1, 2)
SELECT session_id, turn, CASE WHEN contains(x, ' the ') THEN 'Git/Commit' WHEN contains(x, 'que') THEN 'DB/Migration' WHEN contains(x, 'der') THEN 'Refactor' ELSE 'General' END AS category,
 CASE WHEN contains(x, ' the ') THEN '#general' WHEN contains(x, 'que') THEN '#db #migration' WHEN contains(x, 'der') THEN '#refactor' ELSE '#general' END AS tags,
 concat_ws(',', CASE WHEN contains(x, 'que') THEN 'src/database/mongo.ts' END, CASE WHEN contains(x, 'der') THEN 'lib/a.js' END) AS files FROM a""".replace(
    "session_id, turn, arg_max", "tr.session_id, tr.turn, arg_max"))
def turn_category(t):
    rows = CV.turn_categories(CV.turns(_with_calls(t)), "/ws")
    return rows.select("session_id", "turn", "category", "tags", F.array_join("files", ",").alias("files"))


@query("transcript_md", """
SELECT conv_id AS session_id, CAST(floor(turn / 2) AS BIGINT) AS part, string_agg(chr(10) || '### [Step ' || turn || '] ' || CASE role WHEN 'user' THEN '🗣️ User' ELSE '🤖 Agent' END || chr(10) ||
  CASE WHEN text <> '' THEN chr(10) || trim(text, ' ' || chr(10)) || chr(10) ELSE '' END, '' ORDER BY turn) AS markdown FROM conversations GROUP BY 1, 2""")
def transcript_md(t):
    return CV.transcript_parts(conv_messages(t), "/ws", part_size=2)


_USAGE = """u AS (SELECT c_custkey AS session_id, count(conv_id) AS steps, CAST(coalesce(sum(octet_length(encode(text))), 0) AS BIGINT) AS bytes,
   c_nationkey AS tokens_in, c_acctbal AS cost FROM customer LEFT JOIN conversations ON conv_id = c_custkey GROUP BY c_custkey, c_nationkey, c_acctbal)"""


def usage(t):
    """Customers as sessions of the conversations with the same number."""
    s = t.customer.select(F.col("c_custkey").alias("session_id"), F.col("c_custkey").alias("updated"), F.col("c_nationkey").alias("tokens_in"),
                          F.lit(None).cast("int").alias("tokens_out"), F.lit(0).alias("tokens_reasoning"), F.col("c_acctbal").alias("cost"))
    return CV.session_usage(conv_messages(t), s)


@query("session_usage", f"WITH {_USAGE} SELECT session_id, steps, bytes, tokens_in, 0 AS tokens_out, cost FROM u")
def session_usage(t):
    return usage(t).select("session_id", "steps", "bytes", "tokens_in", "tokens_out", "cost")


@query("latest_sessions", f"WITH {_USAGE} SELECT session_id, steps FROM u ORDER BY session_id DESC LIMIT 5")
def latest_sessions(t):
    return CV.latest_sessions(usage(t)).select("session_id", "steps")


def steps(t):
    """Events as a step log: user = session, type = step type; clicks plan two calls."""
    kind, u = F.col("event_type"), C("event_id")
    kind_name = (F.when(kind == "view", "USER_INPUT").when(kind == "click", "PLANNER_RESPONSE").when(kind == "error", "SYSTEM_MESSAGE").otherwise("RUN"))
    content = (F.when(kind == "error", S("task-", C("user_id"), " finished with result: r", u))
               .when(kind == "purchase", S("Task id: task id: task-", C("user_id"), "\nTask Description: d", u)).when(kind == "signup", S("out ", u)).otherwise(S("text ", u)))
    call = F.struct(F.lit("run_command").alias("name"), S('{"n":', u, "}").alias("args"))
    call2 = F.struct(F.lit("").alias("name"), F.lit("{}").alias("args"))
    calls = F.when(kind == "click", F.array(call, call2))
    rec = F.to_json(F.struct(kind_name.alias("type"), F.lit("X").alias("source"), content.alias("content"), calls.alias("tool_calls")))
    lines = t.events.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("line_no"), rec.alias("line"))
    bad = t.events.select("user_id", F.col("event_id"), F.lit("{broken"))
    return CV.parse_steps(lines.union(bad))


_STEPS = """st AS (SELECT user_id AS session_id, event_id AS line_no, event_type, CASE event_type WHEN 'view' THEN 'user' WHEN 'click' THEN 'assistant' WHEN 'error' THEN 'system' ELSE 'result' END AS kind,
  CASE event_type WHEN 'error' THEN 'task-' || user_id || ' finished with result: r' || event_id WHEN 'purchase' THEN 'Task id: task id: task-' || user_id || chr(10) || 'Task Description: d' || event_id WHEN 'signup' THEN 'out ' || event_id ELSE 'text ' || event_id END AS content FROM events),
 an AS (SELECT *, max(CASE WHEN kind IN ('user', 'assistant') THEN line_no END) OVER w AS opener FROM st WINDOW w AS (PARTITION BY session_id ORDER BY line_no)),
 rs AS (SELECT session_id, opener, content, row_number() OVER (PARTITION BY session_id, opener ORDER BY line_no) AS call_no FROM an WHERE kind = 'result' AND opener IS NOT NULL),
 cl AS (SELECT session_id, line_no, unnest([1, 2]) AS call_no FROM st WHERE kind = 'assistant'),
 pr AS (SELECT cl.session_id, cl.line_no, cl.call_no, CASE cl.call_no WHEN 1 THEN 'run_command' ELSE 'unknown' END AS name, rs.content AS result FROM cl LEFT JOIN rs ON rs.session_id = cl.session_id AND rs.opener = cl.line_no AND rs.call_no = cl.call_no)"""


@query("src_jsonl", f"WITH {_STEPS} SELECT session_id, line_no, content FROM st")
def src_jsonl(t):
    return steps(t).select("session_id", "line_no", "content")


@query("messages", f"WITH {_STEPS} SELECT session_id, line_no, row_number() OVER (PARTITION BY session_id ORDER BY line_no) - 1 AS step, kind AS role, content FROM st WHERE kind IN ('user', 'assistant')")
def messages(t):
    return CV.messages(steps(t)).drop("tool_calls")


@query("tool_pairing", f"WITH {_STEPS} SELECT * FROM pr")
def tool_pairing(t):
    # A step log is parsed once and stored; the pairing reads the stored steps several times.
    return CV.pair_results(cut_lineage(steps(t), "steps")).drop("args")


TASK_ATTACH_SQL = f"""WITH {_STEPS}, dn AS (SELECT session_id, max(line_no) AS d FROM st WHERE kind = 'system' GROUP BY 1)
SELECT pr.session_id, line_no, call_no, CASE WHEN name = 'run_command' AND contains(result, 'task-') AND d > line_no THEN '[Background Task task-' || pr.session_id || ' finished]' || chr(10) || 'r' || d ELSE result END AS result FROM pr LEFT JOIN dn USING (session_id)"""


@query("task_attach", TASK_ATTACH_SQL)
def task_attach(t):
    st = cut_lineage(steps(t), "steps")
    return CV.attach_tasks(CV.pair_results(st), st).select("session_id", "line_no", "call_no", "result")


@query("task_state", """
WITH r AS (SELECT user_id AS session_id, event_id AS o, event_type FROM events WHERE event_type IN ('purchase', 'error')),
 s AS (SELECT session_id, max(o) FILTER (event_type = 'purchase') AS launch, max(o) FILTER (event_type = 'error') AS stop FROM r GROUP BY 1)
SELECT session_id, 'task-' || session_id AS task_id, 'd' || launch AS command, launch AS started, CASE WHEN stop > launch THEN 'Completed' ELSE 'Running' END AS status, 'N/A' AS log FROM s WHERE launch IS NOT NULL""")
def task_state(t):
    """Purchases launch the user's task, errors finish it."""
    r = F.when(F.col("event_type") == "purchase", S("task id: task-", C("user_id"), "\nTask Description: d", C("event_id"))).otherwise(
        S('Task id "task-', C("user_id"), '" finished with result'))
    rows = t.events.where(F.col("event_type").isin("purchase", "error")).select(F.col("user_id").alias("session_id"), "event_id", r.alias("result"))
    return CV.task_states(rows, "event_id")


@query("session_numbering", """
WITH x AS (SELECT event_id, date_trunc('minute', ts) + to_milliseconds(event_id % 1000 // 500 * 100) AS c FROM events),
 r AS (SELECT *, strftime(c, '%Y-%m-%dT%H%M%S') AS date_dir, row_number() OVER (PARTITION BY date_trunc('second', c) ORDER BY c, event_id) AS n FROM x)
SELECT event_id, date_dir, lpad(CAST(n AS VARCHAR), 4, '0') AS seq, lpad(CAST(n AS VARCHAR), 4, '0') || '-' || event_id AS tag FROM r""")
def session_numbering(t):
    """Event minutes as creation seconds, some of them 100 ms later."""
    late = F.floor((F.col("event_id") % 1000) / 500) * 100
    created = F.timestamp_millis(F.unix_millis(F.date_trunc("minute", F.col("ts").cast("timestamp"))) + late)
    return CV.session_numbers(t.events.select("event_id", created.alias("created")), "created", "event_id")


@query("src_session_parts", f"""
SELECT conv_id AS session_id, turn AS message_id, role, array_to_string(list_filter(string_split(text, {NL}), lambda x: x <> ''), {NL}) AS content, CASE WHEN role = 'assistant' THEN 'unknown:{{}}:o' ELSE '' END AS calls FROM conversations""")
def src_session_parts(t):
    """Conversation lines as message parts; assistant messages also hold one tool part."""
    no = F.lit(None).cast("string")
    lines = t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("message_id"), "role", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    part = lambda rows, kind, text, tool, out: rows.select("session_id", "message_id", "ord", F.lit(kind).alias("type"), text.alias("text"), tool.alias("tool"), no.alias("input"), out.alias("output"))
    tools = t.conversations.where("role = 'assistant'").select(F.col("conv_id").alias("session_id"), F.col("turn").alias("message_id"), F.lit(-1).alias("ord"))
    parts = part(lines, "text", F.col("text"), no, no).union(part(tools, "tool", no, no, F.lit("o")))
    msgs = t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("message_id"), "role", F.lit(None).cast("string").alias("content"))
    out = CV.join_parts(msgs.select("session_id").distinct(), msgs, parts)
    calls = F.array_join(F.transform("tool_calls", lambda c: F.concat_ws(":", c["name"], c["args"], c["result"])), ",")
    return out.select("session_id", "message_id", "role", "content", calls.alias("calls"))
