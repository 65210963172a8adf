"""Index and search queries over documents (first line = title, source = site, language = geo)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lookup as LK
from ..operators import search as SE
from ..operators import stats as ST
from ..session import cut_lineage
from .registry import query


def search_docs(t):
    """Documents as search documents; the publish day follows from the text length."""
    published = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_chars").cast("int")).cast("string")
    d = t.spread("documents").select(F.col("source").alias("site"), F.col("doc_id").alias("id"), T.first_heading_or_line("text").alias("title"),
                           F.lit(None).cast("string").alias("company_name"), F.lit("").alias("location"),
                           F.when(F.col("lang") != "es", F.col("lang")).alias("geo"), F.col("text").alias("content"),
                           F.concat(F.lit("https://d/"), "doc_id").alias("url"), published.alias("published_at"))
    return SE.search_documents(d, F.lit("2024-02-01"), F.col("published_at"))


_DOCS = """docs AS (SELECT regexp_replace(source || '_' || doc_id, '[^a-zA-Z0-9_-]', '_', 'g') AS id, source AS site, doc_id,
  CASE WHEN split_part(text, chr(10), 1) = '' THEN 'Untitled' ELSE split_part(text, chr(10), 1) END AS title, CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS location,
  CASE WHEN lang = 'es' THEN 'Unknown' ELSE lang END AS geo, text AS content, 'https://d/' || doc_id AS url,
  CAST(DATE '2024-01-01' + CAST(n_chars AS INTEGER) AS VARCHAR) AS published_at, '2024-02-01' AS updated_at FROM documents)"""
_POSTS = _DOCS + r""",
 w AS (SELECT doc_id, 0 AS field, regexp_extract_all(lower(title), '[\p{L}\p{N}]+') AS ws FROM docs
   UNION ALL SELECT doc_id, 3, regexp_extract_all(lower(geo), '[\p{L}\p{N}]+') FROM docs UNION ALL SELECT doc_id, 4, regexp_extract_all(lower(content), '[\p{L}\p{N}]+') FROM docs),
 tk AS (SELECT doc_id, field, unnest(ws) AS term, generate_subscripts(ws, 1) - 1 AS pos FROM w),
 posts AS (SELECT term, doc_id, field, count(*) AS tf, min(pos) AS first_pos FROM tk GROUP BY 1, 2, 3),
 vocab AS (SELECT term, count(*) AS df FROM posts GROUP BY 1)"""


def _ranked(words, typos):
    terms = " UNION ALL ".join(
        f"SELECT {i} AS word, term, " + (f"CASE WHEN starts_with(term, '{w}') THEN 0 ELSE levenshtein(term, '{w}') END" if typos and SE.typo_budget(w) else "0")
        + f" AS typos, CAST(term = '{w}' AS INTEGER) AS exact FROM vocab WHERE starts_with(term, '{w}')"
        + (f" OR levenshtein(term, '{w}') <= {SE.typo_budget(w)}" if typos and SE.typo_budget(w) else "")
        for i, w in enumerate(words))
    return f"""
 q AS ({terms}),
 pw AS (SELECT doc_id, word, min(typos) AS typos, min(field) AS field, max(exact) AS exact, arg_min(first_pos, (field, first_pos)) AS pos FROM posts JOIN q USING (term) GROUP BY 1, 2),
 hits AS (SELECT doc_id, count(*) AS words, sum(typos) AS typos, CASE WHEN min(field) = max(field) THEN max(pos) - min(pos) ELSE 1000000 END AS proximity,
   min(field) AS best_field, sum(exact) AS exact FROM pw GROUP BY 1 HAVING count(*) = {len(words)})"""


_ORDER = "ORDER BY words DESC, typos, proximity, best_field, published_at DESC NULLS LAST, exact DESC, doc_id"


def index(t):
    docs = search_docs(t)
    # A search reads a stored index, so the postings are written once and not per branch.
    posts = cut_lineage(SE.postings(docs))
    return docs, posts, SE.vocabulary(posts)


@query("index_docs", f"WITH {_DOCS} SELECT id, site, doc_id, title, company_name, location, geo, url, published_at, updated_at, md5(content) AS content FROM docs")
def index_docs(t):
    return search_docs(t).withColumn("content", F.md5("content"))


@query("index_stats", f"""WITH {_DOCS} SELECT '*' AS field, count(*) AS n FROM docs UNION ALL SELECT 'title', count(title) FROM docs
 UNION ALL SELECT 'company_name', 0 UNION ALL SELECT 'location', 0 UNION ALL SELECT 'geo', count(geo) FROM docs UNION ALL SELECT 'content', count(content) FROM docs""")
def index_stats(t):
    return ST.field_distribution(search_docs(t), SE.SEARCHABLE)


@query("postings", f"WITH {_POSTS} SELECT * FROM posts")
def postings(t):
    return SE.postings(search_docs(t))


@query("search_ranked", f"""WITH {_POSTS}, {_ranked(["the", "on"], False)}
SELECT doc_id, title, words, CAST(typos AS BIGINT) AS typos, proximity, best_field, CAST(exact AS BIGINT) AS exact FROM hits JOIN docs USING (doc_id) {_ORDER} LIMIT 50""")
def search_ranked(t):
    docs, posts, vocab = index(t)
    return SE.search(docs, posts, vocab, "The on", limit=50, typos=False).select(
        "doc_id", "title", "words", "typos", "proximity", "best_field", "exact")


@query("search_typo", f"""WITH {_POSTS}, {_ranked(["nding", "thened"], True)}
SELECT doc_id, words, CAST(typos AS BIGINT) AS typos, proximity, best_field, CAST(exact AS BIGINT) AS exact FROM hits JOIN docs USING (doc_id) {_ORDER} LIMIT 50""")
def search_typo(t):
    docs, posts, vocab = index(t)
    return SE.search(docs, posts, vocab, "nding thened", limit=50).select("doc_id", "words", "typos", "proximity", "best_field", "exact")


@query("search_filtered", f"""WITH {_POSTS}, {_ranked(["the"], True)}
SELECT doc_id, site, geo, published_at FROM hits JOIN docs USING (doc_id) WHERE geo = 'en' AND site = 'src3' {_ORDER} LIMIT 30 OFFSET 10""")
def search_filtered(t):
    docs, posts, vocab = index(t)
    return SE.search(docs, posts, vocab, "the", filters={"geo": "en", "site": "src3"}, offset=10).select("doc_id", "site", "geo", "published_at")


@query("search_total", f"""WITH {_POSTS}, {_ranked(["the", "of"], False)} SELECT 'the of' AS q, count(*) AS total FROM hits
UNION ALL SELECT '', count(*) FROM docs""")
def search_total(t):
    docs, posts, vocab = index(t)
    each = [SE.total_hits(docs, posts, vocab, q, typos=False).select(F.lit(q).alias("q"), "total") for q in ("the of", "")]
    return each[0].union(each[1])


@query("search_weighted", f"""WITH {_POSTS}
SELECT doc_id, CAST(sum([10, 3, 1, 1, 5][field + 1] * tf) AS BIGINT) AS score FROM posts WHERE term IN ('the', 'und', 'queaux') GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 30""")
def search_weighted(t):
    return SE.weighted_search(SE.postings(search_docs(t)), ["The", "und", "queaux"], [10, 3, 1, 1, 5])


@query("search_snippet", f"""WITH {_POSTS}, {_ranked(["the"], False)}, h AS (SELECT * FROM hits JOIN docs USING (doc_id) {_ORDER} LIMIT 30)
SELECT doc_id, '### Title: ' || title || chr(10) || 'Company: Unknown Company' || chr(10) || 'URL: ' || url || chr(10) || 'ID: ' || doc_id || chr(10) || '---' || chr(10)
  || substr(content, 1, 1000) || '...' || chr(10) || chr(10) AS text FROM h""")
def search_snippet(t):
    docs, posts, vocab = index(t)
    return SE.snippets(SE.search(docs, posts, vocab, "the", typos=False))


# --- paging ------------------------------------------------------------------------------------------

@query("paginate", "SELECT doc_id, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 30 OFFSET 60")
def paginate(t):
    return LK.page_of(t.documents.select("doc_id", "source", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], page=3).select("doc_id", "source")


@query("newest", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 30")
def newest(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return LK.page_of(rows, LK.newest(rows, "o_orderdate", "o_orderkey")).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))


@query("find_filter", """SELECT doc_id, source, lang FROM documents WHERE (lang IS NULL OR lang NOT IN ('fr', 'de')) AND n_chars >= 500""")
def find_filter(t):
    return LK.find(t.documents, [LK.missing_or_not_in("lang", ["fr", "de"]), F.col("n_chars") >= 500], ["doc_id", "source", "lang"])
