"""Search documents, inverted index, ranked and weighted search.

The index is a postings table ``(term, doc_id, field, tf, first_pos)``. A query joins its few terms
against it; documents are never scanned by a query. Ranking follows the public rule order words,
typo, proximity, attribute, sort, exactness; proximity is the distance between the first positions
of the query words in one field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import first_filled
from .upsert import index_key

# Searchable fields in ranking order, filterable and sortable fields.
SEARCHABLE = ["title", "company_name", "location", "geo", "content"]
FILTERABLE = ["site", "geo", "location"]
SORTABLE = ["published_at", "updated_at"]
# Word lengths from which one and two typos are forgiven.
ONE_TYPO, TWO_TYPOS = 5, 9
POSTINGS_BYTES = 8 << 20       # bytes of text whose words a task counts at a time
TERM_ROWS = 250_000            # postings that a task takes when they meet query terms

_TOKEN = r"([\p{L}\p{N}]+)"


def tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(_TOKEN), F.lit(1))


def search_documents(silver: DataFrame, run_ts: Column, published: Column) -> DataFrame:
    """Ten-field projection of silver rows with a composite id."""
    opt = lambda c: F.col(c) if c in silver.columns else F.lit(None).cast("string")
    return silver.select(
        index_key(F.concat("site", F.lit("_"), "id")).alias("id"), F.col("site"), F.col("id").alias("doc_id"),
        first_filled(opt("title"), opt("job_title"), F.lit("Untitled")).alias("title"),
        F.nullif(opt("company_name"), F.lit("")).alias("company_name"), F.nullif(opt("location"), F.lit("")).alias("location"),
        first_filled(opt("geo"), F.lit("Unknown")).alias("geo"),
        F.coalesce(first_filled(opt("description"), opt("markdown"), opt("content")), F.lit("")).alias("content"),
        F.nullif(opt("url"), F.lit("")).alias("url"), published.alias("published_at"),
        F.coalesce(silver["updated_at"] if "updated_at" in silver.columns else F.lit(None), run_ts).alias("updated_at"))


def postings(docs: DataFrame, doc_id: str = "doc_id", fields: list[str] | None = None) -> DataFrame:
    """One row per (term, document, field) with term count and first position.

    The texts are partitioned by document first. The count per (document, field, term) then needs no
    further shuffle, and a text is smaller than the token rows it becomes. No task ever gathers a
    term, so a word that is in every document does no harm. The number of partitions follows the bytes of the
    texts, since the words counted by a task fill many times the bytes that arrive.
    """
    fields = [f for f in (fields or SEARCHABLE) if f in docs.columns]
    texts = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(f).cast("string").alias(f) for f in fields])
    size = texts.agg(F.sum(sum((F.coalesce(F.octet_length(f), F.lit(0)).cast("bigint") for f in fields), F.lit(0)))).first()[0] or 0
    texts = texts.repartition(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // POSTINGS_BYTES)), "doc_id")
    one = F.array(*[F.struct(F.lit(i).alias("field"), F.col(f).alias("text")) for i, f in enumerate(fields)])
    rows = texts.select("doc_id", F.explode(one).alias("f")).where("f.text IS NOT NULL")
    words = rows.select("doc_id", F.col("f.field").alias("field"), F.posexplode(tokens("f.text")).alias("pos", "term"))
    counts = words.groupBy("doc_id", "field", "term").agg(F.count("*").alias("tf"), F.min("pos").alias("first_pos"))
    return counts.select("term", "doc_id", "field", "tf", "first_pos")


def vocabulary(posts: DataFrame) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("df"))


def typo_budget(word: str) -> int:
    return 2 if len(word) >= TWO_TYPOS else 1 if len(word) >= ONE_TYPO else 0


def expand_query(vocab: DataFrame, words: list[str], typos: bool = True) -> DataFrame:
    """Vocabulary terms that answer each query word: exact, as a prefix of the term, or
    within the typo budget of its length: ``word, term, typos, exact``."""
    parts = []
    for i, w in enumerate(words):
        answers, typo = _answers(w, typos)
        parts.append(vocab.where(answers).select(
            F.lit(i).alias("word"), "term", typo.alias("typos"), (F.col("term") == w).cast("int").alias("exact")))
    return reduce(DataFrame.union, parts)


def _answers(word: str, typos: bool) -> tuple[Column, Column]:
    """Does ``term`` answer a query word, and with how many typos?"""
    budget = typo_budget(word) if typos else 0
    prefix = F.startswith("term", F.lit(word))
    if not budget:
        return prefix, F.lit(0)
    distance = F.levenshtein(F.col("term"), F.lit(word), budget)
    near = (F.abs(F.length("term") - len(word)) <= budget) & (distance >= 0)
    return prefix | near, F.when(prefix, 0).otherwise(distance)


def with_terms(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings joined with query terms, in partitions of about ``TERM_ROWS`` postings by document. All postings of a term
    would meet in one task, so those of a term with more go in parts by document, and the term to each part. The driver
    sees only such terms, at most one per ``TERM_ROWS`` postings."""
    each = posts.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n"))
    size, many = each.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > TERM_ROWS, F.struct("term", "n")))).first()
    tasks = max(posts.sparkSession.sparkContext.defaultParallelism, -(-(size or 0) // TERM_ROWS))
    keys = ["term"]
    if many:
        parts = -(-max(r["n"] for r in many) // TERM_ROWS)
        often = F.col("term").isin([r["term"] for r in many])
        posts = posts.withColumn("_part", F.when(often, F.pmod(F.xxhash64("doc_id"), F.lit(parts))).otherwise(0))
        terms = terms.withColumn("_part", F.explode(F.when(often, F.expr(f"sequence(0L, {parts - 1}L)")).otherwise(F.expr("array(0L)"))))
        keys = ["term", "_part"]
    return posts.repartition(tasks, *keys).join(terms, keys).drop("_part").repartition(tasks, "doc_id")


def match_documents(posts: DataFrame, vocab: DataFrame, query: str, typos: bool = True) -> DataFrame:
    """Documents that hold every query word, with the ranking values: ``doc_id, words, typos,
    proximity, best_field, exact``."""
    words = list(dict.fromkeys(query.lower().split()))
    # Only postings of terms that answer a word are moved; the others find no partner in the join.
    asked = posts.where(reduce(Column.__or__, [_answers(w, typos)[0] for w in words]))
    hits = with_terms(asked, expand_query(vocab, words, typos))
    per_word = hits.groupBy("doc_id", "word").agg(
        F.min("typos").alias("typos"), F.min("field").alias("field"), F.max("exact").alias("exact"),
        F.min(F.struct("field", "first_pos"))["first_pos"].alias("pos"))
    spread = F.max("pos") - F.min("pos")
    same_field = F.min("field") == F.max("field")
    ranked = per_word.groupBy("doc_id").agg(
        F.count("*").alias("words"), F.sum("typos").alias("typos"),
        F.when(same_field, spread).otherwise(F.lit(1000000)).cast("bigint").alias("proximity"),
        F.min("field").alias("best_field"), F.sum("exact").alias("exact"))
    return ranked.where(F.col("words") == len(words))


def rank_keys(sort: list[Column] = ()) -> list[Column]:
    return [F.col("words").desc(), F.col("typos"), F.col("proximity"), F.col("best_field"), *sort,
            F.col("exact").desc(), F.col("doc_id")]


def search(docs: DataFrame, posts: DataFrame, vocab: DataFrame, query: str, filters: dict[str, str] | None = None,
           sort: str | None = "published_at", limit: int = 30, offset: int = 0, typos: bool = True) -> DataFrame:
    """Ranked hits: filter on declared fields only, sort by a declared field (newest first), page.
    An empty query returns every document in sort order."""
    for f in filters or {}:
        if f not in FILTERABLE:
            raise ValueError(f"attribute {f!r} is not filterable")
    if sort is not None and sort not in SORTABLE:
        raise ValueError(f"attribute {sort!r} is not sortable")
    rows = docs
    for f, value in (filters or {}).items():
        rows = rows.where(F.col(f) == value)
    by = [F.col(sort).desc_nulls_last()] if sort else []
    if not query.strip():
        return rows.orderBy(*by, "doc_id").offset(offset).limit(limit)
    # Rank on ids and the sort field only; whole documents are fetched for the page that is shown,
    # whose size the limit bounds.
    keys = rank_keys(by)
    narrow = rows.select("doc_id", *([sort] if sort else [])).join(match_documents(posts, vocab, query, typos), "doc_id")
    page = narrow.orderBy(*keys).offset(offset).limit(limit)
    return rows.join(F.broadcast(page.drop(sort) if sort else page), "doc_id").orderBy(*keys)


def total_hits(docs: DataFrame, posts: DataFrame, vocab: DataFrame, query: str, typos: bool = True) -> DataFrame:
    hits = match_documents(posts, vocab, query, typos).join(docs.select("doc_id"), "doc_id", "left_semi") if query.strip() else docs
    return hits.agg(F.count("*").alias("total"))


def weighted_search(posts: DataFrame, words: list[str], weights: list[int], limit: int = 30) -> DataFrame:
    """Any-word text search scored by ``sum(weight of field * tf)``."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.col("field") + 1)
    scored = posts.where(F.col("term").isin([x.lower() for x in words])).groupBy("doc_id").agg(F.sum(w * F.col("tf")).alias("score"))
    return scored.orderBy(F.col("score").desc(), "doc_id").limit(limit)


def snippets(hits: DataFrame, n: int = 1000) -> DataFrame:
    """Result text of each hit with defaults and a body cut to ``n`` characters."""
    return hits.select("doc_id", F.concat(
        F.lit("### Title: "), first_filled("title", F.lit("Untitled")), F.lit("\nCompany: "),
        first_filled("company_name", F.lit("Unknown Company")), F.lit("\nURL: "), first_filled("url", F.lit("No URL")),
        F.lit("\nID: "), F.col("doc_id").cast("string"), F.lit("\n---\n"),
        F.substring(first_filled("content", F.lit("(No body content)")), 1, n), F.lit("...\n\n")).alias("text"))
