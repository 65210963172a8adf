"""Book structure: chapters from a table of contents or page text, font statistics, text blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.base import col, contains_any, match_group, trim_ws
from ..session import cut_lineage
from .links import first_by_id
from .scan import ordinal_bucket, prefix_scan

# Front and back matter that is left out.
EXCLUDE_TITLES = ["cover", "copyright", "table of contents", "contents", "index", "about the author",
                  "about the authors", "colophon", "foreword"]
# What a chapter opening looks like, with and without its number.
CHAPTER_START = r"(?m)(^(?:Chapter|CHAPTER|Part|PART)\s+(?:\d+|[IVXLCDM]+)[\.\s])"
CHAPTER_HEADING = r"(?m)^(?:Chapter|CHAPTER|Part|PART)\s+"
# Pages sampled for the body font, its plausible range and default.
SAMPLE_PAGES, BODY_RANGE, BODY_DEFAULT, PAGE_DEFAULT = [10, 30, 50, 80, 100], (8.0, 16.0), 11.0, 10.0
OFFSETS = (-2, -1, 0, 1, 2, 3)


def is_included(title) -> Column:
    return ~contains_any(F.lower(col(title)), EXCLUDE_TITLES)


def chapter_ranges(toc: DataFrame, totals: DataFrame) -> DataFrame:
    """Level-1 entries with the page of the next one as end, the book's last page for the final one.
    ``toc(book, ord, level, title, page)``, ``totals(book, pages)``."""
    top = toc.where("level = 1").select("book", "ord", "title", "page")
    nxt = prefix_scan(top, ["book"], ["ord"], ordinal_bucket("ord"), {"_next": ("last", F.col("page"))},
                      reverse=True, inclusive=False)
    return nxt.join(totals, "book").select("book", "ord", "title", F.col("page").alias("start_page"),
                                           F.coalesce("_next", "pages").alias("end_page"))


def part_chapters(toc: DataFrame, totals: DataFrame) -> DataFrame:
    """Chapters of books with parts: a part is replaced by the level-2 entries in its page range.

    A part ends at the next larger level-1 page of its book (tables of contents run in page order).
    The range join is an equi-join: every entry first learns the level-1 page it lies under and the
    next one after it. That placement feeds four branches, so it is written out once.
    """
    entries = toc.where("level IN (1, 2)").select("book", "ord", "level", "title", "page")
    pages = entries.groupBy("book", "page").agg(F.max(F.col("level") == 1).alias("top"))
    top_page, bucket = F.when(F.col("top"), F.col("page")), ordinal_bucket("page")
    pages = prefix_scan(pages, ["book"], ["page"], bucket, {"_next": ("last", top_page)}, reverse=True, inclusive=False)
    pages = prefix_scan(pages, ["book"], ["page"], bucket, {"part_page": ("last", top_page)}).drop("top")
    placed = entries.join(pages, ["book", "page"]).join(totals, "book")
    placed = cut_lineage(placed.select("book", "ord", "level", "title", "page", "part_page", F.coalesce("_next", "pages").alias("end_page")))

    # Children before the first part, or past the last page, belong to no part.
    kids = placed.where("level = 2 AND part_page IS NOT NULL AND page < end_page").select("book", "part_page", "ord", "page", "title")
    kids = prefix_scan(kids, ["book", "part_page"], ["ord"], ordinal_bucket("ord"), {"_after": ("last", F.col("page"))},
                       reverse=True, inclusive=False)
    is_part = F.contains(F.lower("title"), F.lit("part"))
    tops = placed.where("level = 1")
    number = match_group("title", r"(?:Part|PART)\s+([IVXLCDM]+|\d+)")
    prefix = F.coalesce(F.concat(F.lit("Part "), number), trim_ws(F.substring_index("title", ".", 1)))
    parts = tops.where(is_part).select("book", F.col("ord").alias("part_ord"), "part_page", prefix.alias("prefix"), "end_page")
    inside = parts.join(kids, ["book", "part_page"]).select(
        "book", "part_ord", "ord", F.concat("prefix", F.lit(" - "), "title").alias("title"), F.col("page").alias("start_page"),
        F.coalesce("_after", "end_page").alias("end_page"), is_included("title").alias("include"))
    filled = placed.where("level = 2 AND part_page IS NOT NULL AND page < end_page").select("book", "part_page").distinct()
    childless = tops.where(is_part).join(filled, ["book", "part_page"], "left_anti")
    cols = ["book", "ord", "title", "page", "end_page"]
    own = tops.where(~is_part).select(*cols).unionByName(childless.select(*cols))
    return inside.unionByName(own.select("book", F.col("ord").alias("part_ord"), "ord", "title", F.col("page").alias("start_page"),
                                         "end_page", is_included("title").alias("include")))


def detect_chapters(page_text: DataFrame, totals: DataFrame) -> DataFrame:
    """Chapters from page text: a numbered opening starts one, the next heading page ends it.
    ``page_text(book, page, text)``."""
    flags = page_text.select("book", "page", trim_ws(match_group("text", CHAPTER_START)).alias("title"),
                             F.col("text").rlike(CHAPTER_HEADING).alias("heading")).where("heading")
    nxt = prefix_scan(flags, ["book"], ["page"], ordinal_bucket("page"), {"_next": ("last", F.col("page"))},
                      reverse=True, inclusive=False)
    return nxt.where("title IS NOT NULL").join(totals, "book").select(
        "book", "title", F.col("page").alias("start_page"), F.coalesce("_next", "pages").alias("end_page"))


def title_offsets(chapters: DataFrame, page_text: DataFrame, key: list[str]) -> DataFrame:
    """First offset from -2 to +3 at which the page holds the first 40 characters of the title, else
    0. Six candidate pages per chapter join on (book, page)."""
    tries = chapters.select(*key, "book", F.lower(trim_ws(F.substring("title", 1, 40))).alias("_key"), "start_page",
                            F.explode(F.array(*[F.lit(o) for o in OFFSETS])).alias("offset"))
    tries = tries.withColumn("page", (F.col("start_page") + F.col("offset")).cast("bigint"))
    pages = page_text.select("book", F.col("page").cast("bigint").alias("page"), F.lower("text").alias("_text"))
    hits = tries.join(pages, ["book", "page"]).where(F.contains("_text", F.col("_key")))
    found = hits.groupBy(*key).agg(F.min("offset").alias("offset"))
    return chapters.select(*key).join(found, key, "left").withColumn("offset", F.coalesce("offset", F.lit(0)))


def clamp_ranges(chapters: DataFrame, pages: str = "pages") -> DataFrame:
    """Zero-based page ranges inside the book; empty ones are dropped."""
    first = F.greatest(F.col("start_page") - 1, F.lit(0))
    last = F.least(F.col("end_page") - 1, F.col(pages) - 1)
    return chapters.withColumn("from_page", first).withColumn("to_page", last).where("from_page <= to_page")


def upper_median(size: str) -> Column:
    """Element ``n // 2`` of the ascending values. Font sizes take few distinct values, which is what
    the percentile buffer of a group holds."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {size} DESC)")


def page_medians(spans: DataFrame) -> DataFrame:
    return spans.groupBy("book", "page").agg(F.coalesce(upper_median("size"), F.lit(PAGE_DEFAULT)).alias("median_size"))


def body_font(books: DataFrame, spans: DataFrame) -> DataFrame:
    """Body font size of each book from its sampled pages; default when they hold no body text."""
    low, high = BODY_RANGE
    sample = spans.where(F.col("page").isin(SAMPLE_PAGES) & (F.col("size") > low) & (F.col("size") < high))
    sizes = sample.groupBy("book").agg(upper_median("size").alias("body_size"))
    return books.select("book").distinct().join(sizes, "book", "left").withColumn("body_size", F.coalesce("body_size", F.lit(BODY_DEFAULT)))


def dedupe_spans(spans: DataFrame) -> DataFrame:
    """Shadow text out: the first span per page, rounded position and text stays."""
    keyed = spans.where(trim_ws("text") != "").select("*", F.round("x", 1).alias("_x"), F.round("y", 1).alias("_y"), trim_ws("text").alias("_t"))
    return first_by_id(keyed, ["block", "line", "span"], ["book", "page", "_x", "_y", "_t"]).select(*spans.columns)


def block_texts(spans: DataFrame) -> DataFrame:
    """Text of each block in reading order, with its mean size and bold flag. A block is a paragraph
    of one printed page, so what it gathers is bounded; lines are put together inside the row."""
    blocks = spans.where(trim_ws("text") != "").groupBy("book", "page", "block").agg(
        F.array_sort(F.collect_list(F.struct("line", "span", "text"))).alias("_s"), F.avg("size").alias("avg_size"),
        F.max(F.col("flags").bitwiseAND(16) > 0).alias("bold"))

    def piece(x, i):
        s = F.col("_s")
        starts = (i == 0) | (F.get(s, i - 1)["line"] != x["line"])
        ends = (i == F.size(s) - 1) | (F.get(s, i + 1)["line"] != x["line"])
        t = F.when(starts & ends, trim_ws(x["text"])).when(starts, F.ltrim(x["text"])).when(ends, F.rtrim(x["text"])).otherwise(x["text"])
        return F.when(starts & (i > 0), F.concat(F.lit(" "), t)).otherwise(t)
    return blocks.select("book", "page", "block", F.array_join(F.transform("_s", piece), "").alias("text"), "avg_size", "bold")


def classify_blocks(blocks: DataFrame, medians: DataFrame) -> DataFrame:
    """Add ``tag`` by block size against the page median: h1, h2, strong (bold run) or p."""
    limit = F.col("median_size") * 1.25
    tag = (F.when(F.col("avg_size") >= limit * 1.5, "h1").when(F.col("avg_size") >= limit, "h2")
           .when(F.col("bold"), "strong").otherwise("p"))
    return blocks.join(medians, ["book", "page"]).withColumn("tag", tag)


def book_summary(toc: DataFrame, totals: DataFrame, first: int = 20) -> DataFrame:
    """Pages, number of level-1 chapters and the first ones. The rank filter keeps at most ``first``
    rows per book and task before anything is gathered."""
    top = toc.where("level = 1")
    counts = top.groupBy("book").agg(F.count("*").alias("chapters"))
    rank = F.row_number().over(Window.partitionBy("book").orderBy("ord"))
    head = top.withColumn("_r", rank).where(F.col("_r") <= first).groupBy("book").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_r", F.concat("title", F.lit(" (p."), "page", F.lit(")")).alias("t")))), lambda s: s["t"]).alias("first"))
    return totals.join(counts, "book", "left").join(head, "book", "left").select(
        "book", "pages", F.coalesce("chapters", F.lit(0)).alias("chapters"), F.array_join("first", " | ").alias("first"))


def chapter_records(files: DataFrame, book: str, file: str) -> DataFrame:
    """Chapter rows of Markdown files: index from the name, id = md5 of ``book_title``."""
    title = F.regexp_replace(F.col(file), r"\.md\z", "")
    number = F.coalesce(match_group(file, r"(?i)chapter\s*(\d+)"), match_group(file, r"^(\d+)"))
    return files.select("*", title.alias("title"), F.coalesce(number.try_cast("int"), F.lit(0)).alias("chapter_index"),
                        F.md5(F.concat_ws("_", F.col(book), title)).alias("id"))


def index_lines(chapters: DataFrame, fmt: str = "obsidian") -> DataFrame:
    """Index page of each book as ordered lines ``(book, section, sort_key, line)``: one row per line,
    so a book with very many chapters stays spread out."""
    book, key = F.col("book"), T.natural_key("title")
    name = trim_ws(F.regexp_replace(F.regexp_replace("title", r'[\\/:*?"<>|]', "_"), r"\s+", " "))
    books = chapters.select("book").distinct()
    empty = F.lit("")
    if fmt == "joplin":
        head = [F.lit("# 📚 INDEX"), empty, F.concat(F.lit("**"), book, F.lit("**")), empty, F.lit("## 📑 Chapters"), empty]
        link = F.concat(F.lit("#"), F.regexp_replace(F.lower(name), r"\s+", "-"))
    else:
        head = [F.concat(F.lit("# 📚 "), book), empty, F.lit("## 📑 Chapters"), empty]
        link = F.concat(F.lit("./"), name, F.lit(".md"))
    top = books.select("book", F.lit(0).alias("section"), F.posexplode(F.array(*head)).alias("p", "line"))
    top = top.select("book", "section", F.lpad(F.col("p").cast("string"), 2, "0").alias("sort_key"), "line")
    out = top.unionByName(chapters.select("book", F.lit(1).alias("section"), key.alias("sort_key"), F.concat(
        F.lit("- ["), "title", F.lit("]("), link, F.lit(")")).alias("line")))
    if fmt == "joplin":
        body = F.array(F.concat(F.lit("## "), "title"), empty, F.concat(F.lit("> Source: "), "url"), empty)
        out = out.unionByName(chapters.select("book", F.lit(2).alias("section"), key.alias("k"), F.posexplode(body).alias("p", "line"))
                              .select("book", "section", F.concat("k", F.lit(" "), "p").alias("sort_key"), "line"))
    return out


def strip_inline_images(html) -> Column:
    """Page separators out; inline image payloads replaced by their ordinal-free placeholder."""
    t = F.regexp_replace(col(html), r"""(?is)<(?:style|script)\b[^>]*>.*?</(?:style|script)\s*>|<div[^>]*class=["']page-separator["'][^>]*>.*?</div>""", "")
    return F.regexp_replace(t, r"""(?is)(<img[^>]*src=["'])\s*data:image/[^"']*(["'])""", "$1images/inline$2")


def inline_images(pages: DataFrame, keep: list[str], html: str) -> DataFrame:
    """Inventory of inline images: ordinal, extension, decoded size in bytes."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<img[^>]*src=["']\s*(data:image/[^"']*)["']"""), F.lit(1))
    rows = pages.select(*keep, F.posexplode(found).alias("pos", "src")).withColumn("src", F.regexp_replace("src", r"\s+", ""))
    payload = F.regexp_replace("src", r"^[^,]*,", "")
    return rows.select(*keep, "pos", F.coalesce(match_group("src", r"data:image/(\w+);"), F.lit("png")).alias("ext"),
                       F.length(F.unbase64(payload)).alias("bytes"))
