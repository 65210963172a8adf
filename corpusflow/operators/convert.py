"""Bronze to silver: one parse per page, then Column rules per site.

``convert`` takes captures ``(id, url, raw_html, raw_json, ...)`` of one site and returns its meta
columns; ``silver`` maps them to the site's record. Sites differ only in the entries of
``CONVERTERS``: which fields leave the page, and which Columns they become.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.base import col, first_filled, let, match_group, trim_ws
from ..functions.jsonx import as_json_array, is_json_object, json_field, pairs_to_map, unescape
from ..functions.html import FORUM, TOPIC
from ..functions.geo import country_of, geo_bucket
from ..functions.url import job_id
from ..sites import site
from . import company as CO
from . import extract as X
from .links import first_by_id

NO_INFO = T.NO_INFO
# Keyword that implies a category.
CATEGORY_OF_TAG = {"LLM_APPLICATION": "LLM 응용", "DEV_EFFICIENCY": "개발 효율성"}


def split_tags(keywords) -> Column:
    return F.filter(F.transform(F.split(col(keywords), ","), trim_ws), lambda t: t != "")


def infer_categories(tags: Column) -> Column:
    return F.array_compact(F.array(*[F.when(F.array_contains(tags, k), F.lit(v)) for k, v in CATEGORY_OF_TAG.items()]))


def raw_payload(raw_html="raw_html", raw_json="raw_json") -> tuple[Column, Column]:
    """Payload to convert and the error of a capture without one."""
    payload = first_filled(raw_html, raw_json)
    return payload, F.when(payload.isNull(), F.lit("No rawHtml or rawJson found"))


def json_ld_items(blocks: Column, kind: str | None = None) -> Column:
    """Objects of structured-data texts, lists flattened, broken texts skipped, optional type filter."""
    items = F.filter(F.flatten(F.transform(blocks, as_json_array)), is_json_object)
    return items if kind is None else F.filter(items, lambda j: F.get_json_object(j, "$['@type']") == kind)


def json_ld_blocks(html) -> Column:
    """Structured-data texts of markup without a parse."""
    return F.regexp_extract_all(col(html), F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))


def tag_text(html, tag: str) -> Column:
    return T.decode_entities(trim_ws(match_group(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")))


def meta_content(html, name: str) -> Column:
    """Content of a meta element, attribute order as written by the sites."""
    return T.decode_entities(match_group(html, rf"""(?is)<meta[^>]*(?:property|name)=["']{name}["'][^>]*content=["']([^"']*)["']"""))


def first_external_link(links: Column, domain: Column) -> Column:
    """First absolute link that leaves the domain, in page order."""
    away = F.filter(links, lambda a: F.startswith(a["href"], F.lit("http")) & ~F.contains(a["href"], domain))
    return F.get(away, F.lit(0))["href"]


def course_links(links: Column, domain: Column) -> Column:
    """Links of the domain whose text speaks of a course or lesson."""
    return F.transform(F.filter(links, lambda a: F.contains(a["href"], domain) & F.lower(a["text"]).rlike("course|lesson")),
                       lambda a: a["href"])


def iso(ts: Column) -> Column:
    return F.date_format(ts, D.ISO)


def _line(label: str, value: Column) -> Column:
    """``* **label:** value`` when the value is filled."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"* **{label}:** "), value, F.lit("\n"))).otherwise("")


def _must(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"* **{label}:** "), first_filled(value, F.lit(NO_INFO)), F.lit("\n"))


def _go(label: str, url: Column) -> Column:
    return F.concat(F.lit(f"* **{label}:** [바로가기]("), F.coalesce(url, F.lit("")), F.lit(")\n"))


def assemble(head: Column, lines: list[Column], rest: list) -> Column:
    """Markdown document: head line, optional lines, body pieces."""
    return F.concat(head, F.lit("\n\n"), *lines, *[F.lit(r) if isinstance(r, str) else r for r in rest])


@dataclass(frozen=True)
class Converter:
    """Fields to take from a page and the Columns they become."""

    rules: Callable[[Column, Column, Column], dict[str, Column]]
    fields: dict = field(default_factory=dict)
    from_json: bool = False


def _cut(c: Column, mark: str) -> Column:
    return F.split(c, mark)[0]


def _uppity(x, id_, url):
    link = first_filled(x["canonical"], url)
    name = F.regexp_replace(F.regexp_replace(x["title"], r" - UPPITY.*\z", ""), r" \| UPPITY.*\z", "")
    title = first_filled(x["meta"]["og:title"], name, F.lit("Unknown Title"))
    at = D.safe_timestamp(first_filled(x["meta"]["article:published_time"], x["time"]))
    body = F.coalesce(x["content_md"], F.lit(""))
    return dict(title=title, url=link, published_at=at, content=body, raw_content=assemble(
        F.concat(F.lit("# "), title), [_must("작성일", iso(at)), _go("원본 링크", link)], ["\n## 내용\n\n", body, "\n"]))


def _pytorch_kr(x, id_, url):
    link = first_filled(x["canonical"], url)
    page = first_filled(x["title"], F.lit("Unknown Title"))
    page = F.when(F.contains(page, F.lit(" | ")), F.substring_index(page, " | ", 1)).otherwise(F.substring_index(page, " - ", 1))
    title = first_filled(x["texts"]["blog_title"], page)
    at = D.safe_timestamp(first_filled(x["texts"]["blog_date"], x["time"], x["meta"]["article:published_time"]))
    body = F.when(x["content_rank"] < 2, x["content_md"]).otherwise("")
    return dict(title=title, url=link, published_at=at, content=F.concat(title, F.lit("\n"), body), raw_content=assemble(
        F.concat(F.lit("# 📂 [PyTorch KR] "), title), [_must("작성일", iso(at)), _go("원본 링크", link)], ["\n## 📝 본문 내용\n\n", body, "\n"]))


def _dailydose(x, id_, url):
    title = first_filled(x["h1"], trim_ws(_cut(x["title"], r"\|")), F.lit("Unknown Title"))
    at = D.safe_timestamp(first_filled(x["time"], x["texts"]["updated"]))
    body = F.when(x["content_rank"] == 0, x["content_md"]).otherwise("")
    # Blanks inside link brackets and targets out, blank runs folded.
    for pattern, to in ((r"\[\s*(?:[\r\n\t ]+)?([^\]]*?)\]", "[$1]"), (r"(\[.*?\])\(\s*(?:[\r\n\t ]+)?(.*?)\)", "$1($2)"), (r"\n\s*\n\s*\n", "\n\n")):
        body = F.regexp_replace(body, pattern, to)
    return dict(title=title, url=url, published_at=at, content=body, discovered_urls=course_links(x["links"], F.lit("dailydoseofds.com")),
                raw_content=assemble(F.concat(F.lit("# 📂 [Daily Dose of DS] "), title), [_must("작성일", iso(at)), _go("원본 링크", url)],
                                     ["\n## 📝 본문 내용\n\n", body, "\n"]))


def _yozm(x, id_, url):
    link = first_filled(x["canonical"], url)
    title = F.regexp_replace(first_filled(x["meta"]["og:title"], x["title"], F.lit("Unknown Title")), r"\s*\|\s*요즘IT\z", "")
    news = F.element_at(json_ld_items(x["json_ld"], "NewsArticle"), -1)
    news = F.when(F.size(json_ld_items(x["json_ld"], "NewsArticle")) > 0, news)
    at = D.safe_timestamp(json_field(news, "$.datePublished"))
    category = first_filled(json_field(news, "$.articleSection"), x["texts"]["category"])
    author = json_field(news, "$.author.name")
    author = F.when(author == "요즘IT", first_filled(x["texts"]["author"], author)).otherwise(author)
    article = T.decode_entities(json_field(news, "$.articleBody"))
    article = F.regexp_replace(F.regexp_replace(F.regexp_replace(article, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""), r"\n{3,}", "\n\n")
    body = first_filled(F.when((x["content_rank"] == 0) & (F.length(trim_ws(x["content_html"])) > 50), x["content_md"]), trim_ws(article),
                        F.lit("(content extraction failed)"))
    return dict(title=title, url=link, published_at=at, category=category, author=author, content=body, raw_content=assemble(
        F.concat(F.lit("# "), title), [_line("카테고리", category), _line("발행일", iso(at)), _line("작가", author), _go("원본 링크", link)],
        ["\n---\n\n", body, "\n"]))


def _maily(x, id_, url):
    link = first_filled(x["canonical"], url)
    title = first_filled(x["meta"]["og:title"], x["title"], F.lit("Unknown Title"))
    shown = F.concat(F.replace(match_group(x["texts"]["date"], r"(\d{4}\.\d{2}\.\d{2})"), F.lit("."), F.lit("-")), F.lit("T00:00:00Z"))
    at = D.safe_timestamp(first_filled(x["meta"]["article:published_time"], shown))
    views = trim_ws(F.replace(F.element_at(F.filter(x["short_texts"], lambda s: F.contains(s, F.lit("조회"))), -1), F.lit("조회"), F.lit("")))
    views = F.when(F.exists(x["short_texts"], lambda s: F.contains(s, F.lit("조회"))), views)
    category, body = x["texts"]["category"], F.when(x["content_rank"] == 0, x["content_md"]).otherwise("")
    return dict(title=title, url=link, published_at=at, category=category, view_count=views, content=body, raw_content=assemble(
        F.concat(F.lit("# "), title), [_line("카테고리", category), _line("발행일", iso(at)), _line("조회수", views), _go("원본 링크", link)],
        ["\n---\n\n", body, "\n"]))


def _aicasebook(x, id_, url):
    meta, tags = x["meta"], split_tags(F.coalesce(x["meta"]["keywords"], F.lit("")))
    title = first_filled(meta["og:title"], x["title"], F.lit("Untitled"))
    time = meta["article:published_time"]
    at = F.coalesce(D.epoch_ms_timestamp(time), D.safe_timestamp(time))
    away = first_filled(x["texts"]["source"], first_external_link(F.filter(x["links"], lambda a: a["blank"]), F.lit("aicasebook.dev")))
    views = F.coalesce(match_group(x["body_text"], r"조회\s*(\d+)").try_cast("int"), F.lit(0))
    series = trim_ws(match_group(x["body_text"], r"◆(.+)"))
    body, summary, author = F.when(x["content_rank"] == 0, x["content_md"]).otherwise(""), meta["description"], meta["article:author"]
    quote = F.when(F.coalesce(summary, F.lit("")) != "", F.concat(F.lit("> "), summary, F.lit("\n\n"))).otherwise("")
    return dict(title=title, url=url, summary=summary, author=author, categories=infer_categories(tags), tags=tags, published_at=at, views=views,
                source_link=away, series_name=series, content=body, raw_content=assemble(
                    F.concat(F.lit("# "), title), [quote, _must("작성자", author), _line("작성일", iso(at)),
                                                   F.when(away.isNotNull(), _go("원본 링크", away)).otherwise(""), _line("시리즈", series),
                                                   _line("태그", F.array_join(tags, ", ")), _line("조회수", views.cast("string"))], ["\n---\n\n", body]))


def _geeknews(x, id_, url):
    title = first_filled(trim_ws(F.replace(x["title"], F.lit(" | GeekNews"), F.lit(""))), F.lit(NO_INFO))
    out = x["texts"]["external"]
    link = F.when(F.coalesce(out, F.lit("")) == "", url).when(F.startswith(out, F.lit("http")), out).otherwise(
        F.concat(F.lit("https://news.hada.io/"), F.regexp_replace(out, "^/", "")))
    ld = F.get(x["json_ld"], F.lit(0))
    at = D.safe_timestamp(json_field(ld, "$.datePublished"))
    body = T.clean_content(first_filled(F.when(x["content_rank"] == 0, x["content_md"]), json_field(ld, "$.articleBody"),
                                        json_field(ld, "$.description"), json_field(ld, "$.text"), F.lit(" ")))
    comments = F.col("comments")
    talk = F.when(F.size(comments) > 0, F.concat(
        F.lit("## 💬 댓글 및 토론 ("), F.size(comments).cast("string"), F.lit("개)\n\n"),
        F.array_join(F.transform(comments, lambda c: F.concat(F.lit("### 👤 "), c["author"], F.lit("\n> "), c["content"], F.lit("\n\n"))), ""))).otherwise("")
    return dict(title=title, url=link, published_at=at, content=body, json_ld_raw=ld, comments=comments, raw_content=assemble(
        F.concat(F.lit("# 📰 "), title), [_line("작성일", iso(at)), _go("기사 링크", link)], ["\n## 📝 요약 설명\n", body, "\n\n", talk]))


POST = ("struct<title:string,slug:string,shortContent:string,createdAt:string,reactionsCount:int,repliesCount:int,author:struct<name:string>,"
        "createdBy:struct<member:struct<name:string>>,fields:array<struct<key:string,value:string>>,space:struct<id:string,name:string,slug:string>>")


def _post(payload, id_, url):
    good = is_json_object(payload)
    p = F.when(good, F.from_json(payload, POST))
    title = first_filled(p["title"], F.lit("No Title"))
    author = first_filled(p["author"]["name"], p["createdBy"]["member"]["name"], F.lit("Unknown"))
    long_text = F.element_at(pairs_to_map(p["fields"]), "content")
    body = F.coalesce(unescape(first_filled(long_text, p["shortContent"], F.when(~good, payload))), F.lit(""))
    at = D.safe_timestamp(p["createdAt"])
    likes, replies = F.coalesce(p["reactionsCount"], F.lit(0)), F.coalesce(p["repliesCount"], F.lit(0))
    link = first_filled(url, F.concat(F.lit("https://www.gpters.org/news/post/"), p["slug"], F.lit("-"), id_))
    count = F.concat(F.lit("* **리액션:** 👍 "), likes.cast("string"), F.lit(" | 💬 "), replies.cast("string"), F.lit("\n"))
    return dict(title=title, url=link, author=author, summary=body, published_at=at, reactions_count=likes, replies_count=replies,
                space_id=p["space"]["id"], space_name=p["space"]["name"], space_slug=p["space"]["slug"], raw_content=assemble(
                    F.concat(F.lit("# 💡 [GPTERS] "), title), [F.concat(F.lit("* **작성자:** "), author, F.lit("\n")), _line("스페이스", p["space"]["name"]),
                                                              _must("작성일", iso(at)), count, _go("원본 링크", link)], ["\n## 📝 내용\n\n", body, "\n"]))


# Words that name a workplace or a contract, and the way to apply.
WORKPLACES = ["Remote", "On-site", "Hybrid", "원격", "현장", "하이브리드"]
CONTRACTS = ["Contract", "Full-time", "Part-time", "Internship", "Temporary", "계약직", "정규직"]
EASY_APPLY, EXTERNAL_APPLY = "간편 지원 (Easy Apply)", "일반 지원 (External Apply)"


def _job(x, id_, url):
    one = lambda c: F.regexp_replace(c, r"\s+", " ")
    find = lambda cond: F.get(F.filter(x["short_texts"], cond), F.lit(0))
    key = F.coalesce(first_filled(F.when(id_ != NO_INFO, id_)), match_group(x["canonical"], r"(\d+)\z"),
                     match_group(F.get(F.filter(F.transform(x["links"], lambda a: a["href"]), lambda h: F.contains(h, F.lit("/view/"))), F.lit(0)), r"(\d{7,})"),
                     F.lit(NO_INFO))
    bar = F.transform(F.split(x["title"], r"\|"), trim_ws)
    at_title = lambda i: trim_ws(match_group(x["title"], r"(?i)^(.*)\s+at\s+(.*?)(?:\s*\||\z)", i))
    page_title = F.when(F.size(bar) >= 2, bar[0]).otherwise(at_title(1))
    page_company = F.when(F.size(bar) >= 2, F.get(bar, F.lit(1))).otherwise(at_title(2))
    og_desc, og_title = F.coalesce(x["meta"]["og:description"], F.lit("")), x["meta"]["og:title"]
    said = F.regexp_replace(F.split(og_desc, " hiring ")[0], r"(?i)Posted.*?\.\s*", "")
    said = F.when(F.contains(og_desc, F.lit(" hiring ")), said).otherwise(F.substring(said, 1, 20))
    company = first_filled(one(x["texts"]["company"]), one(trim_ws(said)), page_company, F.lit(NO_INFO))
    hired = F.when(F.contains(og_title, F.lit(" hiring ")), F.split(F.get(F.split(og_title, " hiring "), F.lit(1)), " in ")[0]).otherwise(og_title)
    title = first_filled(one(x["texts"]["job_title"]), one(trim_ws(hired)), page_title, F.lit(NO_INFO))
    place = find(lambda t: country_of(t, mode="word").isNotNull() & ~F.contains(t, title) & ~F.contains(t, company)
                 & ~t.rlike("ago|전|applicant|지원자|hiring"))
    location = first_filled(one(x["texts"]["location"]), place, F.lit(NO_INFO))
    workplace = first_filled(one(x["texts"]["workplace"]), find(lambda t: t.isin(WORKPLACES)), F.lit(NO_INFO))
    contract = first_filled(one(x["texts"]["job_type"]), find(lambda t: t.isin(CONTRACTS)), F.lit(NO_INFO))
    easy = F.exists(x["short_texts"], lambda t: t.rlike("(?i)Easy Apply|간편 지원"))
    age = first_filled(x["texts"]["posted"], find(lambda t: (F.length(t) < 50) & t.rlike(
        r"(?i)(\d+)\s*(day|week|month|year|hour|minute|second|일|주|달|개월|년|시간|분|초)s?\s*(ago|전)")))
    posted = D.relative_date(age, match_group(x["meta"]["description"], r"(?i)Posted\s+([^.]+)\."), F.col("scraped_at"))
    link = first_filled(url, x["canonical"], F.concat(F.lit("https://www.linkedin.com/jobs/view/"), key))
    body = T.jd_split(F.coalesce(x["content_md"], F.lit("")), company)
    apply = F.when(easy, EASY_APPLY).otherwise(EXTERNAL_APPLY)
    geo = geo_bucket(location)
    country = F.when(geo != "Others", geo).when(location != NO_INFO, location).otherwise("Others")
    meta = lambda n: first_filled(x["meta"][n], F.lit(NO_INFO))
    front = F.concat(*[F.concat(F.lit(f'{k}: "'), v, F.lit('"\n')) for k, v in [
        ("job_id", key), ("company_id", meta("companyId")), ("industry_id", meta("industryIds")), ("title_id", meta("titleId")),
        ("job_title", title), ("company_name", company), ("location", location), ("country", country), ("geo", geo),
        ("posted_date", posted)]])
    facts = [_must(k, v) for k, v in [
        ("공고 제목 (Job Title)", title), ("회사명 (Company)", company), ("근무 위치 (Location)", location), ("국가 (Country)", country),
        ("지리 구분 (Geo)", geo), ("근무 형태 (Workplace Type)", workplace), ("고용 형태 (Job Type)", contract),
        ("지원 방식 (Apply Type)", apply), ("포스팅 날짜 (Posted Date)", posted)]]
    return dict(job_id=key, url=link, company=company, job_title=title, raw_location=location, workplace_type=workplace, job_type=contract,
                apply_type=apply, posted_date=posted, published_at=D.safe_timestamp(posted),
                raw_content=F.concat(
                    F.lit("---\n"), front, F.lit("---\n\n# 📌 채용 공고 핵심 요약 (Job Summary)\n\n## 🏢 기본 및 근무 정보 (Basic Info)\n"), *facts,
                    F.lit("* **공고 링크 (Job Link):** [바로가기 (Link)]("), link, F.lit(")\n\n---\n\n## 📝 JD (직무 기술서 / Job Description)\n"),
                    body, F.lit("\n")))


ARTICLE_BODIES = [".elementor-widget-theme-post-content .elementor-widget-container", ".elementor-widget-theme-post-content",
                  "article .entry-content", ".entry-content", "article .elementor-widget-container", "article.post-content",
                  ".post-content", "article"]

CONVERTERS: dict[str, Converter] = {
    "uppity": Converter(_uppity, dict(content=ARTICLE_BODIES, min_content=50)),
    "pytorch_kr": Converter(_pytorch_kr, dict(
        content=['div.post[itemprop="text"]', "article.pytorch-article div.blog-content"], drop=['img[alt^=":"]'], style=FORUM,
        captions=("div.lightbox-wrapper", "a.lightbox", "span.informations"),
        texts={"blog_title": "h1 a.blog-title", "blog_date": "p.featured-post"})),
    "dailydose_ds": Converter(_dailydose, dict(
        content=["main"], drop=["aside, footer, .js-toc-ignore, .gh-nav-list, .gh-pagination"], style=FORUM, texts={"updated": "div[data-sx-updated-on]"})),
    "yozm": Converter(_yozm, dict(
        content=['main[data-id="detail-contents"]'], majority=".typo-contents16",
        texts={"category": 'a[data-testid="contentsItem-category-link"]', "author": 'a[href*="/magazine/@"]'})),
    "maily_josh": Converter(_maily, dict(content=["article.post-body-narrow"], short_text=200,
                                         texts={"category": 'h2 a[href*="/c/"]', "date": "span.text-slate-600"})),
    "aicasebook": Converter(_aicasebook, dict(content=[".markdown-body"], style=TOPIC, body_text=True,
                                              attrs={"source": ('a[class*="accent-warm"]', "href")})),
    "geeknews": Converter(_geeknews, dict(content=[".topicdesc, #topic_contents, .topic_contents"], style=TOPIC,
                                          attrs={"external": (".topictitle a", "href")})),
    "gpters": Converter(_post, from_json=True),
    "gpters_newsletter": Converter(_post, from_json=True),
    "linkedin": Converter(_job, dict(
        content=[".show-more-less-html__markup", ".description__text, .jobs-description__content, .jobs-box__html-content"], short_text=100,
        texts={"company": ".topcard__flavor a, .job-details-jobs-unified-top-card__company-name, [data-tracking-control-name=\"public_jobs_topcard-company-name\"]",
               "job_title": ".topcard__title, h1, .job-details-jobs-unified-top-card__job-title",
               "location": ".topcard__flavor--metadata, .job-details-jobs-unified-top-card__flavor--bullet",
               "workplace": ".job-details-jobs-unified-top-card__job-insight", "job_type": ".description__job-criteria-item",
               "posted": ".posted-time-ago__text, .posted-time-ago, .job-details-jobs-unified-top-card__posted-date, .jobs-unified-top-card__posted-date"})),
}


def _companies(rows: DataFrame) -> DataFrame:
    """Company records from the data blocks of the pages; what these lack comes from the definition list."""
    pages = rows.select("id", "url", F.col("_payload").alias("raw_html"), "error", F.col("scraped_at").alias("updated_at"),
                        X.definition_pairs()(F.col("_payload")).alias("_pairs"))
    records = CO.company_records(pages, ["error", "updated_at", "_pairs"])
    return CO.fill_missing(records, CO.definition_fields(F.col("_pairs"))).drop("_pairs")


def convert(bronze: DataFrame, site_key: str) -> DataFrame:
    """Meta columns of one site's captures; link and escape clean-up applied to the Markdown. A
    capture without payload becomes a row with ``error`` instead of a failure."""
    payload, error = raw_payload()
    rows = bronze.withColumn("_payload", payload).withColumn("error", error)
    if site_key == "linkedin_company":
        return _companies(rows)
    c = CONVERTERS[site_key]
    if not c.from_json:
        rows = rows.withColumn("_x", X.page_fields(**c.fields)(F.col("_payload")))
        if site_key == "geeknews":
            rows = rows.withColumn("comments", X.flatten_comments(F.get(F.col("_x.json_ld"), F.lit(0))))
    source = F.col("_payload") if c.from_json else F.col("_x")
    meta = c.rules(source, F.col("id"), F.col("url"))
    for name in ("raw_content", "content"):
        if name in meta:
            meta[name] = T.clean_markdown_links(meta[name])
    keep = [F.col("id"), F.col("error"), F.col("scraped_at").alias("updated_at")]
    return rows.select(*keep, *[v.alias(k) for k, v in meta.items() if k != "id"])


def silver(meta: DataFrame, site_key: str) -> DataFrame:
    """Silver rows of the captures that converted."""
    return site(site_key).build_document(meta.where("error IS NULL"))


def silver_table(metas: dict[str, DataFrame]) -> DataFrame:
    """One silver table of several sites; fields a site lacks are NULL."""
    out = None
    for key, meta in metas.items():
        part = silver(meta, key)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def topic_html(topic_json, url) -> Column:
    """Page around the first post of a captured topic response; NULL without content."""
    j = col(topic_json)
    title = F.replace(first_filled(json_field(j, "$.title"), F.lit("Unknown Title")), F.lit("<"), F.lit("&lt;"))
    cooked = json_field(j, "$.post_stream.posts[0].cooked")
    return F.when(cooked.isNotNull(), F.concat(
        F.lit("<!DOCTYPE html>\n<html>\n<head><title>"), title, F.lit(' - PyTorchKR</title>\n<link rel="canonical" href="'), col(url),
        F.lit('">\n<meta property="article:published_time" content="'), F.coalesce(json_field(j, "$.created_at"), F.lit("")),
        F.lit('">\n</head>\n<body>\n<div class="post" itemprop="text">'), cooked, F.lit("</div>\n</body>\n</html>")))


def with_topic_fallback(captures: DataFrame, responses: DataFrame, empty: Column) -> DataFrame:
    """Captures whose content came out empty take the page rebuilt from a captured response
    (``id, topic_json``)."""
    j = captures.join(responses.select("id", "topic_json"), "id", "left")
    return j.withColumn("raw_html", F.when(empty, F.coalesce(topic_html("topic_json", "url"), "raw_html")).otherwise(F.col("raw_html"))).drop("topic_json")


def main_containers(pages: DataFrame, key: str, html: str, selector: str) -> DataFrame:
    """Container most paragraphs of a page live in; the first one wins a tie."""
    rows = pages.select(key, F.explode(X.paragraph_containers(selector)(F.col(html))).alias("c")).select(key, "c.container", "c.label")
    counts = rows.groupBy(key, "container", "label").agg(F.count("*").alias("paragraphs"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("paragraphs")).alias("o"), "container", "label", "paragraphs")).alias("b"))
    return best.select(key, "b.container", "b.label", "b.paragraphs")


def listing(pages: DataFrame, key: str, html: str, selectors: list[str], container: str | None = None) -> DataFrame:
    """Titled links of list pages ``key, href, pos, title``: per page only those of the first selector
    that finds any, first occurrence per address."""
    rows = pages.select(key, X.listing_items(selectors, container)(F.col(html)).alias("_items"))
    first_rank = F.array_min(F.transform("_items", lambda i: i["rank"]))
    best = let(first_rank, lambda r: F.filter("_items", lambda i: i["rank"] == r))
    # The outer explode infers no filter on the array, which would run the batch function twice.
    rows = rows.select(key, F.explode_outer(best).alias("i"))
    rows = rows.select(key, "i.href", "i.pos", "i.title").where("title <> ''")
    return first_by_id(rows, ["pos"], [key, "href"])


def job_cards(pages: DataFrame, key: str, html: str, targets: list[str], geo_on: bool = True) -> DataFrame:
    """Job cards of list pages: numeric id, title of two characters or more, one per id and page."""
    found = X.cards('a[href*="/jobs/view/"]', '[class*="company"], [class*="subtitle"], [class*="secondary"]', '[class*="location"], [class*="metadata"]')
    rows = pages.select(key, F.explode(found(F.col(html))).alias("c")).select(key, "c.*").withColumn("job_id", job_id("href"))
    rows = rows.where(F.col("job_id").rlike(r"^\d+\z") & (F.length("title") >= 2))
    place = trim_ws(F.split("location", r"(?i)\d+\s+days?\s+ago|\d+\s+weeks?\s+ago")[0])
    rows = rows.select(key, "job_id", "pos", "title", first_filled("company", F.lit(NO_INFO)).alias("company"),
                       first_filled(place, F.lit(NO_INFO)).alias("location"))
    one = first_by_id(rows, ["pos"], [key, "job_id"]).withColumn("geo", geo_bucket("location"))
    match = F.lit(True) if not geo_on else F.col("geo").isin(targets)
    return one.withColumn("matches_target", match).withColumn("url", F.concat(F.lit("https://www.linkedin.com/jobs/view/"), "job_id"))
