"""Site descriptors: the rules that differ from site to site, as Column builders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import text as T
from .functions import url as U
from .functions.base import contains_any, first_filled
from .functions.geo import standardize_location

ColumnRule = Callable[[Column], Column]


@dataclass(frozen=True)
class SiteSpec:
    """One source site. ``id_rule`` and ``url_filter`` map a URL column; ``document`` maps the
    extracted fields to the silver record; ``weights`` ranks the text-search fields."""

    key: str
    name: str
    id_rule: ColumnRule
    domain: str | None = None
    index_name: str | None = None
    exclude: list[str] = field(default_factory=list)
    url_filter: ColumnRule | None = None
    default_slack: int = 3
    seed_urls: list[str] = field(default_factory=list)
    id_field: str = "id"
    document: dict[str, Callable[[], Column]] = field(default_factory=dict)
    weights: dict[str, int] = field(default_factory=dict)
    page_urls: ColumnRule | None = None

    def passes_filter(self, url: Column) -> Column:
        """Site filter alone; NULL URLs fail it."""
        return F.lit(True) if self.url_filter is None else F.coalesce(self.url_filter(url), F.lit(False))

    def accepts(self, url: Column) -> Column:
        """Site filter and exclude list together; NULL URLs are refused."""
        return F.coalesce(~contains_any(url, self.exclude), F.lit(False)) & self.passes_filter(url)

    def build_document(self, meta: DataFrame) -> DataFrame:
        """Silver rows of one site: its field map with defaults, plus site and update time."""
        cols = [c().alias(n) for n, c in self.document.items()]
        return meta.select(F.lit(self.key).alias("site"), *cols, "updated_at")


_REGISTRY: dict[str, SiteSpec] = {}


def register_site(spec: SiteSpec) -> SiteSpec:
    if spec.key in _REGISTRY:
        raise ValueError(f"site {spec.key!r} is already registered")
    _REGISTRY[spec.key] = spec
    return spec


def site(key: str) -> SiteSpec:
    return _REGISTRY[key]


def all_sites() -> list[SiteSpec]:
    return [_REGISTRY[k] for k in sorted(_REGISTRY)]


def site_key_of_collection(collection) -> Column:
    """Site key of a collection name; job and company collections map to their own sites."""
    c = F.regexp_replace(F.col(collection) if isinstance(collection, str) else collection, "^(silver|bronze)/", "")
    return F.when(c == "linkedin.jobs", "linkedin").when(c == "linkedin.companies", "linkedin_company").otherwise(
        F.substring_index(c, ".", 1))


def index_of_site(key) -> Column:
    """Search index of a site key; unknown sites use their key."""
    names = F.create_map(*[F.lit(x) for s in all_sites() for x in (s.key, s.index_name or s.key)])
    return F.coalesce(F.element_at(names, key), key)


# --- field maps ----------------------------------------------------------------------------------

def _or_null(name: str) -> Callable[[], Column]:
    return lambda: F.nullif(F.col(name), F.lit(""))


def _or_zero(name: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.col(name), F.lit(0))


def _title(name: str = "title") -> Callable[[], Column]:
    return lambda: first_filled(name, F.lit("Untitled"))


def _article(**extra) -> dict[str, Callable[[], Column]]:
    return {"id": lambda: F.col("id"), "title": _title(), "url": _or_null("url"),
            "published_at": lambda: F.col("published_at"), "content": _or_null("content"),
            "markdown": _or_null("raw_content"), **extra}


# Text fields a site search weighs, and by how much.
_ARTICLE_WEIGHTS = {"title": 10, "content": 5, "markdown": 3, "url": 1}
# Paths that never lead to an article.
_NOT_ARTICLES = ["favicon", "login", "logout", "signup"]


def _post_fields() -> dict[str, Callable[[], Column]]:
    return {"id": lambda: F.col("id"), "title": _title(), "url": _or_null("url"), "author": _or_null("author"),
            "summary": _or_null("summary"), "published_at": lambda: F.col("published_at"),
            "reactions_count": _or_zero("reactions_count"), "replies_count": _or_zero("replies_count"),
            "markdown": _or_null("raw_content"), "space_id": _or_null("space_id"),
            "space_name": _or_null("space_name"), "space_slug": _or_null("space_slug")}


# --- site rules ------------------------------------------------------------------------------------

# Archive roots of the economy newsletter site, and path parts it never collects.
ARCHIVE_ROOTS = [
    "/newsletter", "/column-before", "/economy-dictionary", "/economy-news", "/column-before/uppity-original",
    "/column-before/expert-contribution", "/column-before/moneylog", "/newsletter/money-letter",
    "/newsletter/jalsseul-letter", "/newsletter/career-letter", "/2030-research", "/serial",
    "/moneyletter_archive", "/careerletter_archive", "/moneylog", "/news", "/notice", "/uppitag",
    "/bamboo_forest", "/column", "/partnership"]
ARCHIVE_PARTS = ["logout.cm", "login", "join", "signup", "favicon", "logout", "/category/", "/tag/", "/author/",
                 "/page/", "#", "download.cm", "unsubscribe"]


def archive_url_filter(url: Column) -> Column:
    """Detail pages only: no archive root or anything below it, no paging or search; an explicit
    board view is always a detail page."""
    from .functions.base import let

    def rule(p):
        path = F.regexp_replace(p["path"], r"/\z", "")
        below = F.lit(False)
        for root in ARCHIVE_ROOTS:
            below = below | (path == root) | F.startswith(path, F.lit(root + "/"))
        board_view = F.get(F.filter(U.query_pairs(p["query"]), lambda x: x["k"] == "bmode"), F.lit(0))["v"] == "view"
        return (F.when(~p["ok"], False)
                .when(contains_any(p["path"], ARCHIVE_PARTS) | contains_any(p["fragment"], ARCHIVE_PARTS), False)
                .when(board_view, True).when(path == "", False)
                .when(below | path.rlike(r"/\d+\z"), False)
                .when(p["query"] != "", False).otherwise(True))
    return F.coalesce(let(U.url_parts(url), rule), F.lit(False))


def newsletter_post_filter(url: Column) -> Column:
    return F.substring_index(url, "?", 1).rlike(r"^https://maily\.so/josh/posts/[a-zA-Z0-9]+\z")


def topic_list_urls(page: Column) -> Column:
    """Listing addresses of one page of the topic site."""
    root, p = "https://news.hada.io/", page.cast("string")
    first = F.array(*[F.lit(root + x) for x in ("", "new", "weekly/page/1", "plus", "show")])
    later = F.array(F.concat(F.lit(root + "weekly/page/"), p), F.concat(F.lit(root + "plus?page="), p),
                    F.concat(F.lit(root + "show?page="), p))
    front = F.array(F.concat(F.lit(root + "?page="), p))
    return F.when(page == 1, first).when(page <= 5, F.concat(front, later)).otherwise(later)


def section_page_url(page: Column, section: Column | None = None) -> Column:
    base = F.concat(F.lit("https://uppity.co.kr/"), section if section is not None else F.lit("economy-news"), F.lit("/"))
    return F.array(F.when(page == 1, base).otherwise(F.concat(base, F.lit("page/"), page.cast("string"), F.lit("/"))))


def _template_urls(first: str, later: str) -> ColumnRule:
    return lambda page: F.array(F.when(page == 1, F.lit(first)).otherwise(
        F.concat(F.lit(later.split("{}")[0]), page.cast("string"), F.lit(later.split("{}")[1]))))


register_site(SiteSpec(
    "aicasebook", "AI Casebook", lambda u: U.id_by_pattern(u, r"/setup/(\d+)"), "aicasebook.dev", "aicasebook",
    _NOT_ARTICLES, weights={"title": 10, "summary": 5, "body": 3, "markdown": 2, "tags": 8},
    document={"id": lambda: F.col("id"), "title": _title(), "url": _or_null("url"), "summary": _or_null("summary"),
              "author": _or_null("author"), "categories": lambda: F.coalesce("categories", F.array()),
              "tags": lambda: F.coalesce("tags", F.array()), "published_at": lambda: F.col("published_at"),
              "views": _or_zero("views"), "source_link": _or_null("source_link"),
              "series_name": _or_null("series_name"), "content": _or_null("content"),
              "markdown": _or_null("raw_content")}))
register_site(SiteSpec(
    "geeknews", "GeekNews", U.topic_id, "news.hada.io", "geeknews",
    ["vote?", "/vote", "user?", "/user", "item?", *_NOT_ARTICLES], id_field="topicId", page_urls=topic_list_urls,
    weights={**_ARTICLE_WEIGHTS, "company_name": 3},
    document=_article(comments=lambda: F.col("comments"), json_ld_raw=_or_null("json_ld_raw"))))
register_site(SiteSpec(
    "pytorch_kr", "PyTorch KR", lambda u: U.id_by_pattern(u, r"/(\d+)(?:\?|\z)"), "discuss.pytorch.kr", "pytorch_kr",
    _NOT_ARTICLES, weights=_ARTICLE_WEIGHTS, document=_article(),
    page_urls=_template_urls("https://discuss.pytorch.kr/latest.json?no_definitions=true&page=1",
                             "https://discuss.pytorch.kr/latest.json?no_definitions=true&page={}")))
register_site(SiteSpec(
    "dailydose_ds", "Daily Dose of DS", U.canonical_base64, "dailydoseofds.com", "dailydose_ds",
    ["billing.", ".zip", "/content/files/", "NousResearch", "/blogs/", "/docs/", "sitemap", "/signup/",
     "/passwordReset/", "dailydoseofds.com/dailydoseofds.com",
     "dailydoseofds.com/a-crash-course-on-building-rag-systems", *_NOT_ARTICLES],
    weights=_ARTICLE_WEIGHTS, document=_article(),
    page_urls=_template_urls("https://www.dailydoseofds.com/archive/", "https://www.dailydoseofds.com/archive/page/{}/"),
    seed_urls=["https://www.dailydoseofds.com/" + s + "/" for s in (
        "mlops-crash-course-part-1", "rl-course-part-1", "ai-agents-crash-course-part-1-with-implementation",
        "model-context-protocol-crash-course-part-1",
        "a-crash-course-on-building-rag-systems-part-1-with-implementations",
        "bi-encoders-and-cross-encoders-for-sentence-pair-similarity-scoring-part-1",
        "where-did-the-assumptions-of-linear-regression-originate-from",
        "1-fatal-yet-non-obvious-pitfalls-and-cautionary-measures-in-data-science")]))
register_site(SiteSpec(
    "uppity", "Uppity", lambda u: U.canonical_md5(u, drop_page_number=True), "uppity.co.kr", "uppity",
    ["logout.cm", "login", "join", "signup", "favicon", "logout", "unsubscribe"], archive_url_filter,
    weights=_ARTICLE_WEIGHTS, document=_article(), page_urls=section_page_url))
register_site(SiteSpec(
    "yozm", "요즘IT", lambda u: U.id_by_pattern(u, r"/detail/(\d+)/"), "yozm.wishket.com", "yozm", _NOT_ARTICLES,
    weights=_ARTICLE_WEIGHTS, document=_article()))
register_site(SiteSpec(
    "maily_josh", "Josh", U.canonical_md5, "maily.so", "maily_josh",
    ["/users/sign_in", "/users/sign_up", "redirect_path=", "/auth/", *_NOT_ARTICLES], newsletter_post_filter,
    weights=_ARTICLE_WEIGHTS, document=_article(),
    page_urls=_template_urls("https://maily.so/josh?page=1&controller=spaces%2Fpages&action=home&space_url=josh",
                             "https://maily.so/josh?page={}&controller=spaces%2Fpages&action=home&space_url=josh")))
register_site(SiteSpec("gpters", "GPTers News", U.dash_tail_id, "gpters.org", "gpters", _NOT_ARTICLES,
                       id_field="postId", weights=_ARTICLE_WEIGHTS, document=_post_fields()))
register_site(SiteSpec("gpters_newsletter", "GPTers Newsletter", U.dash_tail_id, "gpters.org", "gpters_newsletter",
                       _NOT_ARTICLES, id_field="postId", weights=_ARTICLE_WEIGHTS, document=_post_fields()))
register_site(SiteSpec(
    "linkedin", "LinkedIn Jobs", U.job_id, "www.linkedin.com", "linkedin_jobs", _NOT_ARTICLES, default_slack=0,
    id_field="jobId", weights={"title": 10, "company_name": 5, "content": 3, "markdown": 2},
    document={"id": lambda: F.col("id"), "title": _title("job_title"), "company_name": _or_null("company"),
              "company_id": lambda: F.when(F.coalesce("company", F.lit("")) != "", T.safe_file_name("company", F.lit(""))),
              "content": _or_null("raw_content"), "location": _or_null("raw_location"),
              "geo": lambda: first_filled(standardize_location("raw_location"), F.lit("Unknown")),
              "url": lambda: F.concat(F.lit("https://www.linkedin.com/jobs/view/"), "id"),
              "published_at": lambda: F.col("published_at")}))
register_site(SiteSpec(
    "linkedin_company", "LinkedIn Company", U.last_segment, None, "linkedin_company", _NOT_ARTICLES, default_slack=0,
    id_field="companyId",
    document={"id": lambda: F.col("id"),
              "company_name": lambda: first_filled("company_name", F.lit("Unknown Company")),
              "summary": _or_null("tagline"), "source_link": _or_null("website"), "category": _or_null("industry"),
              "content": _or_null("hq_description")}))
register_site(SiteSpec(
    "ebook", "Ebook", lambda u: F.md5(u), None, "ebook", weights={"title": 10, "content": 5, "markdown": 3},
    document={"id": lambda: F.col("id"), "title": _title(), "book_title": _or_null("book_title"),
              "chapter_index": lambda: F.col("chapter_index"), "content": _or_null("content"),
              "markdown": _or_null("raw_content")}))
