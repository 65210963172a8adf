import pytest
from pyspark.sql import functions as F

from corpusflow.functions import url as U
from corpusflow import sites as S


@pytest.mark.parametrize("given,want", [
    ("https://x.com/a?utm_source=s&b=1&ref=r", "https://x.com/a?b=1"),
    ("https://x.com/a?a=1&b=2&a=3", "https://x.com/a?a=3&b=2"),
    ("https://x.com/a?fbclid=1", "https://x.com/a"),
    ("https://x.com/a#top", "https://x.com/a"),
    ("https://X.com:443/a/../b/./c", "https://x.com/b/c"),
    ("http://x.com:8080", "http://x.com:8080/"),
    ("https://x.com/a$%7Bid", "https://x.com/a"),
    ("https://x.com/post한글", "https://x.com/post"),
    ("https://x.com/post%EA%B0%80%20", "https://x.com/post"),
    ("https://x.com/a?q=a b", "https://x.com/a?q=a+b"),
    ("not a url한", "not a url"), ("", ""), (None, None)])
def test_strip_tracking(ev, given, want):
    assert ev(U.strip_tracking, given) == want
    if want:
        assert ev(U.strip_tracking, want) == want


def test_strip_tracking_keeps_noise_on_request(ev):
    assert ev(lambda c: U.strip_tracking(c, strip_noise=False), "https://x.com/%EA%B0%80") == "https://x.com/%EA%B0%80"


@pytest.mark.parametrize("given,want", [
    ("/a", "https://d.com/a"), ("a/b", "https://d.com/a/b"), ("../x", "https://d.com/x"), ("//e.com/x", "https://e.com/x"),
    ("e.com/x", "https://e.com/x"), ("?q=1", "https://d.com/?q=1"), ("#t", "https://d.com/#t"), ('"/q"', "https://d.com/q"),
    ("mailto:a", None), ("javascript:void(0)", None), ("/a b", None), ("/{id}", None), ("/a$$b", None), ("/library", None)])
def test_resolve_href(ev, given, want):
    assert ev(lambda c: U.resolve_href(c, F.lit("d.com")), given) == want


def test_loose_reject_rule_is_optional(ev):
    assert ev(lambda c: U.resolve_href(c, F.lit("d.com"), compat=False), "/library") == "https://d.com/library"


@pytest.mark.parametrize("host,domain,want", [("d.com", "d.com", True), ("a.d.com", "d.com", True), ("d.com", "www.d.com", True),
                                             ("com", "d.com", False), ("xd.com", "d.com", False)])
def test_same_domain(ev, host, domain, want):
    assert ev(U.same_domain, host, domain) is want


@pytest.mark.parametrize("given,want", [
    ("https://s.com/?u=https%3A%2F%2Fd.com%2Fa", "https://d.com/a"), ("https://s.com/?url=https://d.com/b&u=https://d.com/a", "https://d.com/b"),
    ("https://s.com/?u=https://e.com/a", None), ("https://s.com/", None)])
def test_shared_target(ev, given, want):
    assert ev(lambda c: U.shared_target(c, F.lit("d.com")), given) == want


@pytest.mark.parametrize("given,want", [("https://x/a.PDF", True), ("https://x/a.js.map", True), ("https://x/a.js", False),
                                       ("https://x/a?f=b.zip", False), ("x.zip", False)])
def test_binary(ev, given, want):
    assert ev(U.is_binary_url, given) is want


@pytest.mark.parametrize("given,want", [
    ("https://l.com/jobs/view/dev-at-x-4421619932?a=1", "4421619932"), ("https://l.com/view/123456789/", "123456789"),
    ("https://l.com/view/x1234567y", "1234567"), ("https://l.com/" + "a" * 60, "a" * 50)])
def test_job_id(ev, given, want):
    assert ev(U.job_id, given) == want


@pytest.mark.parametrize("given,want", [("https://l.com/company/caf%C3%A9/about", "café"), ("https://l.com/compay/x?y=1", "x"),
                                       ("https://l.com/z/", "z"), ("https://l.com/company/a%zz", "a%zz")])
def test_company_id(ev, given, want):
    assert ev(U.company_id, given) == want


def test_site_id_rules(ev):
    rule = lambda k, u: ev(S.site(k).id_rule, u)
    assert rule("geeknews", "https://news.hada.io/topic?id=12&x=1") == "12"
    assert rule("geeknews", "https://news.hada.io/weekly/202401") == "weekly-202401"
    assert rule("pytorch_kr", "https://discuss.pytorch.kr/t/a/10492?u=1") == "10492"
    assert rule("yozm", "https://yozm.wishket.com/magazine/detail/3800/") == "3800"
    assert rule("gpters", "https://g.org/news/post/title-abcDEF123456789") == "abcDEF123456789"
    assert rule("gpters", "https://g.org/news/post/title-short") == ""
    assert rule("aicasebook", "https://aicasebook.dev/setup/7") == "7"
    assert rule("linkedin_company", "https://l.com/company/acme/") == "acme"
    same = {rule("maily_josh", u) for u in ("http://www.maily.so/josh/posts/a/", "https://maily.so/josh/posts/a")}
    assert len(same) == 1 and len(same.pop()) == 32
    assert rule("uppity", "https://uppity.co.kr/x/2") == rule("uppity", "https://www.uppity.co.kr/x")
    assert rule("dailydose_ds", "https://www.dailydoseofds.com/a/") == rule("dailydose_ds", "https://dailydoseofds.com/a")


@pytest.mark.parametrize("url,want", [
    ("https://uppity.co.kr/good-article/", True), ("https://uppity.co.kr/news/x", False), ("https://uppity.co.kr/newsletter", False),
    ("https://uppity.co.kr/", False), ("https://uppity.co.kr/news?bmode=view&idx=1", True), ("https://uppity.co.kr/a?q=1", False),
    ("https://uppity.co.kr/a/page/2", False), ("https://uppity.co.kr/tag/x", False), ("https://uppity.co.kr/a/12", False), ("nope", False)])
def test_archive_filter(ev, url, want):
    assert ev(S.archive_url_filter, url) is want


def test_registry_refuses_duplicates():
    with pytest.raises(ValueError):
        S.register_site(S.SiteSpec("uppity", "again", U.job_id))
    assert len(S.all_sites()) == 12


def test_listing_keys(ev):
    assert ev(U.listing_key, "https://l.com/s?a=1&start=25&b=2") == "https://l.com/s?a=1&b=2"
    assert ev(U.listing_key, "https://l.com/s?start=25") == "https://l.com/s"
    assert ev(U.listing_path, "https://n.io/weekly/page/3") == "/weekly"


def _search(spark, config, **kw):
    from corpusflow.operators.generate import search_urls, with_direct_urls
    rows = [(t.get("keywords"), t.get("location"), t.get("geo_id"), t.get("enabled"), t.get("start"), t.get("max_page")) for t in config["targets"]]
    df = spark.createDataFrame(rows, "keywords array<string>, location string, geo_id string, enabled boolean, start int, max_page int")
    out = search_urls(df, config.get("geo", {}), config.get("params", {}), config.get("settings", {}))
    direct = spark.createDataFrame([(u,) for u in config.get("direct", [])], "url string")
    return [r["url"] for r in with_direct_urls(out, direct, **kw).orderBy("origin", "url").collect()]


def test_search_url_generation(spark):
    base = "https://www.linkedin.com/jobs/search/?"
    one = {"targets": [dict(keywords=["a b"], location="Korea")], "geo": {"Korea": "105"}}
    assert _search(spark, one) == [base + "keywords=a+b&geoId=105"]
    assert _search(spark, {"targets": [dict(keywords=["x"], location="Mars")]}) == [base + "keywords=x&location=Mars"]
    assert _search(spark, {"targets": [dict(keywords=["x"], location="Mars", geo_id="9")]}) == [base + "keywords=x&geoId=9"]
    assert _search(spark, {"targets": [dict(keywords=["x"], enabled=False)], "direct": [" https://d "]}) == ["https://d"]
    assert _search(spark, {"targets": [], "direct": ["https://d"]}, skip_direct=True) == []
    paged = {"targets": [dict(keywords=["x"], max_page=3)], "settings": {"max_page": 1, "sortBy": "DD", "start": 5}}
    assert _search(spark, paged) == [base + "keywords=x&sortBy=DD" + s for s in ("&start=25", "&start=5", "&start=50")]
    product = {"targets": [dict(keywords=["x", "y"])], "params": {"f_TPR": {"week": "r6"}},
               "settings": {"f_TPR": ["week", "any time"], "distance": [5, 10]}}
    got = _search(spark, product)
    assert len(got) == 8 and base + "keywords=x&distance=5&f_TPR=r6" in got and base + "keywords=y&distance=10" in got
