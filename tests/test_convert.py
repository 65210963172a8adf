"""Conversion rules on small pages written for the purpose."""

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import html as H
from corpusflow.operators import company as CO
from corpusflow.operators import convert as CV
from corpusflow.operators import extract as X


def captures(spark, html=None, json=None, url="https://d.com/1", id_="1"):
    df = spark.createDataFrame([(id_, url, html, json)], "id string, url string, raw_html string, raw_json string")
    return df.withColumn("scraped_at", F.lit("2024-01-31 03:00:00").cast("timestamp"))


def meta(spark, site, **kw):
    return CV.convert(captures(spark, **kw), site).collect()[0].asDict()


@pytest.mark.parametrize("given,want", [
    ("<p>a<p>b", "a\n\nb"), ("<h2>T</h2>x <b>y</b> z", "## T\n\nx **y** z"), ("<ul><li>a<li>b</ul>", "-   a\n-   b"),
    ("<ol><li>a</li><li>b</li></ol>", "1.  a\n2.  b"), ("<a href='u'>t</a>", "[t](u)"), ("<img src=s alt=a>", "![a](s)"),
    ("<pre><code class='language-py'>x = [1]\n</code></pre>", "```py\nx = [1]\n```"), ("a<br>b", "a  \nb"), ("<hr>", "---"),
    ("<blockquote><p>q</p></blockquote>", "> q"), ("1. x [y] *z* _w_", "1\\. x \\[y\\] \\*z\\* \\_w\\_"), ("<em> s </em>t", "*s* t"),
    ("<script>no</script><nav>no</nav>yes", "yes"), ("a &amp;amp; b", "a &amp; b"), ("<code>a`b</code>", "`a`b`"),
    ("<ul><li>a<ul><li>b</li></ul></li></ul>", "-   a\n    -   b")])
def test_markdown(given, want):
    assert H.to_markdown(H.parse(given)) == want


@pytest.mark.parametrize("sel,n", [("a", 2), ("#x", 1), (".c", 1), ("div a", 1), ("[href]", 2), ('a[href^="/p"]', 1), ('a[href*="q"]', 2), ("p, a", 3), ("a.c[href]", 1)])
def test_selectors(sel, n):
    root = H.parse('<div id=x><a class="b c" href="/pq">1</a></div><a href="q">2</a><p>3')
    assert len(list(H.select(root, sel))) == n


def test_article_cascades(spark):
    body = "words " * 20
    m = meta(spark, "uppity", html=f'<title>T - UPPITY x</title><link rel="canonical" href="https://c"><time datetime="2024-01-02">d</time><article>{body}</article>')
    assert (m["title"], m["url"], str(m["published_at"])) == ("T", "https://c", "2024-01-02 00:00:00") and m["content"] == body.strip()
    assert "* **작성일:** 2024-01-02T00:00:00.000Z" in m["raw_content"]
    m = meta(spark, "uppity", html='<meta property="og:title" content="OG"><article>short</article><body>whole</body>')
    assert m["title"] == "OG" and "정보 없음" in m["raw_content"] and m["published_at"] is None


def test_topic_with_comment_tree(spark):
    ld = ('{"datePublished": "2024-01-02T00:00:00Z", "comment": {"text": "one", "url": "x?id=7&a", "author": {"name": "A"}, '
          '"comment": [{"text": "two"}, {"comment": [{"text": "three"}]}]}}')
    m = meta(spark, "geeknews", html=f'<title>T | GeekNews</title><script type="application/ld+json">{ld}</script>'
             '<div class="topictitle"><a href="/go">t</a></div><div class="topicdesc">* <b>x</b></div>')
    assert [(c["comment_id"], c["author"], c["content"]) for c in m["comments"]] == [("7", "A", "one"), ("", "Unknown", "two"), ("", "Unknown", "three")]
    assert m["url"] == "https://news.hada.io/go" and "## 💬 댓글 및 토론 (3개)" in m["raw_content"]


def test_magazine(spark):
    ld = '{"@type": "NewsArticle", "datePublished": "2024-01-02", "articleSection": "Dev", "author": {"name": "요즘IT"}}'
    m = meta(spark, "yozm", html=f'<title>T | 요즘IT</title><script type="application/ld+json">{ld}</script><a href="/magazine/@me">Me</a>'
             f'<div id="S:3"><p class="typo-contents16">{"a" * 60}</p><blockquote><p class="typo-contents16">b</p></blockquote></div><div id="o"><p class="typo-contents16">c</p></div>')
    assert (m["title"], m["category"], m["author"]) == ("T", "Dev", "Me") and "b" in m["content"] and "c" not in m["content"]
    m = meta(spark, "yozm", html='<title>T</title><script type="application/ld+json">{"@type":"NewsArticle","articleBody":"x&lt;br&gt;y"}</script>')
    assert m["content"] == "x\ny"


def test_newsletter(spark):
    m = meta(spark, "maily_josh", html='<meta property="og:title" content="T"><h2><a href="/c/x">Cat</a></h2><span class="text-slate-600">2024.01.02</span>'
             '<span class="text-slate-600">조회 1.2K</span><article class="post-body-narrow"><p>body</p></article>')
    assert (m["title"], m["category"], m["view_count"], m["content"], str(m["published_at"])[:10]) == ("T", "Cat", "1.2K", "body", "2024-01-02")


def test_casebook(spark):
    m = meta(spark, "aicasebook", html='<title>T</title><meta name="keywords" content="LLM_APPLICATION, a"><meta property="article:published_time" content="1700000000000">'
             '<a target="_blank" href="https://aicasebook.dev/x">in</a><a target="_blank" href="https://o.com">out</a><div class="markdown-body"><ul><li>x</li></ul></div>조회 42')
    assert (m["tags"], m["categories"], m["views"], m["source_link"]) == (["LLM_APPLICATION", "a"], ["LLM 응용"], 42, "https://o.com")
    assert str(m["published_at"]) == "2023-11-14 22:13:20" and m["content"] == "*   x"


def test_forum_fallback_and_courses(spark):
    page = CV.topic_html(F.lit('{"title": "a<b", "created_at": "2024-01-02T00:00:00Z", "post_stream": {"posts": [{"cooked": "<p>hi</p>"}]}}'), F.lit("https://t/1"))
    html = spark.range(1).select(page.alias("h")).collect()[0]["h"]
    m = meta(spark, "pytorch_kr", html=html)
    assert m["title"] == "a<b" and m["content"] == "a<b\nhi" and m["url"] == "https://t/1"
    m = meta(spark, "dailydose_ds", html='<h1>H</h1><main><p>x</p><aside>no</aside></main><a href="https://www.dailydoseofds.com/c">My Course</a><a href="/c">course</a>')
    assert m["title"] == "H" and m["content"] == "x" and m["discovered_urls"] == ["https://www.dailydoseofds.com/c"]


def test_posts(spark):
    m = meta(spark, "gpters", json='{"title":"T","fields":[{"key":"content","value":"a\\\\nb"}],"createdAt":"2024-01-02T00:00:00Z","space":{"id":"s","name":"S"}}', url="https://g/1")
    assert (m["title"], m["author"], m["summary"], m["reactions_count"], m["space_name"]) == ("T", "Unknown", "a\nb", 0, "S")
    m = meta(spark, "gpters", json="plain text", url="https://g/1")
    assert m["title"] == "No Title" and m["summary"] == "plain text"


def test_jobs(spark):
    m = meta(spark, "linkedin", id_="4421619932", url="https://l/1", html='<title>Dev | Acme | LinkedIn</title><div><span>Seoul, South Korea</span><span>2 weeks ago</span>'
             '<span>Remote</span><button>Easy Apply</button></div><div class="description__text"><p>About Acme</p><p>We</p><p>Requirements</p><p>x</p></div>')
    assert (m["job_title"], m["company"], m["raw_location"], m["workplace_type"], m["apply_type"]) == ("Dev", "Acme", "Seoul, South Korea", "Remote", "간편 지원 (Easy Apply)")
    assert m["posted_date"] == "2024-01-17 12:00:00" and m["raw_content"].endswith("Requirements\n\nx\n")


def test_error_rows_instead_of_failures(spark):
    m = CV.convert(captures(spark), "uppity")
    assert m.collect()[0]["error"] and CV.silver(m, "uppity").count() == 0


def test_main_container_tie_goes_to_the_first(spark):
    p = spark.createDataFrame([(1, '<div id="a"><p>1</p><p>2</p></div><div id="b"><p>3</p><p>4</p></div>')], "k int, h string")
    assert CV.main_containers(p, "k", "h", "p").collect()[0]["label"] == "div#a"


def test_minify_and_audit(spark):
    h = '<html><head><script>1</script><script type="application/ld+json">{}</script></head><body><!-- c --><p style="x" class="k" data-z="1">t</p><footer>f</footer></body></html>'
    df = spark.createDataFrame([(h,)], "h string")
    plain, kept = df.select(X.minify()(F.col("h")), X.minify(keep_jsonld=True)(F.col("h"))).collect()[0]
    assert '<p class="k">t</p>' in plain and "script" not in plain and "footer" not in plain and "ld+json" in kept and "<!--" not in plain
    a = df.select(F.explode(X.selector_audit(["p", ".none"])(F.col("h"))).alias("a")).select("a.*").collect()
    assert [(r["selector"], r["count"], r["text_length"], r["preview"]) for r in a] == [("p", 1, 1, "t..."), (".none", 0, 0, "")]


def test_company_page(spark):
    ent = '{"$type":"organization.Company","universalName":"ACME","name":" Ac  me ","specialities":["a","b"],"employeeCountRange":{"start":10,"end":50},"headquarter":{"address":{"line1":"L","country":"KR"}}}'
    h = f'<title>Other: About | LinkedIn</title><code id="b"><!--{{"included":[{{"$type":"organization.Company","universalName":"first"}},{ent}]}}--></code>'
    df = spark.createDataFrame([("acme", "https://l/c/acme", h), ("x", "https://l/c/x", "<title>X Co | LinkedIn</title>")], "id string, url string, raw_html string")
    r = {x["id"]: x for x in CO.company_records(df).collect()}
    assert (r["acme"]["company_name"], r["acme"]["company_size"], r["acme"]["hq_location"], r["acme"]["specialties"]) == ("Ac me", "10-50 employees", "L, KR", "a, b")
    assert r["x"]["company_name"] == "X Co" and r["x"]["industry"] == "정보 없음"
    md = {x["id"]: x["markdown"] for x in CO.company_markdown(CO.company_records(df)).collect()}
    assert 'company_size: "10-50 employees"' in md["acme"] and "* a\n* b" in md["acme"]


def test_company_site_converts(spark):
    page = "<title>X Co | LinkedIn</title><dl><dt>Website</dt><dd>http://x</dd><dt>Industry:</dt><dd>Tools</dd></dl>"
    df = spark.createDataFrame([("x", "https://l/c/x", page, None, "2024-01-01"), ("y", "https://l/c/y", None, None, "2024-01-01")],
                               "id string, url string, raw_html string, raw_json string, scraped_at string")
    meta = CV.convert(df, "linkedin_company")
    r = {x["id"]: x for x in meta.collect()}
    assert (r["x"]["website"], r["x"]["industry"], r["x"]["founded"], r["x"]["error"]) == ("http://x", "Tools", "정보 없음", None)
    assert r["y"]["error"] is not None
    assert [(x["site"], x["company_name"], x["category"]) for x in CV.silver(meta, "linkedin_company").collect()] == [("linkedin_company", "X Co", "Tools")]


def test_broken_markup_is_linear_and_whole():
    import time
    start = time.time()
    for bad in ("<a title='x " * 20000, '<p a="' * 20000 + "<" * 50000, "<!--" * 50000, "<div>" * 3000 + "x", "<script>" * 20000, "<b" * 50000):
        H.parse(bad)
    assert time.time() - start < 20
    text = lambda h: H.squeeze(H.parse(h).text())
    assert text("a < b <p don't>c</p> 1<2") == "a < b c 1<2"
    assert [n.attrs for n in H.parse("<a href=/x/ title=it's HREF=y>t</a>").walk()] == [{"href": "/x/", "title": "it's"}]
    assert text("<title>A &amp; <b></title>x<textarea><p></textarea>") == "A & <b>x<p>"


def test_deep_nesting(spark):
    df = spark.createDataFrame([("<div>" * 20000 + "deep",)], "h string")
    assert df.select(X.markdown()(F.col("h")).alias("m")).collect()[0]["m"] == "deep"
    assert "deep" in df.select(X.minify()(F.col("h")).alias("m")).collect()[0]["m"]


def test_results_leave_in_pieces(spark):
    """What Python holds is bounded by some pages, not by the Arrow batch: a batch of results is small whatever came in."""
    import pandas as pd
    from corpusflow.operators import extract as X
    for fn, of in ((X.minify(), pd.Series), (X.page_fields(), pd.DataFrame)):
        html = pd.Series([f"<title>t{i}</title>" for i in range(3 * X.PAGES + 1)])
        parts = list(fn.func(iter([html, html[:0]])))
        assert all(isinstance(p, of) for p in parts) and [len(p) for p in parts] == [X.PAGES] * 3 + [1]
