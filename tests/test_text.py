import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.functions import geo as G
from corpusflow.functions import jsonx as J
from corpusflow.functions import text as T


@pytest.mark.parametrize("given,want", [
    ("<p>Hi <b>x</b></p>", "Hi x"),
    ("intro text - first one - second one - third one", "- intro text\n- first one\n- second one\n- third one"),
    ("one - two - three", "one - two - three"),                                 # two separators are no list
    ("aaa - b - ccc - ddd", "aaa - b - ccc - ddd"),                             # a part below three characters
    ("aaa - bbb - ccc - ddd\n\nmore", "aaa - bbb - ccc - ddd\n\nmore"),         # too many lines
    ("\\- item", "- item"), ("* '#10345'\nbody", "body"), ("#10345 body", "body"),
    ("* one\n  * two", "- one\n- two"), ("## Head\n### Sub", "### Head\n#### Sub"), ("# Top", "# Top"), ("", "")])
def test_clean_content(ev, given, want):
    assert ev(T.clean_content, given) == want


@pytest.mark.parametrize("given,want", [
    ("[x](javascript:void(0)) a", ") a"), ("[ \n title \n more \n ]( u )", "[title more](u)"),
    ("[ ![a](i) \n ]( l )", "[![a](i)](l)"), ("![a]( s r c )", "![a](src)"), ("\\[x\\] \\*y\\*", "[x] *y*"), (None, ""),
    ("[a](b) and [c\n d](e)", "[a](b) and [c d](e)")])
def test_clean_links(ev, given, want):
    assert ev(T.clean_markdown_links, given) == want


def test_reader_view(ev):
    assert ev(T.view_markdown, "---\na: b\n---\nbody\n## 💬 댓글 (2)\nx") == "body"
    assert ev(T.view_markdown, "intro 😀\n## 📝 JD\nreal 😀 part\n## 💬 Comments\nno") == "## 📝 JD\nreal 😀 part"
    assert ev(T.view_markdown, None) == ""


def test_metadata_table(spark):
    no = F.lit(None).cast("string")
    md = spark.range(1).select(T.metadata_table(F.lit("T"), F.lit(""), no, F.lit("7"), F.lit("silver/geek_news.contents"), no, no, no).alias("m")).collect()[0]["m"]
    assert "| **Title (제목)** | T |" in md and "Company" not in md and "| **Source (출처)** | Geek news (`silver/geek_news.contents`) |" in md


def test_names(ev):
    assert ev(T.safe_file_name, "a/b: c", "X &amp; Y") == "X & Y - a b c"
    assert ev(T.safe_file_name, "", "") == "정보 없음 - 정보 없음"
    assert len(ev(T.safe_file_name, "x" * 200, "c")) == 80
    assert ev(T.book_file_name, 'A  "B"?') == "A B" and len(ev(T.book_file_name, "y" * 200)) == 120
    assert ev(T.mail_file_name, "") == "Untitled_Mail" and ev(T.book_output_name, "Book.PDF") == "Book"
    assert ev(T.collection_label, "silver/geekNews_x.contents") == "Geek News x"
    assert ev(T.dashboard_label, "silver/linkedin.jobs") == "LinkedIn Jobs"


def test_mail_rules(ev):
    assert ev(T.mail_noise, "a&nbsp;b ![](x) [](y) [ c \n d ]( e ) [unsubscribe](z)") == "a b   [c d](e)"
    assert ev(T.plain_text, "# A [b](c) **d**\n- e") == "A b d e"


@pytest.mark.parametrize("given,want", [
    ("a\nb", "a b"), ("a.\nb", "a.\nb"), ("a\n- b", "a\n- b"), ("a\n\n\n\nb", "a\n\nb"), ("a\n1. b", "a\n1. b"), ("a  b", "a b"),
    ("  a\n  b\n", " a b"), ("a:\nb\nc", "a:\nb c")])
def test_reflow(ev, given, want):
    assert ev(T.reflow_markdown, given) == want


def test_truncation_edges(ev):
    text = lambda n: "\n".join(str(i) for i in range(n))
    assert ev(T.truncate_lines, text(150)) == text(150)
    got = ev(T.truncate_lines, text(151)).split("\n")
    assert "[Truncated 1 lines" in "".join(got) and got[:50] == [str(i) for i in range(50)] and got[-100:] == [str(i) for i in range(51, 151)]


def test_small_scalars(ev):
    assert ev(T.thousands, 1234567) == "1,234,567" and ev(T.duration_text, 3661) == "1h 1m 1s" and ev(T.duration_text, 59) == "59s"
    assert ev(T.bytes_text, 0) == "0 B" and ev(T.bytes_text, 1536) == "1.5 KB" and ev(T.bytes_text, 1024 ** 3) == "1 GB"
    assert ev(T.strip_ansi, "\x1b[31mred\x1b[0m") == "red" and ev(T.compact_lines, " a \n\n<!-- c\nb") == "a\nb"
    assert ev(lambda c: T.relativize(c, "/ws"), "see /ws/a and /ws") == "see ./a and ./"
    assert ev(T.natural_key, "Ch 10") > ev(T.natural_key, "Ch 9")
    assert ev(T.summary_line, "x" * 99 + "\ny") == "x" * 60 and ev(T.learnings_section, "a\n## Learnings\nb") == "## Learnings\nb"


def test_job_description(ev):
    split = lambda text, company: ev(T.jd_split, text, company)
    assert split("About Acme\nwe\nResponsibilities\nx", "Acme") == "Responsibilities\nx"
    assert split("short\nRequirements\nx", "") == "short\nRequirements\nx"
    assert split("a text of twenty chars or more\nRequirements:\nx", "") == "Requirements:\nx"
    assert split("회사 소개\n😀😀\n자격 요건\nx", "Acme") == "자격 요건\nx"


@pytest.mark.parametrize("given,want", [
    ("3 weeks ago", "2024-01-10"), ("2일 전", "2024-01-29"), ("1 month ago", "2024-01-01"), ("5 hours ago", "2024-01-31"),
    ("2 years ago", "2022-01-31"), ("nothing", "2024-01-30")])
def test_relative_date(ev, given, want):
    got = ev(lambda t: D.relative_date(t, F.lit("1 day ago"), F.lit("2024-01-31 03:00:00")), given)
    assert got == want + " 12:00:00"


@pytest.mark.parametrize("given,want", [
    ("2026.06.20", "2026-06-20 00:00"), ("2024-01-02T03:04:05.678Z", "2024-01-02 03:04"), ("2024-01-02T03:04:05+09:00", "2024-01-01 18:04"),
    ("June 5, 2024", "2024-06-05 00:00"), ("Jan 5, 2024", "2024-01-05 00:00"), ("soon", None), ("12:30", None), ("", None), (None, None)])
def test_safe_timestamp(ev, given, want):
    got = ev(lambda t: F.date_format(D.safe_timestamp(t), "yyyy-MM-dd HH:mm"), given)
    assert got == want


def test_dates(spark, ev):
    day = ev(lambda t: D.kst_day(t), "2024-01-01 15:00:00")
    assert day == dt.date(2024, 1, 2)
    assert ev(lambda t: D.published_at(F.lit(None).cast("string"), t, F.lit(None).cast("string"), F.lit(None).cast("string")).cast("string"),
              "1700000000000") == "2023-11-14 22:13:20"
    assert ev(lambda t, s: D.mail_uid(t, s), "2024-01-01 15:00:00", " A@b.c ") == ev(lambda t, s: D.mail_uid(t, s), "2024-01-01 15:00:00", "a@b.c")


@pytest.mark.parametrize("given,want", [
    ("Seoul, Korea", "South Korea"), ("Berlin", "Germany"), ("전주", "South Korea"), ("Lima/Peru", "Lima Peru"), ("", "unknown-location"),
    ("Sydney, Australia", "United States"), ("Moscow, Russia", "United States"), ("Helsinki, Finland", "Netherlands"), ("ÜBERALL", "ÜBERALL")])
def test_locations(ev, given, want):
    assert ev(G.standardize_location, given) == want


def test_location_options(ev, tmp_path):
    assert ev(lambda c: G.standardize_location(c, mode="word"), "Moscow, Russia") == "Moscow, Russia"
    assert ev(G.geo_bucket, "Atlantis") == "Others" and ev(G.country_name, "kr") == "South Korea" and ev(G.country_name, "zz") == "ZZ"
    f = tmp_path / "aliases.json"
    f.write_text('{"Utopia": ["Nowhere"]}', encoding="utf-8")
    assert ev(lambda c: G.standardize_location(c, G.load_aliases(str(f))), "in nowhere land") == "Utopia"


def test_json(ev):
    assert ev(J.as_json_array, '{"a":1}') == ['{"a":1}'] and ev(J.as_json_array, '[{"a":1},{"b":2}]') == ['{"a":1}', '{"b":2}']
    assert ev(lambda c: J.json_field(c, "$.x", "$.y"), '{"x":"","y":"z"}') == "z" and ev(lambda c: J.json_field(c, "$.x"), "broken") is None
    assert ev(J.unescape, 'a\\nb\\"c\\\\n') == 'a\nb"c\\n'


def test_link_rules_pass_over_blanks_once(ev):
    """Runs of blanks after an open bracket are not tried at every length."""
    blanks = " " * 3000
    assert ev(T.clean_markdown_links, "a [" + blanks + "x") == "a [" + blanks + "x"


def test_job_description_patterns_run_once(spark):
    """Each of the four patterns of the rule stands in the plan once."""
    df = spark.createDataFrame([("long enough opening text\nRequirements\nx", "Src")], "md string, company string")
    out = df.select(T.jd_split("md", F.col("company")).alias("jd"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") <= 3
    assert out.first()["jd"] == "Requirements\nx"
