"""Markdown, HTML-text and naming rules as native Columns.

Rewrites *inside* a match (link titles, link targets) are done by marking the match with
private-use characters, splitting on them and rewriting the pieces; no Python row function is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import WS, col, drop_matches, first_filled, let, lines_of, match_group, trim_ws

_A, _B, _C = "\ue000", "\ue001", "\ue002"      # marks around the pieces of a match


def _rewrite_links(text: Column, pattern: str, build) -> Column:
    """Replace every ``pattern`` match (group 1 = title, group 2 = target) by ``build(title, target)``."""
    marked = F.regexp_replace(text, pattern, f"{_A}$1{_B}$2{_C}")

    def piece(seg, i):
        title = F.substring_index(seg, _B, 1)
        rest = F.substring(seg, F.length(title) + 2, F.length(seg))
        target = F.substring_index(rest, _C, 1)
        tail = F.substring(rest, F.length(target) + 2, F.length(rest))
        return F.when(i == 0, seg).otherwise(F.concat(build(title, target), tail))
    return F.array_join(F.transform(F.split(marked, _A), piece), "")


# Blanks around a title are part of it here and trimmed later: a pattern of their own would be tried again at every place.
_LINK = r"\[([\s\S]*?)\]\(([^)]+)\)"


def clean_markdown_links(md) -> Column:
    """Drop ``javascript:`` links, pull image links and titles onto one line, remove spaces in
    targets, undo bracket and emphasis escapes."""
    t = F.regexp_replace(F.coalesce(col(md), F.lit("")),
                         r"(?i)\[[\s\S]*?\]\(javascript\s*:\s*.*?\)", "")
    t = _rewrite_links(t, r"\[\s*(!\[[\s\S]*?\]\([^)]+\))\s*\]\(([^)]+)\)",
                       lambda image, url: F.concat(F.lit("["), image, F.lit("]("), trim_ws(url), F.lit(")")))
    t = _rewrite_links(t, _LINK, lambda title, url: F.concat(
        F.lit("["), F.regexp_replace(trim_ws(title), r"\s*\n\s*", " "), F.lit("]("), trim_ws(url), F.lit(")")))
    t = _rewrite_links(t, r"(\])\(([^)]*)\)", lambda br, url: F.concat(
        br, F.lit("("), F.regexp_replace(url, WS + "+", ""), F.lit(")")))
    return F.regexp_replace(t, r"\\([!\[\]*_])", "$1")


def clean_content(text) -> Column:
    """Topic body clean-up: tags out, a flattened dash list back to bullets, leading article number
    out, ``*`` markers to ``-``, headings of level 2+ one level down."""
    dash = WS + "+-" + WS + "+"

    def bullets(c):
        parts = F.transform(F.split(c, dash), trim_ws)
        is_list = (F.regexp_count(c, F.lit(dash)) >= 3) & (F.regexp_count(c, F.lit("\n")) <= 1) \
            & F.forall(parts, lambda p: F.length(p) >= 3)
        return F.when(is_list, F.array_join(F.transform(parts, lambda p: F.concat(F.lit("- "), p)), "\n")).otherwise(c)
    c = let(F.regexp_replace(col(text), "<[^>]*>", ""), bullets)
    c = F.regexp_replace(c, r"""^\*?\s*['"#]*\d+\s*['"]*\s*\n?""", "")
    c = F.regexp_replace(c, r"(?m)^[ \t]*\*[ \t]", "- ")
    c = F.regexp_replace(c, r"(?m)^\\- ", "- ")
    c = F.regexp_replace(c, r"(?m)^(#{2,})\s", "#$1 ")
    return F.regexp_replace(c, rf"^{WS}+", "")


# Section headings the reader view starts at and stops before.
JD_HEADING = "(?i:## 📝 JD)"
COMMENTS_HEADING = "(?i:## 💬 댓글|## 💬 Discussion|## 💬 Comments)"


def _cut_front_matter(c: Column) -> Column:
    end = F.locate("---", c, 4)
    return F.when(F.startswith(c, F.lit("---")) & (end > 0),
                  trim_ws(F.substring(c, end + 3, F.length(c)))).otherwise(c)


def view_markdown(md, cut_comments: bool = True) -> Column:
    """Reader view: front matter out, start at the job description, stop before the comments."""
    c = let(trim_ws(F.coalesce(col(md), F.lit(""))), _cut_front_matter)
    # Cutting is done by the regex itself: match positions count UTF-16 units, substring code points.
    c = let(c, lambda x: F.coalesce(trim_ws(match_group(x, f"({JD_HEADING}[\\s\\S]*)")), x))
    if not cut_comments:
        return c
    return let(c, lambda x: F.when(x.rlike(COMMENTS_HEADING), trim_ws(
        F.regexp_replace(x, f"(?:{COMMENTS_HEADING})[\\s\\S]*\\z", ""))).otherwise(x))


def optional_lines(*pairs: tuple[Column, Column]) -> Column:
    """Array of the lines whose value is filled: ``(value, line)`` pairs, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit("")) != "", line) for v, line in pairs]))


def collection_label(collection) -> Column:
    """Reader-facing name of a collection: prefix and kind out, words split, first letter upper."""
    c = F.regexp_replace(F.regexp_replace(col(collection), "^silver/", ""), r"\.(jobs|companies|contents)\z", "")
    return display_label(c, r"[_-]")


def display_label(c, blanks: str = "_") -> Column:
    split = F.regexp_replace(F.regexp_replace(col(c), "([a-z])([A-Z])", "$1 $2"), blanks, " ")
    return F.concat(F.upper(F.substring(split, 1, 1)), F.substring(split, F.lit(2), F.length(split)))


# Dashboard names of the two merged collections.
DASHBOARD_NAMES = {"linkedin.jobs": "LinkedIn Jobs", "linkedin.companies": "LinkedIn Co."}


def dashboard_label(collection) -> Column:
    c = F.regexp_replace(F.regexp_replace(col(collection), r"\.contents", ""), "silver/", "")
    for name, label in DASHBOARD_NAMES.items():
        c = F.replace(c, F.lit(name), F.lit(label))
    return let(c, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x))))


def metadata_table(title, company, location, doc_id, collection, space, url, date) -> Column:
    """Markdown table of the filled metadata fields."""
    source = F.concat(F.lit("| **Source (출처)** | "), collection_label(collection), F.lit(" (`"), col(collection), F.lit("`) |"))
    row = lambda label, v: (col(v), F.concat(F.lit(f"| **{label}** | "), col(v), F.lit(" |")))
    rows = optional_lines(
        row("Title (제목)", title), row("Company (회사)", company), row("Location (위치)", location),
        (col(doc_id), F.concat(F.lit("| **Document ID** | `"), col(doc_id), F.lit("` |"))),
        (col(collection), source), row("Space (스페이스)", space),
        (col(url), F.concat(F.lit("| **URL** | [Link ↗]("), col(url), F.lit(") |"))),
        row("Date (수집일)", date))
    head = "\n\n---\n\n### 📋 LLM Wiki Metadata\n\n| Key (속성) | Value (값) |\n| :--- | :--- |\n"
    return F.concat(F.lit(head), F.array_join(rows, "\n"), F.lit("\n"))


# Entities that names and anchors may carry, in replacement order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]


def decode_entities(c) -> Column:
    out = col(c)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


NO_INFO = "정보 없음"


def safe_file_name(title, company) -> Column:
    """``company - title`` without characters illegal in file names, at most 80 characters."""
    part = lambda c: decode_entities(trim_ws(first_filled(c, F.lit(NO_INFO))))
    name = F.concat(part(company), F.lit(" - "), part(title))
    name = trim_ws(F.regexp_replace(F.regexp_replace(name, r'[/\\:*?"<>|]', " "), WS + "+", " "))
    return let(name, lambda n: F.when(n.isin("", "-"), F.lit(f"{NO_INFO} - {NO_INFO}"))
               .otherwise(trim_ws(F.substring(n, 1, 80))))


def book_file_name(c) -> Column:
    """Illegal characters out, spaces collapsed, 120 characters."""
    return F.substring(trim_ws(F.regexp_replace(drop_matches(c, r'[\\/:*?"<>|]'), WS + "+", " ")), 1, 120)


def export_file_name(c) -> Column:
    """Illegal characters become underscores."""
    return trim_ws(F.regexp_replace(col(c), r'[\\/:*?"<>|]', "_"))


def mail_file_name(c) -> Column:
    return F.when(F.coalesce(col(c), F.lit("")) == "", F.lit("Untitled_Mail")).otherwise(
        F.substring(trim_ws(drop_matches(c, r'[\\/*?:"<>|]')), 1, 100))


def book_output_name(c) -> Column:
    """Book folder name: file name without its ``.pdf``/``.epub`` ending."""
    return trim_ws(F.regexp_replace(col(c), r"(?i)\.(pdf|epub)\z", ""))


def mail_noise(md) -> Column:
    """Newsletter clean-up: style rules, empty links and images, unsubscribe links, broken link text."""
    t = drop_matches(md, r"(?i)@media[^{]*\{[^}]*\}", r"\.[a-zA-Z0-9_-]+\s*\{[^}]*\}", r"!\[\]\(.*?\)", r"\[\]\(.*?\)")
    t = F.replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), F.lit("&nbsp;"), F.lit(" "))
    t = drop_matches(t, r"(?i)\[?unsubscribe\]?\(.*?\)", r"\[?수신거부\]?\(.*?\)")

    def link(title, url):
        shown = trim_ws(F.regexp_replace(title, WS + "+", " "))
        return F.when(shown == "", F.lit("")).otherwise(
            F.concat(F.lit("["), shown, F.lit("]("), trim_ws(url), F.lit(")")))
    return trim_ws(_rewrite_links(t, _LINK, link))


def plain_text(md) -> Column:
    """Text for embedding: link text kept, Markdown symbols out, whitespace collapsed."""
    t = F.regexp_replace(col(md), r"\[([^\]]+)\]\([^)]+\)", "$1")
    return trim_ws(F.regexp_replace(F.regexp_replace(t, r"[*_`#\-]", ""), WS + "+", " "))


def clean_description(c) -> Column:
    """Job text: expander labels out, blank runs compressed."""
    t = F.regexp_replace(col(c), r"(?i)Show\s+more\s*\n*\s*Show\s+less", "")
    return trim_ws(F.regexp_replace(t, r"(\r?\n\s*){3,}", "\n\n"))


_STRUCTURE = r"^([#\-*`\[]|\d+\.)"


def reflow_markdown(md) -> Column:
    """Join a line to the one before it unless that ends a sentence, either is blank, or the line
    starts a Markdown structure; then compress spaces and blank lines."""
    text = F.regexp_replace(F.regexp_replace(col(md), r"\r\n|[\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n"), r"\n\z", "")

    def build(x):
        # x.raw are the lines, x.cut the trimmed lines: each line is trimmed once.
        def piece(shown, i):
            fresh = (shown == "") | x["ends"][i - 1] | shown.rlike(_STRUCTURE)
            body = F.when(shown == "", F.lit("")).otherwise(x["raw"][i])
            return F.when(i == 0, body).when(fresh, F.concat(F.lit("\n"), body)).otherwise(F.concat(F.lit(" "), shown))
        return F.array_join(F.transform(x["cut"], piece), "")

    def prepare(raw):
        return let(F.transform(raw, trim_ws), lambda cut: let(F.struct(
            raw.alias("raw"), cut.alias("cut"), F.transform(cut, lambda c: (c == "") | c.rlike(r"[.?!:;]\z")).alias("ends")), build))
    joined = let(F.split(text, "\n"), prepare)
    return F.regexp_replace(F.regexp_replace(joined, " {2,}", " "), r"\n{3,}", "\n\n")


def truncate_lines(c, max_lines: int = 150, head: int = 50, tail: int = 100) -> Column:
    """Long output: first lines, a marker with the number left out, last lines."""
    def cut(lines):
        n = F.size(lines)
        mark = F.format_string(
            "\n... [Truncated %d lines of output. Full log copied to tasks/ directory] ...\n", n - head - tail)
        parts = F.concat(F.slice(lines, 1, head), F.array(mark),
                         F.slice(lines, F.greatest(n - tail + 1, F.lit(1)), F.lit(tail)))
        return F.when(n > max_lines, F.array_join(parts, "\n")).otherwise(F.array_join(lines, "\n"))
    return let(lines_of(c), cut)


def compact_lines(c) -> Column:
    """Trimmed lines without blanks and comment markers."""
    lines = F.transform(lines_of(c), trim_ws)
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("<!--"))
                                 & ~F.endswith(x, F.lit("-->"))), "\n")


def relativize(c, root: str) -> Column:
    """Absolute paths (or URLs) below ``root`` become relative."""
    return F.replace(F.replace(col(c), F.lit(root + "/"), F.lit("./")), F.lit(root), F.lit("./"))


# Fixed value: Markdown links with an absolute target.
ABSOLUTE_LINK = r"(?i)\[.*?\]\((file://|http://|https://|www\.)"


def absolute_links(line) -> Column:
    return F.regexp_extract_all(col(line), F.lit(ABSOLUTE_LINK), F.lit(0))


def resource_ids(md) -> Column:
    """Distinct 32-hex ids of ``(:/id)`` resource links."""
    return F.array_distinct(F.regexp_extract_all(col(md), F.lit(r"\(:/([0-9a-f]{32})\)"), F.lit(1)))


def replace_pairs(text, pairs) -> Column:
    """Apply ``array<struct<from,to>>`` literal replacements in order."""
    return F.aggregate(col(pairs), col(text), lambda acc, p: F.replace(acc, p["from"], p["to"]))


def natural_key(c) -> Column:
    """Sort key that orders digit runs of any length by value: each is led by its number of digits."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.concat(F.lpad(F.length(F.ltrim(r, F.lit("0"))).cast("string"), 10, "0"), F.ltrim(r, F.lit("0")))).otherwise(F.lower(r))), "")


def thousands(n) -> Column:
    return F.regexp_replace(col(n).cast("string"), r"\B(?=(\d{3})+(?!\d))", ",")


def duration_text(seconds) -> Column:
    s = col(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(
        m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def bytes_text(n) -> Column:
    """Human size with up to two decimals, trailing zeros out."""
    b = col(n).cast("double")
    level = F.when(b >= 1024.0 ** 3, 3).when(b >= 1024.0 ** 2, 2).when(b >= 1024, 1).otherwise(0)
    unit = F.element_at(F.array(*map(F.lit, ["B", "KB", "MB", "GB"])), level + 1)
    value = F.format_string("%.2f", b / F.pow(F.lit(1024.0), level))
    return F.when(b == 0, F.lit("0 B")).otherwise(
        F.concat(F.regexp_replace(value, r"\.?0+\z", ""), F.lit(" "), unit))


def strip_ansi(c) -> Column:
    return F.regexp_replace(col(c), r"\x1b\[[0-9;]*m", "")


def strip_tags(html) -> Column:
    """Visible text of markup: script, style and comments out, tags to spaces, whitespace collapsed."""
    t = F.regexp_replace(col(html), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    return trim_ws(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", " "), WS + "+", " "))


def body_preview(html, n: int = 500) -> Column:
    """First ``n`` characters of the body text as an element tree gives it: tags leave no space."""
    body = F.coalesce(match_group(html, r"(?is)<body\b[^>]*>(.*)"), col(html))
    t = F.regexp_replace(body, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|</body\s*>.*\z", "")
    t = decode_entities(F.regexp_replace(t, "<[^>]*>", ""))
    return F.substring(trim_ws(F.regexp_replace(t, WS + "+", " ")), 1, n)


def first_heading_or_line(c) -> Column:
    return F.substring_index(col(c), "\n", 1)


# Headings a job description starts at (the first list only after an "About" section).
JD_STARTS_AFTER_ABOUT = [r"Job\s+Description", r"Role\s+Description"]
JD_STARTS = ["Responsibilities", r"What\s+you'll\s+do", r"What\s+you\s+will\s+do",
             r"What\s+we\s+are\s+looking\s+for", "Qualifications", "Requirements",
             r"담당\s*업무", r"주요\s*업무", r"자격\s*요건", r"우대\s*사항"]
_LINE_START, _WORD_END = r"(?i)(?:^|\n)", r"(?:\s|:|\z)"


def jd_split(md, company) -> Column:
    """Job description of a posting: after an "About <company>" section, from its first description
    heading; else from a requirements heading when at least 20 characters come before it."""
    after_about = _LINE_START + "(" + "|".join(JD_STARTS_AFTER_ABOUT + JD_STARTS) + ")" + _WORD_END
    plain = _LINE_START + "(" + "|".join(JD_STARTS) + ")" + _WORD_END
    name = F.concat(F.lit(r"\Q"), F.replace(F.coalesce(col(company), F.lit("")), F.lit(r"\E"), F.lit("")), F.lit(r"\E"))
    about = F.concat(F.lit(_LINE_START + r"(?:#+\s+)?(About\s+Us|About\s+"), name,
                     F.lit(r"|회사\s*소개|"), name, F.lit(r"\s*소개)" + _WORD_END))
    has_company = F.coalesce(col(company), F.lit("")) != ""

    # An empty match and none are the same; each pattern is bound, so that it runs once over a text.
    found = lambda c, body: let(F.coalesce(c, F.lit("")), body)

    def at_heading(t):
        before = F.length(trim_ws(F.regexp_replace(t, plain + r"[\s\S]*\z", "")))
        return found(F.regexp_extract(t, f"({plain}[\\s\\S]*)", 1), lambda w: F.when(w == "", t).when(before >= 20, trim_ws(w)).otherwise(t))

    def cut(t):
        intro = F.when(has_company, F.call_function("regexp_extract", t, F.concat(F.lit("("), about, F.lit(r"[\s\S]*)")), F.lit(1)))
        return found(intro, lambda i: found(F.when(i != "", F.regexp_extract(i, f"({after_about}[\\s\\S]*)", 1)), lambda a:
                     F.when(a != "", trim_ws(a)).otherwise(at_heading(t))))
    text = F.regexp_replace(F.replace(col(md), F.lit("\r"), F.lit("")), r"\n{3,}", "\n\n")
    return let(trim_ws(text), cut)


def markdown_images(md) -> Column:
    return F.regexp_extract_all(col(md), F.lit(r"(?i)!\[.*?\]\((https?://[^)]+)\)"), F.lit(1))


def html_images(html) -> Column:
    return F.regexp_extract_all(col(html), F.lit(r"""(?i)<img[^>]+src=["']([^"']+)["'][^>]*>"""), F.lit(1))


def summary_line(c, n: int = 60) -> Column:
    return F.substring(F.substring_index(trim_ws(c), "\n", 1), 1, n)


# Fixed value: headings that open a "what was learned" section.
LEARNINGS = r"(?i)((?:##?\s*(?:Troubleshooting|Learnings|💡\s*Troubleshooting|배운\s*점|학습\s*내용)[\s\S]*))"


def learnings_section(c) -> Column:
    return F.coalesce(trim_ws(match_group(c, LEARNINGS)), F.lit("N/A"))
