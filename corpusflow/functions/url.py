"""URL normalisation, filters and stable ids as native Columns.

The supported URL subset is http(s): scheme and host are lower-cased, a default port is dropped,
dot segments are resolved, non-ASCII and unsafe characters of path and query are percent-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import HANGUL, col, first_filled, let, match_group, trim_ws

# Query parameters that only track the visitor, and those that carry a shared link.
TRACKING_PARAMS = ["ref", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
                   "fbclid", "gclid"]
SHARE_PARAMS = ["url", "u"]
# Path endings of files that are not pages.
BINARY_PATTERN = (r"(?i)\.(zip|pdf|png|jpe?g|gif|svg|mp[34]|mov|avi|exe|dmg|gz|tar|7z|rar|docx?|xlsx?"
                  r"|pptx?|webp|ico|css|js\.map?)\z")

_HTTP = r"(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?\z"
_NOISE_TAIL = rf"(?:%[0-9A-Fa-f]{{2}}|{HANGUL})++\z"
_PATH_UNSAFE = r'[^\x21-\x7e]|["<>`{}^]'
_QUERY_UNSAFE = r"""[^\x21-\x7e]|["<>']"""


def _encode_unsafe(c: Column, unsafe: str) -> Column:
    per_char = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.when(ch.rlike(unsafe), F.regexp_replace(
            F.url_encode(ch), r"\+", "%20")).otherwise(ch)), "")
    return F.when(c.rlike(unsafe), per_char).otherwise(c)


def _resolve_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; paths without any are passed through."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, 2, F.greatest(F.size(segments), F.lit(1))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    # A trailing dot segment leaves a directory, hence the closing slash.
    tail = F.when(path.rlike(r"/\.{1,2}\z"), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    return F.when(path.rlike(r"/\.{1,2}(/|\z)"), F.regexp_replace(resolved, r"^//\z", "/")).otherwise(path)


_MARK = "\ue000"
_SPLIT_URL = _MARK.join(f"${i}" for i in range(1, 7))


def url_parts(url) -> Column:
    """Struct ``ok, host, port, origin, path, query, fragment`` of a URL; one regex match splits it."""
    def parts(a):
        scheme, host, port = F.lower(F.get(a, F.lit(0))), F.lower(F.get(a, F.lit(1))), F.get(a, F.lit(2))
        default_port = F.when(scheme == "http", "80").otherwise("443")
        shown_port = F.when((port == "") | (port == default_port), F.lit("")).otherwise(F.concat(F.lit(":"), port))
        path = let(F.get(a, F.lit(3)), lambda p: F.when(p == "", F.lit("/")).otherwise(
            _resolve_dots(_encode_unsafe(p, _PATH_UNSAFE))))
        return F.struct(
            (F.size(a) == 6).alias("ok"), host.alias("host"), shown_port.alias("port"),
            F.concat(scheme, F.lit("://"), host, shown_port).alias("origin"), path.alias("path"),
            F.get(a, F.lit(4)).alias("query"), F.get(a, F.lit(5)).alias("fragment"))
    return let(F.split(F.regexp_replace(col(url), _HTTP, _SPLIT_URL), _MARK), parts)


def host_of(url) -> Column:
    """Lower-cased host, NULL when the URL is not http(s)."""
    return F.nullif(F.lower(F.regexp_extract(col(url), _HTTP, 2)), F.lit(""))


def _suffix(mark: str, text: Column) -> Column:
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(mark), text))


def parts_text(p: Column) -> Column:
    """Canonical text of a parts struct, NULL when it is not http(s)."""
    return F.when(p["ok"], F.concat(p["origin"], p["path"], _suffix("?", _encode_unsafe(p["query"], _QUERY_UNSAFE)),
                                    _suffix("#", p["fragment"])))


def normalize_url(url) -> Column:
    """Canonical text of an http(s) URL, NULL for anything else."""
    return let(url_parts(url), parts_text)


def percent_decode(c) -> Column:
    """Percent-decode without touching ``+``; a bad escape leaves the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B"))), col(c))


def _form_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def query_pairs(query: Column) -> Column:
    """``array<struct<k,v>>`` of a query string, decoded, in order."""
    return F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _form_decode(F.substring_index(p, "=", 1)).alias("k"),
            _form_decode(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", ""))
                         .otherwise(F.lit(""))).alias("v")))


def query_param(url, name: str) -> Column:
    """First value of a query parameter, NULL when absent."""
    hits = F.filter(query_pairs(F.regexp_extract(col(url), _HTTP, 5)), lambda p: p["k"] == name)
    return F.get(hits, F.lit(0))["v"]


def strip_noise_tail(c) -> Column:
    """Drop every trailing percent escape and Hangul syllable (link text glued to a URL)."""
    return F.regexp_replace(col(c), _NOISE_TAIL, "")


def _clean_query(query: Column) -> Column:
    kept = F.filter(query_pairs(query), lambda x: ~x["k"].isin(TRACKING_PARAMS))
    last_value = lambda ps, n: F.element_at(F.filter(ps, lambda x: x["k"] == n), -1)["v"]
    return let(kept, lambda ps: F.array_join(
        F.transform(F.array_distinct(F.transform(ps, lambda x: x["k"])),
                    lambda n: F.concat(F.url_encode(n), F.lit("="), F.url_encode(last_value(ps, n)))), "&"))


def strip_parts(p: Column, strip_noise: bool = True) -> Column:
    """Text of a parts struct without tracking parameters, fragment, template cut and noise tail."""
    query = F.when(p["query"] == "", F.lit("")).otherwise(let(_clean_query(p["query"]), lambda q: _suffix("?", q)))
    out = F.when(p["ok"], F.regexp_replace(F.concat(p["origin"], p["path"], query), r"(?s)\$%.*\z", ""))
    return strip_noise_tail(out) if strip_noise else out


def strip_tracking(url, strip_noise: bool = True) -> Column:
    """Drop tracking parameters and the fragment; a repeated parameter keeps its last value at its
    first position; cut at a template marker; drop the noise tail. Other URLs only lose the tail."""
    other = strip_noise_tail(url) if strip_noise else col(url)
    return F.coalesce(let(url_parts(url), lambda p: strip_parts(p, strip_noise)), other)


def is_binary_url(url) -> Column:
    return let(url_parts(url), lambda p: p["ok"] & p["path"].rlike(BINARY_PATTERN))


def same_domain(host, domain) -> Column:
    """Equal host, sub-domain of the configured domain, or its parent domain."""
    h, d = col(host), col(domain)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d)) | (
        F.contains(h, F.lit(".")) & F.endswith(d, F.concat(F.lit("."), h)))


def shared_target(href, domain) -> Column:
    """URL carried by a share link when it points back to the domain, else NULL."""
    def own(name):
        return let(query_param(href, name), lambda v: F.when(same_domain(host_of(v), domain), v))
    return F.coalesce(*[own(name) for name in SHARE_PARAMS])


# --- href resolution -------------------------------------------------------------------------

# Marks of an href that is markup or a template rather than an address.
_REJECT_CHARS = r"""[\s"'<>￼{}]"""
_REJECT_TEXT = ["$%", "$$", "download.cm", "%7B", "%7D"]
_REJECT_LOOSE = ["div", "br"]


def clean_href(href) -> Column:
    """Remove quote and backslash debris around an href."""
    h = trim_ws(href)
    h = trim_ws(F.regexp_replace(h, r"""^\\?["']|\\?["']\z""", ""))
    return F.replace(F.replace(h, F.lit("%22"), F.lit("")), F.lit('\\"'), F.lit(""))


def is_malformed_href(href, compat: bool = True) -> Column:
    """``compat`` also rejects every href with ``div`` or ``br`` anywhere in it; without it only
    tag-like text is rejected, so ``/library`` survives."""
    h = col(href)
    bad = h.rlike(_REJECT_CHARS)
    for text in _REJECT_TEXT + (_REJECT_LOOSE if compat else []):
        bad = bad | F.contains(h, F.lit(text))
    return bad if compat else bad | h.rlike(r"(?i)%3c/?(div|br)")


def absolute_href(href, domain) -> Column:
    """Absolute text of a cleaned href against ``https://<domain>``; not yet normalised."""
    h = col(href)
    head = F.substring_index(h, "/", 1)
    bare = (~h.rlike(r"(?i)^(https?:)?//")) & (~h.rlike(r"^[./]"))
    schemeless = bare & F.contains(head, F.lit(".")) & ~F.contains(head, F.lit("="))
    base = F.concat(F.lit("https://"), col(domain))
    return (
        F.when(schemeless, F.concat(F.lit("https://"), h))
        .when(h.rlike(r"(?i)^https?://"), h)
        .when(F.startswith(h, F.lit("//")), F.concat(F.lit("https:"), h))
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h)
        .when(h.rlike(r"^[/?#]"), F.concat(base, h))
        .otherwise(F.concat(base, F.lit("/"), h)))


def resolve_href(href, domain, compat: bool = True) -> Column:
    """Absolute normalised http(s) URL of an href, NULL when it is malformed or another scheme."""
    return let(clean_href(href), lambda h: F.when(
        ~is_malformed_href(h, compat), normalize_url(absolute_href(h, domain))))


# --- ids -------------------------------------------------------------------------------------

def job_id(url) -> Column:
    """Dash-number tail, all digits, first block of 7+ digits, else the first 50 characters of the
    last path segment."""
    clean = F.regexp_replace(F.substring_index(trim_ws(url), "?", 1), r"/\z", "")
    return let(F.substring_index(clean, "/", -1), lambda seg: F.coalesce(
        match_group(seg, r"-([0-9]+)\z"), match_group(seg, r"^([0-9]+)\z"),
        match_group(seg, r"([0-9]{7,})"), F.substring(seg, 1, 50)))


def company_id(url) -> Column:
    """Percent-decoded segment after ``company`` (or its known misspelling), else the last one."""
    def pick(segs):
        spots = F.filter(F.array(F.array_position(segs, "company"), F.array_position(segs, "compay")),
                         lambda i: i > 0)
        after = F.get(segs, F.array_min(spots).cast("int"))
        return percent_decode(first_filled(after, F.element_at(segs, -1)))
    clean = F.substring_index(F.regexp_replace(trim_ws(url), r"/\z", ""), "?", 1)
    return let(F.split(clean, "/"), pick)


def id_by_pattern(url, pattern: str) -> Column:
    return F.regexp_extract(col(url), pattern, 1)


def topic_id(url) -> Column:
    """``weekly-N`` for weekly issues, else the numeric ``id`` parameter, else empty."""
    weekly = match_group(url, r"/weekly/(\d+)\z")
    return F.coalesce(F.concat(F.lit("weekly-"), weekly), id_by_pattern(url, r"[?&]id=(\d+)"))


def dash_tail_id(url) -> Column:
    """15 alphanumerics after the last dash, else empty."""
    tail = F.substring_index(col(url), "-", -1)
    return F.when(tail.rlike(r"^[a-zA-Z0-9]{15}\z"), tail).otherwise(F.lit(""))


def last_segment(url) -> Column:
    return F.substring_index(F.regexp_replace(col(url), r"/\z", ""), "/", -1)


def canonical_url(url, drop_page_number: bool = False) -> Column:
    """https form without ``www.`` and without the closing slash (optionally without ``/N``)."""
    def rebuild(p):
        path = F.regexp_replace(p["path"], r"/\z", "")
        if drop_page_number:
            path = F.regexp_replace(path, r"/\d+\z", "")
        path = let(path, lambda x: F.when(x == "", F.lit("/")).otherwise(x))
        return F.concat(F.lit("https://"), F.regexp_replace(p["host"], r"^www\.", ""), p["port"], path,
                        _suffix("?", _encode_unsafe(p["query"], _QUERY_UNSAFE)), _suffix("#", p["fragment"]))
    return let(trim_ws(percent_decode(url)), lambda u: F.coalesce(
        let(url_parts(u), lambda p: F.when(p["ok"], rebuild(p))), u))


def canonical_md5(url, drop_page_number: bool = False) -> Column:
    return F.md5(canonical_url(url, drop_page_number))


def canonical_base64(url) -> Column:
    return F.regexp_replace(F.base64(F.encode(canonical_url(url), "UTF-8")), r"[^a-zA-Z0-9]", "")


def short_md5(url) -> Column:
    """Fallback id: the first ten hex digits of the md5."""
    return F.substring(F.md5(col(url)), 1, 10)


# --- listing keys ------------------------------------------------------------------------------

def listing_key(url) -> Column:
    """URL without its ``start`` parameter: one key per paged search."""
    u = F.regexp_replace(col(url), r"([?&])start=[^&#]*&?", "$1")
    return F.regexp_replace(u, r"[?&](?=#|\z)", "")


def listing_path(url) -> Column:
    """Base path of a paged listing; every weekly page folds into ``/weekly``."""
    return let(url_parts(url), lambda p: F.when(~p["ok"], col(url)).when(
        F.startswith(p["path"], F.lit("/weekly")), F.lit("/weekly")).otherwise(p["path"]))


def listing_page_url(url, param: str, page) -> Column:
    """Address of one page of a listing."""
    sep = F.when(F.contains(col(url), F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(col(url), sep, F.lit(param + "="), col(page).cast("string"))
