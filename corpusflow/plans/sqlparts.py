"""SQL text for the expressions that several counterparts share."""

from __future__ import annotations

HTTP = r"(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#((?s:.*)))?$"
HANGUL = r"\x{AC00}-\x{D7A3}"
BINARY = (r"(?i)\.(zip|pdf|png|jpe?g|gif|svg|mp[34]|mov|avi|exe|dmg|gz|tar|7z|rar|docx?|xlsx?|pptx?|webp|ico|css"
          r"|js\.map?)$")
TRACKING = "('ref','utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid')"


def part(u: str, i: int) -> str:
    return f"regexp_extract({u}, '{HTTP}', {i})"


def host(u: str) -> str:
    return f"nullif(lower({part(u, 2)}), '')"


def chars(x: str, unsafe: str) -> str:
    """Percent-encode the characters matching ``unsafe``."""
    return (f"array_to_string(list_transform(string_split({x}, ''), lambda ch: CASE WHEN regexp_matches(ch, "
            f"'{unsafe}') THEN url_encode(ch) ELSE ch END), '')")


def path(u: str) -> str:
    p = part(u, 4)
    return f"CASE WHEN {p} = '' THEN '/' ELSE {chars(p, PATH_UNSAFE)} END"


PATH_UNSAFE = r'[^\x21-\x7e]|["<>`{}^]'


def port(u: str) -> str:
    p = part(u, 3)
    return (f"CASE WHEN {p} = '' OR {p} = (CASE WHEN lower({part(u, 1)}) = 'http' THEN '80' ELSE '443' END) "
            f"THEN '' ELSE ':' || {p} END")


def origin(u: str) -> str:
    return f"(lower({part(u, 1)}) || '://' || lower({part(u, 2)}) || ({port(u)}))"


def normalize(u: str) -> str:
    q, f = part(u, 5), part(u, 6)
    return (f"CASE WHEN regexp_matches({u}, '{HTTP}') THEN {origin(u)} || ({path(u)}) || "
            f"CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END || CASE WHEN {f} = '' THEN '' ELSE '#' || {f} END END")


def clean_query(q: str) -> str:
    """Query without tracking parameters; last value per name at its first position."""
    kept = (f"list_filter(list_filter(string_split({q}, '&'), lambda p: p <> ''), "
            f"lambda p: split_part(p, '=', 1) NOT IN {TRACKING})")
    return (f"(SELECT coalesce(string_agg(k || '=' || v, '&' ORDER BY i0), '') FROM (SELECT split_part(p, '=', 1) k, "
            f"arg_max(CASE WHEN contains(p, '=') THEN regexp_replace(p, '^[^=]*=', '') ELSE '' END, i) v, min(i) i0 "
            f"FROM (SELECT unnest({kept}) p, generate_subscripts({kept}, 1) i) GROUP BY 1))")


def strip_tail(x: str) -> str:
    return rf"regexp_replace({x}, '(?:%[0-9A-Fa-f]{{2}}|[{HANGUL}])+$', '')"


def strip_tracking(u: str) -> str:
    q = clean_query(part(u, 5))
    full = (f"{origin(u)} || ({path(u)}) || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END")
    return strip_tail(f"CASE WHEN regexp_matches({u}, '{HTTP}') THEN regexp_replace({full}, '(?s)\\$%.*$', '') ELSE {u} END")


def same_domain(h: str, d: str) -> str:
    return f"({h} = {d} OR {h} LIKE '%.' || {d} OR (contains({h}, '.') AND {d} LIKE '%.' || {h}))"


def job_id(u: str) -> str:
    seg = f"split_part(regexp_replace(split_part(trim({u}), '?', 1), '/$', ''), '/', -1)"
    return (f"coalesce(nullif(regexp_extract({seg}, '-([0-9]+)$', 1), ''), nullif(regexp_extract({seg}, '^([0-9]+)$', 1), ''), "
            f"nullif(regexp_extract({seg}, '([0-9]{{7,}})', 1), ''), substr({seg}, 1, 50))")


def canonical(u: str, drop_page: bool = False) -> str:
    p = f"regexp_replace({path(u)}, '/$', '')"
    if drop_page:
        p = f"regexp_replace({p}, '/\\d+$', '')"
    q, f = part(u, 5), part(u, 6)
    return (f"('https://' || regexp_replace(lower({part(u, 2)}), '^www\\.', '') || ({port(u)}) || "
            f"CASE WHEN {p} = '' THEN '/' ELSE {p} END || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END || "
            f"CASE WHEN {f} = '' THEN '' ELSE '#' || {f} END)")


def decode_entities(x: str) -> str:
    for a, b in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " ")]:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def parsed_text(x: str) -> str:
    """Entities as a parser reads them: one level, the ampersand also without its semicolon."""
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·")]:
        x = f"replace({x}, '{a}', '{b}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


HREF = r"""(?is)<a(?:\s(?:[^"''>]|"[^"]*"|''[^'']*'')*?)??\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)"""
INVISIBLE = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
# One row per anchor of pages: page_id, page_url, pos, href.
ANCHORS = f"""
found AS (SELECT page_id, url AS page_url,
                 regexp_extract_all(regexp_replace(html, '{INVISIBLE}', ' ', 'g'), '{HREF}', 1) AS hs FROM pages),
raw_anchors AS (SELECT page_id, page_url, generate_subscripts(hs, 1) - 1 AS pos, unnest(hs) AS raw FROM found),
anchors AS (SELECT page_id, page_url, pos,
                   {decode_entities("regexp_replace(raw, '^[" + '"' + "'']|[" + '"' + "'']$', '', 'g')")} AS href
            FROM raw_anchors)"""
REJECT = r"""[\s"''<>\x{FFFC}{}]"""
# Outcome of each anchor against the host of its page, job-style ids, the default exclude list.
LINKS = f"""{ANCHORS},
l1 AS (SELECT *, {host('page_url')} AS dom,
              replace(replace(trim(href), '%22', ''), chr(92) || '"', '') AS h FROM anchors),
l2 AS (SELECT *, CASE WHEN href = '' THEN 'empty'
                      WHEN regexp_matches(h, '{REJECT}') OR contains(h, 'div') OR contains(h, 'br') OR contains(h, '$%')
                        OR contains(h, '$$') OR contains(h, 'download.cm') OR contains(h, '%7B') OR contains(h, '%7D')
                      THEN 'malformed'
                      WHEN contains(h, 'favicon') OR contains(h, 'login') OR contains(h, 'logout') OR contains(h, 'signup')
                      THEN 'excluded' END AS bad,
              CASE WHEN NOT regexp_matches(h, '(?i)^(https?:)?//') AND NOT regexp_matches(h, '^[./]')
                        AND contains(split_part(h, '/', 1), '.') AND NOT contains(split_part(h, '/', 1), '=')
                   THEN 'https://' || h
                   WHEN regexp_matches(h, '(?i)^https?://') THEN h
                   WHEN h LIKE '//%' THEN 'https:' || h
                   WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h
                   WHEN regexp_matches(h, '^[/?#]') THEN 'https://' || dom || h
                   ELSE 'https://' || dom || '/' || h END AS abs_url FROM l1),
l3 AS (SELECT *, CASE WHEN bad IS NULL THEN {normalize('abs_url')} END AS full_url FROM l2),
l4 AS (SELECT *, {same_domain(host('full_url'), 'dom')} AS own FROM l3),
l5 AS (SELECT *, CASE WHEN own THEN split_part({strip_tracking('full_url')}, '#', 1) END AS url FROM l4),
links AS (SELECT page_id, page_url, pos, href, url, {job_id('url')} AS dst_id,
                 CASE WHEN bad IS NOT NULL THEN bad WHEN full_url IS NULL THEN 'protocol' WHEN url IS NULL THEN 'domain'
                      WHEN regexp_matches({path('url')}, '{BINARY}') THEN 'binary'
                      WHEN coalesce({job_id('url')}, '') = '' THEN 'id_null' ELSE 'ok' END AS outcome FROM l5)"""
