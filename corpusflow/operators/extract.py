"""Batch functions over markup: each page is parsed once and leaves as plain columns.

The functions are Arrow-batched. Only the markup column travels to Python; keys and other columns of
the row stay in the JVM. Pages are large, so sessions that convert should lower
``spark.sql.execution.arrow.maxRecordsPerBatch`` (a few hundred rows per batch).
"""

from __future__ import annotations

import json
import sys
from typing import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import html as H

# The batch functions travel with the plan, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(H)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 200_000
PAGES = 64        # pages whose results are held at a time

LINK = "struct<pos:int,href:string,text:string,blank:boolean>"
FIELDS = (f"struct<title:string,h1:string,meta:map<string,string>,canonical:string,time:string,json_ld:array<string>,"
          f"links:array<{LINK}>,texts:map<string,string>,short_texts:array<string>,content_rank:int,content_html:string,"
          f"content_md:string,body_text:string>")


def _udf(returns: str, per_page):
    """Batch function applying ``per_page(html) -> value`` to a column of markup. The results of an Arrow batch leave in
    pieces of few pages: what Python holds does not grow with the batch."""
    out = pd.DataFrame if returns.startswith("struct") else pd.Series

    def run(batches):
        # Trees may be nested deeper than the interpreter's default limit; its own frames live on the heap.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), DEPTH))
        for html in batches:
            for at in range(0, len(html), PAGES):
                values = [per_page(h) for h in html.iloc[at:at + PAGES]]
                yield pd.DataFrame(values) if out is pd.DataFrame else pd.Series(values, dtype=object)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[out]}
    return F.pandas_udf(run, returns)


def page_fields(content: list[str] = (), texts: dict[str, str] | None = None, attrs: dict[str, tuple[str, str]] | None = None,
                drop: list[str] = (), style: dict = H.ARTICLE, short_text: int = 0, links: bool = True, body_text: bool = False,
                majority: str | None = None, min_content: int = 0, captions: tuple[str, str, str] | None = None):
    """Column function ``html -> FIELDS``.

    ``texts`` and ``attrs`` name the first match of a selector; ``content`` are body selectors in
    order, the first with more than ``min_content`` characters of markup wins, else the body;
    ``majority`` first looks for the container most elements of that selector live in; ``captions``
    ``(wrapper, link, note)`` turns image wrappers into one image text with its note.
    """
    texts, attrs = texts or {}, attrs or {}

    def extract(html):
        root = H.parse(html)
        meta, named = {}, {}
        for m in H.select(root, "meta"):
            name = m.attrs.get("property") or m.attrs.get("name")
            if name:
                meta.setdefault(name, m.attrs.get("content", ""))
        for name, sel in texts.items():
            n = H.first(root, sel)
            if n is not None:
                named[name] = n.text().strip()
        for name, (sel, attr) in attrs.items():
            n = H.first(root, sel)
            if n is not None and attr in n.attrs:
                named[name] = n.attrs[attr]
        node = lambda sel: H.first(root, sel)
        text = lambda n: None if n is None else n.text().strip()
        canonical, time = node('link[rel="canonical"]'), node("time[datetime]")
        out = dict(
            title=text(node("title")), h1=text(node("h1")), meta=meta,
            canonical=canonical.attrs.get("href") if canonical else None,
            time=time.attrs.get("datetime") if time else None,
            json_ld=["".join(k for k in s.kids if isinstance(k, str)) for s in H.select(root, 'script[type="application/ld+json"]')],
            links=[dict(pos=i, href=a.attrs["href"], text=H.squeeze(a.text()), blank=a.attrs.get("target") == "_blank")
                   for i, a in enumerate(H.select(root, "a[href]"))] if links else [],
            texts=named,
            short_texts=[t for t in (H.squeeze(n.text()) for n in H.select(root, "span, a, p, div, strong, button")) if 0 < len(t) < short_text],
            body_text=(node("body") or root).text() if body_text else None)
        rank, pick = _content(root, content, majority, min_content)
        if pick is not None:
            for w in list(H.select(pick, captions[0])) if captions else []:
                _caption(w, captions[1], captions[2])
            for sel in drop:
                for n in list(H.select(pick, sel)):
                    n.remove()
        out.update(content_rank=rank, content_html=H.inner_html(pick) if pick else None,
                   content_md=H.to_markdown(pick, style) if pick else None)
        return out
    return _udf(FIELDS, extract)


def _caption(wrapper, link, note):
    image, a, info = H.first(wrapper, "img"), H.first(wrapper, link), H.first(wrapper, note)
    src, alt = (image.attrs.get("src", ""), image.attrs.get("alt", "")) if image else ("", "")
    text = info.text() if info else ""
    wrapper.tag, wrapper.kids = "span", [f"![{alt}]({(a.attrs.get('href') if a else None) or src})" + (f"\n*{text}*" if text else "")]


# Elements that only lay out or style text; a div with an id or class may be a container of its own.
_LAYOUT = {"blockquote", "ul", "ol", "li", "a", "span", "div"}


def container_of(n: H.Node) -> H.Node | None:
    up = n.up
    while up is not None and up.tag in _LAYOUT and not (up.tag == "div" and (up.attrs.get("id") or up.attrs.get("class"))):
        if up.up is None or up.up.tag in ("body", "html", "#root"):
            break
        up = up.up
    return up


def _content(root, selectors, majority, min_content):
    if majority:
        counts: dict = {}
        for p in H.select(root, majority):
            c = container_of(p)
            if c is not None:
                counts[c] = counts.get(c, 0) + 1
        if counts:
            return 0, max(counts, key=counts.get)      # first container of the highest count
    for i, sel in enumerate(selectors):
        n = H.first(root, sel)
        if n is not None and len(H.inner_html(n).strip()) > min_content:
            return i, n
    body = H.first(root, "body")
    return (len(selectors), body) if body is not None else (len(selectors), root)


def markdown(style: dict = H.ARTICLE):
    """Column function: markup to Markdown."""
    return _udf("string", lambda h: None if h is None else H.to_markdown(H.parse(h), style))


# Elements a minified page loses, attributes it keeps.
MINIFY_DROP = "style, svg, img, iframe, noscript, link[rel=\"stylesheet\"], link[type=\"text/css\"], header, footer, nav"
MINIFY_KEEP = ["id", "class", "href", "name", "content", "property", "rel"]


def minify(keep_jsonld: bool = False, extra_attrs: list[str] = ()):
    """Column function: markup without scripts, styles, media, page furniture, comments and
    attributes outside the allow-list."""
    allowed = set(MINIFY_KEEP) | set(extra_attrs) | ({"type"} if keep_jsonld else set())

    def run(html):
        if html is None:
            return None
        root = H.parse(html)
        for n in list(H.select(root, MINIFY_DROP)) + list(H.select(root, "script")):
            if not (n.tag == "script" and keep_jsonld and n.attrs.get("type") == "application/ld+json"):
                n.remove()
        for n in list(root.walk()):
            if n.tag == "#comment":
                n.remove()
            n.attrs = {k: v for k, v in n.attrs.items() if k.lower() in allowed}
        return H.serialize(root).strip()
    return _udf("string", run)


def selector_audit(selectors: list[str]):
    """Column function: per selector the number of matches, text length and a 150-character preview."""
    def run(html):
        root, out = H.parse(html), []
        for s in selectors:
            found = list(H.select(root, s))
            t = "".join(n.text() for n in found).strip()
            out.append(dict(selector=s, count=len(found), text_length=len(t), preview=t[:150] + "..." if t else ""))
        return out
    return _udf("array<struct<selector:string,count:int,text_length:int,preview:string>>", run)


def dense_elements(min_length: int = 200):
    """Column function: elements whose own text has at least ``min_length`` characters."""
    def run(html):
        out = []
        for n in H.parse(html).walk():
            t = "".join(k for k in n.kids if isinstance(k, str)).strip()
            if n.tag != "#comment" and len(t) >= min_length:
                out.append(dict(tag=n.tag, id=n.attrs.get("id", ""), cls=n.attrs.get("class", ""), text_length=len(t), preview=t[:100] + "..."))
        return out
    return _udf("array<struct<tag:string,id:string,cls:string,text_length:int,preview:string>>", run)


def paragraph_containers(selector: str):
    """Column function: per matching paragraph the document-order number and label of its container."""
    def run(html):
        root = H.parse(html)
        number = {n: i for i, n in enumerate(root.walk())}
        found = [container_of(p) for p in H.select(root, selector)]
        return [dict(container=number[c], label=c.tag + (f"#{c.attrs['id']}" if c.attrs.get("id") else "")) for c in found if c in number]
    return _udf("array<struct<container:int,label:string>>", run)


def listing_items(selectors: list[str], container: str | None = None):
    """Column function: anchors of listing selectors with the rank of the selector that found them."""
    def run(html):
        root, out = H.parse(html), []
        scope = list(H.select(root, container)) if container else []
        for rank, sel in enumerate(selectors):
            for s in scope or [root]:
                out += [dict(rank=rank, pos=i, href=a.attrs.get("href", ""), title=H.squeeze(a.text()))
                        for i, a in enumerate(H.select(s, sel)) if a.attrs.get("href")]
        return out
    return _udf("array<struct<rank:int,pos:int,href:string,title:string>>", run)


def cards(link: str, company: str, location: str):
    """Column function: list cards around a link: its text, company and location of the same item."""
    def run(html):
        out = []
        for i, a in enumerate(H.select(H.parse(html), link)):
            item = a.up
            while item is not None and item.tag != "li":
                item = item.up
            pick = lambda sel: (lambda n: H.squeeze(n.text()) if n else "")(H.first(item, sel)) if item else ""
            out.append(dict(pos=i, href=a.attrs.get("href", ""), title=H.squeeze(a.text()), company=pick(company), location=pick(location)))
        return out
    return _udf("array<struct<pos:int,href:string,title:string,company:string,location:string>>", run)


def definition_pairs():
    """Column function: ``dt``/``dd`` pairs of a page."""
    def run(html):
        out = []
        for dt in H.select(H.parse(html), "dl dt"):
            later = [k for k in dt.up.kids if not isinstance(k, str)]
            nxt = later[later.index(dt) + 1:][:1]
            value = H.squeeze(nxt[0].text()) if nxt and nxt[0].tag == "dd" else ""
            out.append(dict(key=dt.text().strip().lower().rstrip(":"), value=value))
        return out
    return _udf("array<struct<key:string,value:string>>", run)


COMMENTS = "array<struct<comment_id:string,author:string,content:string>>"


def _flatten(doc, out):
    """Comment tree in reading order; one object counts as a list of one."""
    kids = doc.get("comment") or [] if isinstance(doc, dict) else []
    for c in kids if isinstance(kids, list) else [kids]:
        if isinstance(c, dict):
            if c.get("text"):
                url, author = c.get("url") or "", c.get("author")
                name = author.get("name") if isinstance(author, dict) else None
                out.append(dict(comment_id=url.split("id=")[-1].split("&")[0] if "id=" in url else "",
                                author=name or "Unknown", content=c["text"]))
            _flatten(c, out)
    return out


def flatten_comments(json_ld: Column) -> Column:
    """Comments of a structured-data text, pre-order, whatever the depth of the tree."""
    def run(text):
        try:
            return _flatten(json.loads(text), [])
        except (TypeError, ValueError, RecursionError):
            return []
    return _udf(COMMENTS, run)(json_ld)
