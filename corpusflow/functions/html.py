"""Markup helpers for the batch functions of ``operators.extract``: a small element tree, a selector
subset and Markdown emission. Everything downstream of a page's fields is Column code."""

from __future__ import annotations

import re
from html import unescape

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
         "html", "li", "main", "menu", "nav", "ol", "output", "p", "pre", "section", "summary", "table", "tbody", "td",
         "tfoot", "th", "thead", "tr", "ul"}
# An opening tag of the key ends an open element of the listed kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, **{b: {"p"} for b in BLOCK - {"li", "dt", "dd", "tr", "td", "th"}}}
SCOPES = {"table", "td", "th", "ul", "ol", "dl", "div", "article", "section", "body", "html", "select"}


class Node:
    __slots__ = ("tag", "attrs", "kids", "up", "no", "index")

    def __init__(self, tag, attrs=None, up=None, no=0):
        self.tag, self.attrs, self.kids, self.up, self.no, self.index = tag, attrs or {}, [], up, no, None

    def walk(self):
        """Elements below this one in document order."""
        stack = [k for k in reversed(self.kids) if not isinstance(k, str)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if not isinstance(k, str))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag != "#comment":
                stack.extend(reversed(n.kids))
        return "".join(out)

    def remove(self):
        if self.up is not None and self in self.up.kids:
            self.up.kids.remove(self)


# One token: comment, element whose content is not markup, tag, declaration, text, stray bracket. A quote
# only opens a value after "="; what is never closed runs to the end of the page. With possessive
# repeats broken markup stays linear.
_IN_TAG = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?|["'])*+"""
_TOKEN = re.compile(rf"""<!--(?P<comment>.*?)(?:-->|\Z)"""
                    rf"""|<(?P<raw>script|style|title|textarea)\b(?P<rawattrs>{_IN_TAG})(?:>|\Z)(?P<content>.*?)(?:</(?P=raw)\s*>|\Z)"""
                    rf"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>{_IN_TAG})(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|(?P<text>[^<]++)|<""", re.S | re.I)
_ATTR = re.compile(r"""([^\s<>/=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")


def _attrs(source: str) -> dict:
    """Attributes of a tag; the first of a repeated name counts."""
    out: dict = {}
    for name, value in _ATTR.findall(source):
        quote = value[:1]
        if quote in ('"', "'"):
            value = value[1:].removesuffix(quote)
        out.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return out


def parse(html: str) -> Node:
    """Element tree of markup; the root knows its elements by tag, in document order."""
    root = at = Node("#root")
    root.index, count = {}, 0

    def add(tag, attrs, up):
        nonlocal count
        count += 1
        node = Node(tag, attrs, up, count)
        up.kids.append(node)
        root.index.setdefault(tag, []).append(node)
        return node
    for m in _TOKEN.finditer(html or ""):
        kind = m.lastgroup
        if kind == "text":
            t = m["text"]
            at.kids.append(unescape(t) if "&" in t else t)
        elif m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                n = at
                while n.up is not None and n.tag != tag:
                    n = n.up
                at = n.up if n.up is not None else at
                continue
            ends, n = CLOSES.get(tag, ()), at
            while ends and n.up is not None and n.tag not in SCOPES - ends:
                if n.tag in ends:
                    at = n.up
                    if tag not in ("tr", "td", "th"):
                        break
                n = n.up
            node = add(tag, _attrs(m["attrs"]), at)
            if tag not in VOID:
                at = node
        elif m["raw"]:
            tag, content = m["raw"].lower(), m["content"]
            add(tag, _attrs(m["rawattrs"]), at).kids.append(content if tag in ("script", "style") else unescape(content))
        elif m["comment"] is not None:
            add("#comment", None, at).kids.append(m["comment"])
        elif m[0] == "<":
            at.kids.append("<")
    return root


# --- selectors: tag, #id, .class, [attr], [attr=v], [attr*=v], [attr^=v], descendants, commas ------------

_STEP = re.compile(r"""([a-zA-Z][\w-]*|\*)|#([\w-]+)|\.([\w-]+)|\[([\w:-]+)(?:([*^]?=)["']?([^"'\]]*)["']?)?\]""")


_SELECTORS: dict = {}


def _compiled(selector: str):
    """Tuple of alternatives; each is a tuple of steps; each step a tuple of tests."""
    if selector not in _SELECTORS:
        _SELECTORS[selector] = tuple(tuple(tuple(m.groups() for m in _STEP.finditer(step)) for step in re.findall(r"(?:\[[^\]]*\]|\S)+", alt))
                 for alt in re.findall(r"(?:\[[^\]]*\]|[^,])+", selector))
    return _SELECTORS[selector]


def _fits(n: Node, tests) -> bool:
    for tag, ident, cls, attr, op, value in tests:
        if tag and tag != "*" and n.tag != tag or ident and n.attrs.get("id") != ident:
            return False
        if cls and cls not in n.attrs.get("class", "").split():
            return False
        if attr:
            have = n.attrs.get(attr)
            if have is None or (op == "=" and have != value) or (op == "*=" and value not in have) or (
                    op == "^=" and not have.startswith(value)):
                return False
    return True


def _matches(n: Node, steps) -> bool:
    if not _fits(n, steps[-1]):
        return False
    rest, up = list(steps[:-1]), n.up
    while rest and up is not None:
        if _fits(up, rest[-1]):
            rest.pop()
        up = up.up
    return not rest


def select(root: Node, selector: str):
    """Matching elements in document order; at the root only elements of the right tag are tried."""
    alts = _compiled(selector)
    tags = [next((t[0] for t in steps[-1] if t[0] and t[0] != "*"), None) for steps in alts]
    if root.index is not None and all(tags):
        found = {n.no: n for tag in dict.fromkeys(tags) for n in root.index.get(tag, ())}
        nodes = [found[k] for k in sorted(found)] if len(tags) > 1 else found.values()
    else:
        nodes = (n for n in root.walk() if n.tag != "#comment")
    return (n for n in nodes if any(_matches(n, s) for s in alts))


def first(root: Node, selector: str) -> Node | None:
    return next(select(root, selector), None)


def squeeze(s: str) -> str:
    return " ".join(s.split())


# --- output --------------------------------------------------------------------------------------------

def serialize(node) -> str:
    """Markup of an element; an explicit stack, so depth does not matter."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, tuple):                       # closing text of an element
            out.append(n[0])
        elif isinstance(n, str):
            out.append(n.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
        elif n.tag == "#comment":
            out.append(f"<!--{''.join(n.kids)}-->")
        else:
            if n.tag != "#root":
                attrs = "".join(' {}="{}"'.format(k, v.replace("&", "&amp;").replace('"', "&quot;")) for k, v in n.attrs.items())
                out.append(f"<{n.tag}{attrs}>")
                if n.tag in VOID:
                    continue
                stack.append((f"</{n.tag}>",))
            raw = n.tag in ("script", "style")
            stack.extend((k,) if raw and isinstance(k, str) else k for k in reversed(n.kids))
    return "".join(out)


def inner_html(n: Node) -> str:
    return "".join(serialize(k) for k in n.kids)


# Text that Markdown would read as a mark gets a backslash.
_ESCAPES = [(re.compile(p), r) for p, r in [
    (r"\\", r"\\\\"), (r"\*", r"\\*"), (r"^-", r"\\-"), (r"^\+ ", r"\\+ "), (r"^(=+)", r"\\\1"), (r"^(#{1,6}) ", r"\\\1 "),
    (r"`", r"\\`"), (r"^~~~", r"\\~~~"), (r"\[", r"\\["), (r"\]", r"\\]"), (r"^>", r"\\>"), (r"_", r"\\_"),
    (r"^(\d+)\. ", r"\1\\. ")]]
# Markdown dialects of the sites. ``compress`` folds runs of blank lines.
HIDDEN = ("script", "style", "#comment")
ARTICLE = dict(bullet="-", em="*", hr="---", compress=True,
               drop=HIDDEN + ("nav", "iframe", "noscript", "button", "select", "textarea", "form"))
FORUM = dict(bullet="-", em="*", hr="* * *", compress=False, drop=HIDDEN)
TOPIC = dict(bullet="*", em="_", hr="---", compress=False, drop=HIDDEN)


_ANY_MARK = re.compile(r"[\\*`\[\]_]|^[-+=#~>]|^\d+\. ")


def _escape(s: str) -> str:
    if not _ANY_MARK.search(s):
        return s
    for p, r in _ESCAPES:
        s = p.sub(r, s)
    return s


def _collapse(root: Node):
    """Whitespace as a browser shows it: runs become one space, none at block edges."""
    last = None                                   # (kids, index) of the text before, inside one block

    def visit(n, pre):
        nonlocal last
        for i, k in enumerate(n.kids):
            if isinstance(k, str):
                if pre:
                    continue
                t = re.sub(r"[ \r\n\t]+", " ", k)
                before = last[0][last[1]] if last else " "
                n.kids[i] = t = t[1:] if t.startswith(" ") and before.endswith(" ") else t
                if t:
                    last = (n.kids, i)
            else:
                block = k.tag in BLOCK or k.tag == "br"
                if block and last:
                    last[0][last[1]] = last[0][last[1]].rstrip(" ")
                if block:
                    last = None
                if k.tag == "img":
                    last = ([""], 0)              # a space after an image stays
                visit(k, pre or k.tag in ("pre", "script", "style"))
                if block:
                    if last:
                        last[0][last[1]] = last[0][last[1]].rstrip(" ")
                    last = None
    visit(root, False)
    if last:
        last[0][last[1]] = last[0][last[1]].rstrip(" ")


def _join(a: str, b: str) -> str:
    """Two pieces with as many line breaks between them as the larger side asks for, at most two."""
    x, y = a.rstrip("\n"), b.lstrip("\n")
    return x + "\n" * min(2, max(len(a) - len(x), len(b) - len(y))) + y


def _around(mark: str, s: str) -> str:
    core = s.strip()
    return s if not core else s[:len(s) - len(s.lstrip())] + mark + core + mark + s[len(s.rstrip()):]


def _emit(n, style) -> str:
    if isinstance(n, str):
        return _escape(n)
    tag = n.tag
    if tag in style["drop"]:
        return ""
    if tag == "br":
        return "  \n"
    if tag == "hr":
        return f"\n\n{style['hr']}\n\n"
    if tag == "img":
        src = n.attrs.get("src", "")
        return f"![{n.attrs.get('alt', '')}]({src})" if src else ""
    if tag == "pre" and n.kids and not isinstance(n.kids[0], str) and n.kids[0].tag == "code":
        code = n.kids[0]
        lang = re.search(r"language-(\S+)", code.attrs.get("class", ""))
        return f"\n\n```{lang.group(1) if lang else ''}\n{code.text().rstrip(chr(10))}\n```\n\n"
    if tag == "code":
        code = re.sub(r"\r?\n|\r", " ", n.text())
        return f"`{code}`" if code else ""
    out = ""
    for k in n.kids:
        out = _join(out, _emit(k, style))
    if tag in ("strong", "b"):
        return _around("**", out)
    if tag in ("em", "i"):
        return _around(style["em"], out)
    if tag == "a" and n.attrs.get("href"):
        core = out.strip()
        link = f"[{core}]({n.attrs['href']})"
        return out[:len(out) - len(out.lstrip())] + link + out[len(out.rstrip()):] if core else link
    if tag == "li":
        body = out.strip("\n").replace("\n", "\n    ")
        up = n.up
        if up is not None and up.tag == "ol":
            no = [k for k in up.kids if not isinstance(k, str)].index(n) + int(up.attrs.get("start") or 1)
            return f"{no}.  {body}\n"
        return f"{style['bullet']}   {body}\n"
    if tag in ("ul", "ol"):
        nested = n.up is not None and n.up.tag == "li"
        return f"\n{out.strip(chr(10))}" if nested else f"\n\n{out.strip(chr(10))}\n\n"
    if not out.strip():
        return "\n\n" if tag in BLOCK else out
    if re.fullmatch(r"h[1-6]", tag):
        return f"\n\n{'#' * int(tag[1])} {out.strip()}\n\n"
    if tag == "blockquote":
        return "\n\n" + re.sub(r"(?m)^", "> ", out.strip("\n")) + "\n\n"
    if tag in BLOCK:
        return f"\n\n{out.strip(chr(10))}\n\n"
    return out


def to_markdown(node: Node, style: dict = ARTICLE) -> str:
    """Markdown of an element's content."""
    holder = Node("div")
    holder.kids = list(node.kids)
    _collapse(holder)
    out = ""
    for k in holder.kids:
        out = _join(out, _emit(k, style))
    if style["compress"]:
        out = re.sub(r"\n\s*\n\s*\n", "\n\n", out)
    return out.strip()
