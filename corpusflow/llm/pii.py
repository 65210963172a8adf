"""PII: weak-supervision aggregation of labelers, and a span classifier trained on their agreed labels."""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusflow.llm.common import append, texts

KINDS = ("email", "ip", "card", "phone")       # kinds of the base patterns
ALL = (*KINDS, "secret")                       # and one that only the method adds: keys, tokens and passwords
SURE = 0.95              # probability from which a span beyond the base ones is added
CONTEXT = 24             # characters before a span that the context labeler reads
FAR = 96                 # characters before that whose words serve as comparison for the corpus' own lead-in words
LEADS, LEAD_LEAST, LEAD_LIFT = 200, 5, 4       # lead-in words per kind; a word stands so often there, so many times as often as farther off

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_HOST = re.compile(r"[A-Za-z0-9-]+")
# Digits are taken run by run: no match can begin inside a run in front of which it fails, so a text is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NATIONAL = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_AT = re.compile(r" ?[\[(]at[\])] ?", re.I)
_DOT = re.compile(r"[A-Za-z0-9-]{1,63}(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)

# National forms of the languages of the corpora: French pairs, German and Spanish groups, and 00 for the plus sign.
_LOCAL_FORMS = re.compile(r"(?<![0-9+(.,/-])(?:0[1-9](?:[ .-][0-9]{2}){4}|0[1-9][0-9]{1,4}(?:[ ]?/[ ]?|[ -])[0-9]{3,8}(?:[ -][0-9]{2,5}){0,2}"
                          r"|[6789][0-9]{2}(?:[ .-][0-9]{3}){2}|00[1-9][0-9]{0,2}(?:[ .-][0-9]{2,4}){2,5})(?![0-9]|[.,/-][0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])")
_GROUPED = re.compile(r"(?<![0-9])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
_DIGIT = re.compile(r"[0-9]")
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{12,512}")

# Gazetteers and context words of the labelers.
TLDS = frozenset("com org net edu gov io info biz de fr es it nl uk eu us ca au jp cn in br ru pl ch at se no example".split())
GOOD_CONTEXT = {"email": "mail e-mail contact write kontakt correo courriel", "ip": "ip host server address addr client login",
                "card": "card visa mastercard amex credit karte tarjeta carte", "phone": "phone tel call mobile fax cell telefon llame telephone handy móvil",
                "secret": "token secret password passwd pwd api_key apikey access_key auth bearer credential private"}
BAD_CONTEXT = "version license isbn token password key hash order invoice page chapter section serial build"
_GOOD = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v.split())) + r")\b", re.I) for k, v in GOOD_CONTEXT.items()}
_BAD = re.compile(r"\b(?:" + "|".join(BAD_CONTEXT.split()) + r")\b", re.I)
_PUBLIC = re.compile(r"\b(?:commit|revision|checksum|digest|sha1|sha256|sha512|md5|etag|integrity|uuid|guid|build|blob|tree)\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Matches of the base pattern for mail addresses, leftmost, without overlap; and addresses without a dot. Each
    at sign is looked at once: the name is the run of its characters before, from the last match on."""
    last, prev = 0, -1
    at = text.find("@")
    while at >= 0:
        seg = text[max(last, prev + 1):at]
        name = len(seg) - len(seg.rstrip(_LOCAL)) if seg else 0
        prev = at
        if name:
            m = _DOMAIN.match(text, at + 1)
            if m:
                yield at - name, m.end(), True
                last = m.end()
            else:
                h = _HOST.match(text, at + 1)
                if h:
                    yield at - name, h.end(), False
        at = text.find("@", at + 1)


def candidates(text: str):
    """Spans (kind, start, end, base): the base matches that hold, and weaker candidates the labelers judge. A weak one
    that overlaps a base span is part of it and left out."""
    found = list(_matches(text))
    base = sorted((s, e) for _, s, e, good in found if good)
    starts = [s for s, _ in base]
    for k, s, e, good in found:
        if not good and base:
            i = bisect_left(starts, e)
            if any(base[j][1] > s for j in range(max(0, i - 3), i)):
                continue
        yield k, s, e, good


def _matches(text: str):
    if "@" in text:
        for s, e, good in emails(text):
            yield "email", s, e, good
    for m in _AT.finditer(text) if "(at" in text or "[at" in text or "(AT" in text or "[AT" in text else ():
        seg = text[max(0, m.start() - 64):m.start()]
        name = len(seg) - len(seg.rstrip(_LOCAL))
        d = _DOT.match(text, m.end())
        if name and d and "." in re.sub(r" ?[\[(]dot[\])] ?", ".", d[0], flags=re.I):
            yield "email", m.start() - name, d.end(), False
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 8 <= len(_digits(m[0])) <= 15
    for m in _IP6.finditer(text) if text.count(":") > 1 else ():
        yield "ip", m.start(), m.end(), False
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if len(d) >= 12:
                yield "card", m.start(), m.end(), 16 <= len(d) <= 19 and luhn(d)
    for m in _GROUPED.finditer(text):
        yield "card", m.start(), m.end(), False
    for m in _NATIONAL.finditer(text):
        yield "phone", m.start(), m.end(), False
    for m in _LOCAL_FORMS.finditer(text):
        yield "phone", m.start(), m.end(), False
    for m in _SECRET.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            yield "secret", m.start(), m.end(), False


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [(k, s, e) for k, s, e, good in candidates(text) if good]
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def lead(text: str, s: int) -> str:
    """The word a span follows, in lower case."""
    m = re.findall(r"[^\W\d_]{2,24}", text[max(0, s - CONTEXT):s])
    return m[-1].lower() if m else ""


def votes(kind: str, text: str, s: int, e: int, base: bool, leads: dict[str, frozenset]) -> tuple[int, ...]:
    """One vote (1 for, -1 against, 0 none) of each labeler: pattern, shape, gazetteer, context, surroundings, and the
    corpus' own lead-in words."""
    span, digits = text[s:e], _digits(text[s:e][:64])
    loose = kind == "email" or kind == "phone" and span[0] != "+" or kind == "ip" and ":" in span or kind == "card" and span[4:5] in ("_", ".", "/")
    pattern = 1 if base else 0 if loose else -1
    if kind == "email":
        tld = re.split(r"[.\s)\]]+", span)[-1].lower()
        shape = 1 if 2 <= len(tld) <= 24 and tld.isalpha() and re.search(r"[.]|dot", span[-80:], re.I) else -1
        known = 1 if tld in TLDS else 0
    elif kind == "secret":
        pattern = 1 if re.fullmatch(r"[A-Z]{3,4}[0-9A-Z]{16}|[a-z]{2,4}[_-][A-Za-z0-9_-]{16,}", span) else 0
        odd = sum(a.isdigit() != b.isdigit() or a.islower() != b.islower() for a, b in zip(span, span[1:]))
        shape = 1 if len(span) >= 16 and odd * 5 >= len(span) and len(set(span)) >= 10 else -1
        # A quoted or assigned value is meant to be read by a program.
        known = 1 if re.search(r"[:=]\s*[\"']?$", text[max(0, s - 4):s]) else -1
    elif kind == "ip" and ":" in span:
        groups = [g for g in span.split(":") if g]
        shape = 1 if len(groups) >= 3 and (len(groups) == 8 or span.count("::") == 1) and any(len(g) == 4 for g in groups) else -1
        known = 1 if re.match(r"2[0-9a-f]{3}:|f[de][0-9a-f]{2}:|fe80:", span.lower()) else 0
    elif kind == "ip":
        p = [x[:4] for x in span.split(".")]
        shape = 1 if all(int(x) <= 255 and (x == "0" or x[0] != "0") for x in p) else -1
        known = -1 if p[0] in ("0", "00", "000") or int(p[0]) >= 240 else 1
    elif kind == "card":
        shape = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        known = 1 if re.match(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35", digits) else -1
    else:
        shape = 1 if 8 <= len(digits) <= 15 else -1
        known = 1 if span[0] == "+" and digits[0] != "0" else 0
    before = text[max(0, s - CONTEXT):s]
    context = 1 if _GOOD[kind].search(before) else -1 if (_PUBLIC if kind == "secret" else _BAD).search(before) else 0
    left, right = text[s - 1:s], text[e:e + 1]
    tied = ("/", "#", ".", "?", "&") if kind == "secret" else ("_", "=", "/", "#", "-")
    alone = -1 if (left.isalnum() or left in tied and left) or right.isalnum() or right in ("_", "=", "/") and right else 1
    return pattern, shape, known, context, alone, int(lead(text, s) in leads.get(kind, ()))


def features(kind: str, text: str, s: int, e: int) -> tuple[int, ...]:
    """Bins of the span itself: number of digits, length, separators, first letter class before and after."""
    span = text[s:e]
    n = len(_digits(span[:64]))
    sep = 2 if " " in span or "(" in span else 1 if "-" in span or "." in span else 0
    kind_of = lambda c: 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3
    return min(n // 4, 5), min((e - s) // 8, 5), sep, kind_of(text[s - 1:s]), kind_of(text[e:e + 1])


def lead_words(docs: DataFrame, text: str = "text") -> dict[str, frozenset]:
    """Words of the corpus that introduce personal data, by kind: those right before base spans of all texts (for secrets,
    before quoted or assigned values) that stand there ``LEAD_LIFT`` times as often as in the ``FAR`` characters before. At most
    ``LEADS`` a kind come to the driver, the most frequent."""
    def run(batches):
        for batch in batches:
            n: dict[tuple, list] = {}
            for t in texts(batch, text):
                for kind, s, e, base in candidates(t):
                    if base or kind == "secret" and re.search(r"[:=]\s*[\"']?$", t[max(0, s - 4):s]):
                        w = lead(t, s)
                        if w:
                            n.setdefault((kind, w), [0, 0])[0] += 1
                        for x in re.findall(r"[^\W\d_]{2,24}", t[max(0, s - CONTEXT - FAR):max(0, s - CONTEXT)]):
                            n.setdefault((kind, x.lower()), [0, 0])[1] += 1
            rows = [(k, w, a, b) for (k, w), (a, b) in n.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             names=["kind", "word", "near", "far"])

    words = docs.select(F.col(f"`{text}`").alias(text)).mapInArrow(run, "kind string, word string, near long, far long")
    words = words.groupBy("kind", "word").agg(F.sum("near").alias("near"), F.sum("far").alias("far"))
    words = words.where((F.col("near") >= LEAD_LEAST) & (F.col("near") >= LEAD_LIFT * (F.col("far") + 1)))
    out: dict[str, frozenset] = {}
    for k in ALL:
        out[k] = frozenset(r["word"] for r in words.where(F.col("kind") == k).orderBy(F.desc("near"), "word").limit(LEADS).collect())
    return out


def pattern_counts(docs: DataFrame, leads: dict[str, frozenset], text: str = "text") -> DataFrame:
    """(pattern, n): how often each combination of kind, votes and bins occurs over all texts. There are at most
    5 * 3^6 * 1728 of them however large the corpus; each batch sends its sums."""
    def run(batches):
        for batch in batches:
            n: dict[str, int] = {}
            for t in texts(batch, text):
                for kind, s, e, base in candidates(t):
                    p = json.dumps([kind, votes(kind, t, s, e, base, leads), features(kind, t, s, e)])
                    n[p] = n.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["pattern", "n"])

    schema = StructType([StructField("pattern", StringType()), StructField("n", LongType())])
    return docs.select(F.col(f"`{text}`").alias(text)).mapInArrow(run, schema).groupBy("pattern").agg(F.sum("n").alias("n"))


def reliabilities(v: np.ndarray, n: np.ndarray, rounds: int = 50):
    """EM over vote rows ``v`` (-1, 0, 1) with counts: (share of true spans, P(vote | class) as [class, labeler, vote],
    posterior of each row). Starts from the sign of the vote sum.

    A labeler that abstains (0) says nothing, and none is taken to be worse than a coin: without that, forms on which the
    pattern labeler abstains would be told from the base ones as the other class. Two imagined votes of a fair labeler
    stand for what a class without rows doesn't show."""
    post = np.clip(0.5 + 0.2 * v.sum(axis=1), 0.05, 0.95)
    yes, no = (v == 1).astype(float), (v == -1).astype(float)
    silent = np.average(v == 0, axis=0, weights=n)
    for _ in range(rounds):
        w = np.stack([n * (1 - post), n * post])
        share = float(np.clip((w[1].sum() + 1) / (n.sum() + 2), 0.02, 0.98))
        up = (w @ yes + np.array([[0.4], [1.6]])) / (w @ (yes + no) + 2)
        up = np.stack([np.clip(up[0], 0.01, 0.5), np.clip(up[1], 0.5, 0.99)])
        log = np.log(up) @ yes.T + np.log(1 - up) @ no.T + np.log([1 - share, share])[:, None]
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    table = np.stack([(1 - up) * (1 - silent), np.broadcast_to(silent, up.shape), up * (1 - silent)], axis=2)
    return share, table, post


def _inputs(kind: str, vote, bins) -> list[float]:
    out = [1.0] + [float(kind == k) for k in ALL]
    for x in vote:
        out += [float(x == 1), float(x == -1)]
    for x, size in zip(bins, (6, 6, 3, 4, 4)):
        out += [float(x == i) for i in range(size)]
    return out


class Model:
    """Reliabilities by kind and the span classifier."""

    def __init__(self, rows: list[tuple[str, int]], leads: dict[str, frozenset] | None = None):
        self.leads = leads or {}
        parsed = sorted((json.loads(p), n) for p, n in rows)
        self.tables, soft = {}, np.zeros(len(parsed))
        for k in ALL:
            at = [i for i, (p, _) in enumerate(parsed) if p[0] == k]
            if at:
                share, table, post = reliabilities(np.array([parsed[i][0][1] for i in at]), np.array([parsed[i][1] for i in at], float))
                self.tables[k], soft[at] = (share, table), post
        self.beta = None
        if parsed:
            x = np.array([_inputs(*p) for p, _ in parsed])
            w = np.array([n for _, n in parsed], float)
            self.beta = self._fit(x, soft, w / w.sum() * min(w.sum(), 1e4))

    @staticmethod
    def _fit(x, y, w):
        beta = np.zeros(x.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.eye(len(beta)), x.T @ (w * (y - p)) - beta)
            beta = beta + np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-7:
                break
        return beta

    def probability(self, kind: str, text: str, s: int, e: int, base: bool) -> float:
        if self.beta is None:
            return 0.0
        z = float(np.dot(_inputs(kind, votes(kind, text, s, e, base, self.leads), features(kind, text, s, e)), self.beta))
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))

    def spans(self, text: str):
        """(base spans, all spans): candidates the classifier is sure of join the spans they don't overlap."""
        found = list(candidates(text))
        base = [(k, s, e) for k, s, e, good in found if good]
        out, taken = list(base), []
        for s, e in sorted((s, e) for _, s, e in base):         # disjoint and sorted
            if taken and s < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
            else:
                taken.append((s, e))
        for k, s, e, good in found:
            if not good and self.probability(k, text, s, e, good) >= SURE:
                i = bisect_left(taken, (s, e))
                if (i == 0 or taken[i - 1][1] <= s) and (i == len(taken) or e <= taken[i][0]):
                    out.append((k, s, e))
                    taken.insert(i, (s, e))
        order = lambda x: (ALL.index(x[0]), x[1])
        return sorted(base, key=order), sorted(out, key=order)


def train(docs: DataFrame, text: str = "text") -> Model:
    """Labelers vote on all candidates of the corpus; their summed patterns, a bounded table, train the model. An empty table
    gives a model that adds nothing. Repeated rows count as often as they occur; texts are read whole, whatever their
    length."""
    leads = lead_words(docs, text)
    return Model([(r["pattern"], r["n"]) for r in pattern_counts(docs, leads, text).collect()], leads)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_FIELDS = [StructField(f"n_{k}", LongType()) for k in KINDS] + [StructField("base_sha256", StringType()), StructField("spans", StringType())]


def find_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus n_email, n_ip, n_card, n_phone and base_sha256 (of the base spans) and spans (all of them), as
    kind:start:end in code points. Null and empty texts hold none; repeated rows and texts of any length are handled like
    others, an empty table gives an empty result. Columns of these names are replaced."""
    def run(batch: pa.RecordBatch):
        pairs = [model.spans(t) for t in texts(batch, text)]
        counts = [pa.array([sum(x[0] == k for x in b) for b, _ in pairs], pa.int64()) for k in KINDS]
        return counts + [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in pairs], pa.string()),
                         pa.array([joined(a) for _, a in pairs], pa.string())]

    return append(docs, _FIELDS, run)


def redact(docs: DataFrame, model: Model, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The texts with every span replaced by its kind in angle brackets (overlapping ones by the first), and their
    length in ``length`` where there is such a column. Texts without spans, and null ones, stay as they are; repeated rows
    and texts of any length are handled like others, an empty table gives an empty result."""
    kinds = dict(docs.dtypes)
    touched = [f for f in docs.schema.fields if f.name in (text, length)]

    def run(batch: pa.RecordBatch):
        col = batch.column(batch.schema.get_field_index(text)).to_pylist()
        out = []
        for t in col:
            if t:
                parts, at = [], 0
                for k, s, e in sorted(model.spans(t)[1], key=lambda x: (x[1], -x[2])):
                    if s >= at:
                        parts += [t[at:s], f"<{k.upper()}>"]
                        at = e
                    else:
                        at = max(at, e)
                t = "".join(parts) + t[at:] if parts else t
            out.append(t)
        new = {text: pa.array(out, pa.string())}
        if length in kinds:
            old = batch.column(batch.schema.get_field_index(length)).to_pylist()
            kind = batch.schema.field(length).type
            new[length] = pa.array([o if a == b else len(a) for o, a, b in zip(old, out, col)], kind)
        return [new[f.name] for f in touched]

    return append(docs, touched, run).select([F.col(f"`{c}`") for c in docs.columns])
