"""Spans that the trained classifier adds to the base patterns: planted variants must come out, look-alikes must not."""

import random

import pytest

from corpusflow.llm import pii as P


def card(rnd):
    d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if P.luhn(d + c))


def hexes(rnd, n):
    return "".join(rnd.choice("0123456789abcdef") for _ in range(n))


def personal(rnd):
    """(kind, lead-in, text): forms the base patterns don't take."""
    n = lambda k: "".join(rnd.choice("123456789") for _ in range(k))
    c = card(rnd)
    return rnd.choice([
        ("email", "mail", f"jo{n(2)} [at] host{n(1)} [dot] com"), ("email", "contact", f"ann.{n(3)}(at)mail.example.org"),
        ("ip", "server", f"2001:db8:{hexes(rnd, 4)}:{hexes(rnd, 4)}:{hexes(rnd, 4)}:{hexes(rnd, 4)}:{hexes(rnd, 4)}:{hexes(rnd, 4)}"),
        ("ip", "host", f"fe80::{hexes(rnd, 4)}:{hexes(rnd, 4)}:{hexes(rnd, 4)}"), ("card", "card", "_".join(c[i:i + 4] for i in (0, 4, 8, 12))),
        ("card", "visa", ".".join(c[i:i + 4] for i in (0, 4, 8, 12))), ("phone", "call", f"({n(3)}) {n(3)}-{n(4)}"), ("phone", "tel", f"06 {n(2)} {n(2)} {n(2)} {n(2)}"),
        ("phone", "telefon", f"030/{n(7)}"), ("phone", "phone", f"0044 {n(3)} {n(4)}"), ("secret", 'token =', f'"{hexes(rnd, 40)}"'), ("secret", "password:", f"Qz{n(3)}xK{n(4)}pLm{n(2)}Wd")])


def decoy(rnd):
    """Look-alikes."""
    n = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    bad = next(x for x in iter(lambda: n(16), None) if not P.luhn(x))
    return rnd.choice([f"commit {hexes(rnd, 40)}", f"order {n(3)}-{n(3)}-{n(4)}x", f"isbn {bad}", f"version 1.{n(4)}.{n(3)}.999", f"serial {bad[:4]}_{bad[4:8]}_{bad[8:12]}_{bad[12:]}",
                       f"at {n(2)}:{n(2)}:{n(2)}", "std::vector::iterator", f"page {n(5)}", f"/img/{hexes(rnd, 32)}.png", f"sha256 {hexes(rnd, 64)}", f"user(at)home", "antidisestablishment2"])


def corpus(seed, n):
    rnd = random.Random(seed)
    base = lambda: rnd.choice([f"mail a{rnd.randrange(999)}@ex{rnd.randrange(99)}.com", f"phone +49 30 {rnd.randrange(10**6, 10**7)}", f"card {card(rnd)}", f"server 10.{rnd.randrange(256)}.0.{rnd.randrange(256)}"])
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9)))
    docs, want = [], []
    for i in range(n):
        text, spans = " ".join(word() for _ in range(rnd.randrange(3, 30))), []
        for _ in range(rnd.randrange(0, 3)):
            text += " " + base() + " " + word()
        if i % 3 == 0:
            kind, intro, value = personal(rnd)
            start = len(text) + len(intro) + 2 + value.startswith('"')
            text += f" {intro} {value} " + word()
            spans.append((kind, start, start + len(value.strip('"'))))
        elif i % 3 == 1:
            text += " " + decoy(rnd) + " " + word()
        docs.append((i, text)), want.append(spans)
    return docs, want


@pytest.fixture(scope="module")
def measured(spark):
    train, _ = corpus(1, 3000)
    test, want = corpus(2, 1500)
    df = spark.createDataFrame(train, "doc_id long, text string")
    model = P.train(df)
    hits, missed, extra = {}, [], []
    for (_, text), spans in zip(test, want):
        base, out = model.spans(text)
        added = [x for x in out if x not in base]
        for kind, s, e in spans:
            ok = any(k == kind and a <= s and e <= b for k, a, b in added)
            hits.setdefault(kind, []).append(ok)
            if not ok:
                missed.append((kind, text[s:e]))
        extra += [(k, text[a:b]) for k, a, b in added if not any(a <= s and e <= b or s <= a and b <= e for _, s, e in spans)]
    return model, hits, missed, extra


def test_planted_forms_come_out(measured):
    _, hits, missed, _ = measured
    for kind in P.ALL:
        assert sum(hits[kind]) >= 0.9 * len(hits[kind]), (kind, missed[:10])


def test_look_alikes_stay(measured):
    _, hits, _, extra = measured
    found = sum(map(sum, hits.values()))
    assert len(extra) <= 0.02 * (found + len(extra)), extra[:10]


def test_lead_words_come_from_the_corpus(measured):
    model = measured[0]
    assert {"mail"} <= model.leads["email"] and {"phone"} <= model.leads["phone"] and {"token", "password"} & model.leads["secret"]


def test_added_spans_do_not_overlap_and_base_stays(spark):
    docs, _ = corpus(3, 400)
    df = spark.createDataFrame(docs + [(900, None), (901, "")], "doc_id long, text string")
    model, texts = P.train(df), dict(docs)
    for r in P.find_spans(df, model).collect():
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        base = P.base_spans(texts.get(r["doc_id"]) or "")
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda x: (P.ALL.index(x[0]), x[1]))
        for k, s, e in spans:
            assert (k, s, e) in base or all(e <= b or c <= s for x, b, c in spans if (x, b, c) != (k, s, e))
    masked = {r["doc_id"]: r["text"] for r in P.redact(df, model).collect()}
    assert any("<SECRET>" in t for t in masked.values() if t) and masked[900] is None
