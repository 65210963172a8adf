"""Operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate as DC, mixing as MX, pii as P, tokencount as TC, topk as TK, toxicity as TX, urlfilter as UF
from corpusflow.llm.common import components, word_hashes

DOC = "doc_id long, text string, source string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- top-k ----

def brute_topk(vectors, asks, k):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)
    seen = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in vectors if i is not None and ok(v)}
    out = []
    for q in sorted({i for i, _ in seen if asks(i)}):
        best = {}
        for i, v in seen:
            if i != q:
                for j, w in seen:
                    if j == q:
                        best[i] = max(best.get(i, -10**30), sum(a * b for a, b in zip(v, w)))
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_topk_brute(spark, seed):
    rnd = random.Random(seed)
    v = [(i, [rnd.gauss(0, 1) for _ in range(40)]) for i in range(300)]
    v += [(1000 + i, v[3][1]) for i in range(30)] + [(3, v[3][1])] * 3                 # ties and repeated rows
    v += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 40), (2003, [float("inf")] * 40), (None, [1.0] * 40), (2004, []), (2005, [9.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    v = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in v]
    assert rows(TK.top_k(df, F.col("vec_id") % 50 == 0, 5)) == brute_topk(v, lambda i: i % 50 == 0, 5)


def test_topk_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(TK, "BLOCK", 60), monkeypatch.setattr(TK, "QUERIES", 4)
    v = [(i, [math.sin(i * j) for j in range(1, 50)]) for i in range(250)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    assert rows(TK.top_k(df, F.col("vec_id") % 10 == 0, 3)) == brute_topk(v, lambda i: i % 10 == 0, 3)


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1e18])], "vec_id long, embedding array<double>")
    assert rows(TK.top_k(df, F.col("vec_id") == 0, 5)) == [(0, 1, 1, 2**63 - 1)]
    assert rows(TK.top_k(df.limit(0), F.lit(True), 5)) == []


# ---- decontamination ----

def brute_decontaminate(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, own = split(text), set(), set()
    for i, t in items:
        p = split(t)
        if i is None or not p:
            continue
        m = min(10, len(p))
        for a in range(len(p) - m + 1):
            for b in range(len(w) - m + 1):
                if w[b:b + m] == p[a:a + m]:
                    hit.update(range(b, b + m)), own.add(str(i))
    return len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)


def test_decontaminate_brute(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice(["a", "b", "c", "Dd", "é9"])
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 2, 3, 9, 10, 11, 14])))) for i in range(12)]
    items += [(3, items[3][1]), (77, items[0][1]), (78, None), (None, "a b c"), (79, ""), (80, "--")]
    docs = [(i, rnd.choice([" ", ", "]).join(word() for _ in range(rnd.randrange(0, 60))), "s") for i in range(40)]
    docs += [(50, None, "s"), (51, "", None), (0, docs[0][1], "s")]
    d = spark.createDataFrame(docs, DOC).withColumn("N_WORDS", F.lit(1)).withColumn("_dc", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted([(i, *brute_decontaminate(t, items)) for i, t, _ in docs], key=repr)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows(DC.decontaminate(d, b).select(cols)) == want
    assert rows(DC.decontaminate(d, b, limit=60).select(cols)) == want          # several passes
    assert {r[1:] for r in rows(DC.decontaminate(d, b.limit(0)).select("doc_id", "n_hit", "contaminated"))} == {(0, False)}
    assert DC.decontaminate(d.limit(0), b).count() == 0


# ---- toxicity ----

def test_toxicity_learns_and_is_defined_everywhere(spark):
    rnd = random.Random(2)
    syl = ["an", "the", "ro", "mi", "ku", "sel", "tor", "wen", "da", "pli"]
    word = lambda: "".join(rnd.choice(syl) for _ in range(rnd.randrange(1, 4)))
    def doc(bad):
        w = [word() for _ in range(rnd.randrange(40, 200))]
        for _ in range(len(w) // 15 if bad else 0):
            w[rnd.randrange(len(w))] = rnd.choice(["grobnax", "vilzhek", "quodpest"])
        return " ".join(w)
    data = [(i, doc(i % 5 == 0), "s", int(i % 5 == 0)) for i in range(900)]
    df = spark.createDataFrame(data, DOC + ", toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (3, None), (5000, 1)], "doc_id long, toxic int"))
    model = TX.fit(df, labels.where("doc_id < 600 or doc_id is null"))
    more = spark.createDataFrame([(9001, None, "s", 0), (9002, "", "s", 0), (9003, "x" * 200000, "s", 0)], DOC + ", toxic int")
    out = {r["doc_id"]: r for r in TX.classify(df.unionByName(more).withColumn("Score", F.lit("old")), model).collect()}
    wrong = sum(out[i]["predicted"] != y for i, _, _, y in data if i >= 600)
    assert wrong <= 6
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    assert out[9001]["predicted"] == out[9002]["predicted"] == 0
    assert TX.classify(df.limit(0), model).count() == 0
    none = TX.fit(df, labels.limit(0))
    assert {r["predicted"] for r in TX.classify(df.limit(5), none).collect()} == {0}


# ---- token counts ----

def test_token_counts_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    rnd = random.Random(4)
    pool = [chr(c) for c in [*range(0, 0x250)] * 3 + [*range(0x250, 0x530)] + [0x300, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x130, 0x3A3, 0xAC00, 0x1100, 0x85, 0x180E, 0xFEFF] * 20]
    docs = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(50))) for _ in range(500)]
    docs += ["a<|endoftext|>b", "<|startoftext|>", "it's WE'LL", "", "  ", "a" * 20000, "word " * 3000]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(docs)] + [(-1, None, "s")], DOC).withColumn("N_TOKENS", F.lit(0))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in TC.count_tokens(df, path).collect()}
    for i, t in enumerate(docs):
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert got[i] == (len(t.encode()), n, n > 2048), repr(t[:50])
    assert got[-1] == (0, 0, False)
    assert TC.count_tokens(df.limit(0), path).count() == 0


def test_merge_order_on_a_long_word():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd, lib, own = random.Random(9), Tokenizer.from_file(path), TC.Counter(path)
    for n in (1, 2, 3, 50, 3000):
        w = "".join(rnd.choice("inthear") for _ in range(n))
        assert own.count(w) == len(lib.encode(w, add_special_tokens=False).ids)


# ---- url filters ----

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def brute_url(u):
    if u is None or "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fit, key=len, default=None)


def test_url_rules_and_verdicts(spark):
    urls = ["http://a.example.com/en/1", "https://WWW.Example.com/en/x?y#z", "http://x.www.example.com/en/", "http://example.com/en", "http://b.net/es/",
            "http://b.net/es", "ftp://net/fr/a", "http://c.org/de/9", "http://cheapwords.org/es/1", None, "", "no scheme", "http://", "a://b://c.com/d",
            "http://h.com?x=/en/", "http://h.com#/en/", "http://" + "q" * 500 + ".org/", "http://über.org/éa", "http://h\n.net/es/\nq"] + ["http://d.net/es/1"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("Host", F.lit(1))
    words = spark.createDataFrame([("cheap", 50), ("words", 60), ("c", 3)], "word string, n long")
    got = {r["page_id"]: r for r in UF.judge(pages, RULES, words).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        h, p, r = brute_url(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (h, p, r), u
        assert got[i]["verdict"] in ("allow", "block") and (r is None or got[i]["verdict"] == RULES[r])
    assert got[8]["verdict"] == "block"                        # its words occur in blocked addresses only
    assert UF.judge(pages.limit(0), RULES, words).count() == 0
    assert {r["verdict"] for r in UF.judge(pages.where("page_id in (7, 9)"), RULES, words.limit(0)).collect()} == {"allow"}


def test_segmentation(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 40), ("pill", 45), ("s", 5), ("spam", 9), ("farm", 9)], "word string, n long")
    names = spark.createDataFrame([("cheappills",), ("spamfarm",), ("xyzzy",), ("q" * 100,)], "name string")
    got = {r["name"]: r["parts"] for r in UF.segment_names(names, words).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["spamfarm"] == ["spam", "farm"]
    assert "".join(got["xyzzy"]) == "xyzzy" and got["q" * 100] == ["q" * 100]


# ---- personal data ----

def brute_base(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum((lambda x: x - 9 if x > 9 else x)(int(c) * (1 + i % 2)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_brute():
    rnd = random.Random(8)
    bits = ["@", "a", "b.c", ".", "-", "+", "1", "22", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "255.1.2.3", "256.1.1.1", "(", ")", "é", "+49 30 123456", "x@y.zz", "\n", "00", "@@"]
    for _ in range(4000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 25)))
        assert P.base_spans(t) == brute_base(t), repr(t)
    for t in ["a" * 200000, "1" * 200000, "@" * 100000, "1." * 100000, "a@" * 50000, "1 " * 100000, "+1" + "(" * 100000]:
        P.base_spans(t)                                        # in linear time


def test_pii_query_columns(spark):
    docs = [(1, "write to jo@mail.example.com or +1 (262) 555-3752", "s"), (2, None, "s"), (3, "", "s"), (4, "phone 262 555-3752 call 555 123-4567", "s"),
            (5, "version 1.2.3.4.5 and card 4111 1111 1111 1111", "s"), (1, "écrire à jo@mail.example.com", "s")]
    df = spark.createDataFrame(docs, DOC).withColumn("Spans", F.lit("old"))
    model = P.train(df)
    got = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"]) for r in P.find_spans(df, model).collect()]
    for i, t, _ in docs:
        own = hashlib.sha256(P.joined(brute_base(t or "")).encode()).hexdigest()
        g = next(g for g in got if g[0] == i and g[5] == own)
        base = brute_base(t or "")
        assert g[1:5] == tuple(sum(b[0] == k for b in base) for k in P.KINDS)
        assert set(P.joined(base).split(",")) <= set(g[6].split(",")) | {""}
    assert P.find_spans(df.limit(0), P.train(df.limit(0))).count() == 0
    masked = {r["text"] for r in P.redact(df.withColumn("n_chars", F.length("text")), model).collect()}
    assert "écrire à <EMAIL>" in masked and None in masked and "" in masked


def test_em_finds_the_unreliable_labeler():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.4
    v = np.stack([np.where(rng.random(4000) < a, np.where(y, 1, -1), np.where(y, -1, 1)) for a in (0.95, 0.9, 0.9, 0.5)], axis=1)
    share, table, post = P.reliabilities(v, np.ones(4000))
    assert abs(share - 0.4) < 0.05 and ((post > 0.5) == y).mean() > 0.95
    assert table[1, 0, 2] > 0.9 and abs(table[1, 3, 2] - 0.5) < 0.06


# ---- mixing ----

def brute_targets(sizes, share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        rate = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * rate >= 2 * sizes[s]}
        if not full:
            target.update({s: w[s] * rate for s in open_})
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_targets_and_sizes(spark, monkeypatch, seed):
    monkeypatch.setattr(MX, "RUN_ROWS", 16)
    rnd = random.Random(seed)
    docs = [(i, " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.randrange(0, 30))), rnd.choice(["a", "b", "é", "zz", None] + ["hot"] * 5)) for i in range(600)]
    docs += [(7000, None, "a"), (7001, "", "nulls"), (None, "x y", "b"), docs[0], docs[0]]
    df = spark.createDataFrame(docs, DOC).withColumn("Size", F.lit("clash"))
    out = MX.mix(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = {}
    for _, t, s in docs:
        per[s] = per.get(s, 0) + size(t)
    want = brute_targets(per)
    assert len(out) == len(docs)
    taken = {}
    for r in out:
        assert r["size"] == size(r["text"]) and r["source_size"] == per[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in per:
        assert abs(taken[s] - want[s]) <= 40
        least = int(want[s] // per[s]) if per[s] else 0
        assert all(r["taken"] >= least * r["size"] for r in out if r["source"] == s)      # complete epochs first
    key = lambda r: (repr(r["doc_id"]), r["text"] or "", r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, MX.mix(df.repartition(5)).collect()))
    assert MX.mix(df.limit(0)).count() == 0


def test_mix_prefers_weight(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'w w w w' AS text", "if(id < 3000, 'a', 'b') AS source", "if(id % 2 = 0, 8.0, 0.5) AS q")
    out = MX.mix(df, weight="q", share=0.3).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("t")).collect()
    t = {r["odd"]: r["t"] for r in out}
    assert t[0] > 4 * t[1]


# ---- shared ----

def test_word_hashes_split_like_the_pattern():
    rnd = random.Random(6)
    for _ in range(300):
        t = "".join(rnd.choice(["a", "B", "é", " ", "\t", "\n", "\x0b", "\x85", "\x1f", "zz"]) for _ in range(rnd.randrange(40)))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        h = word_hashes(t.encode())
        assert len(h) == len(w)
        assert len(set(zip(w, h.tolist()))) == len(set(w)) == len(set(h.tolist()))
    long = ("lorem ipsum " * 150000).encode()
    assert len(word_hashes(long)) == 300000 and len(set(word_hashes(long).tolist())) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 50)] + [(200, 201), (201, 200), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
