"""Elias-Fano, the trie, and the scores against a dictionary model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import lmscore as L
from corpusflow.llm.common import fold


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 10**12), (5, 4), (1000, 1200), (1000, 10**15), (3000, 10**6), (700, 2**62)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n + 1)
    v = np.unique(rng.integers(0, top + 1, n, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
    ef = L.EliasFano(*L.EliasFano.build(v))
    assert (ef.access(np.arange(len(v))) == v).all()
    ask = np.concatenate([v, rng.integers(0, top + 2, 500, dtype=np.uint64)])
    want = {int(x): i for i, x in enumerate(v)}
    assert ef.find(ask).tolist() == [want.get(int(x), -1) for x in ask]


def test_repeats_in_a_sequence():
    v = np.array([0, 0, 3, 3, 3, 900, 900], dtype=np.uint64)
    ef = L.EliasFano(*L.EliasFano.build(v))
    assert (ef.access(np.arange(7)) == v).all() and ef.find(v).tolist() == [0, 0, 2, 2, 2, 5, 5]


def test_trie_round_trip():
    rng = np.random.default_rng(4)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.zipf(1.3, 5000) % 900, rng.integers(0, 5000, 5000))})
    h, w = (np.array(x, dtype=np.uint64) for x in zip(*pairs))
    value = rng.integers(1, 60000, len(h)).astype(np.uint16)
    block = L.Trie.build(h, w, value)
    for trie in (L.Trie(block), L.Trie(L.mapped(block))):
        assert (trie.lookup(h, w) == value).all()
        ask = [(int(a), int(b)) for a, b in zip(rng.integers(0, 1000, 3000), rng.integers(0, 6000, 3000))]
        held = dict(zip(pairs, value.tolist()))
        assert trie.lookup(*(np.array(x, dtype=np.uint64) for x in zip(*ask))).tolist() == [held.get(p, 0) for p in ask]
    empty = np.zeros(0, np.uint64)
    assert L.Trie(L.Trie.build(empty, empty, empty)).lookup(h, w).sum() == 0
    assert len(block) < 6 * len(h)


def test_pack():
    for a in ([], [0], [1, 2**63], list(range(3000))):
        assert L.unpack(L.pack(np.array(a, dtype=np.uint64))).tolist() == a


def brute(docs, held):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]
    toks = [split(t) for _, t in docs]
    train = [t for (i, _), t in zip(docs, toks) if not held(i)]
    c = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["<s>", *t], t))
    n, v = sum(c.values()), len(c)
    n1, n2 = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    uni = lambda w: (c[w] - d) / n if c[w] else (d * v / n if n else 1.0)
    out = []
    for (i, _), t in zip(docs, toks):
        score = 0.0
        for h, w in zip(["<s>", *t], t):
            ch = len(train) if h == "<s>" else c[h]
            lam = L.TRUST * ch / (ch + L.TRUST_AT)
            score += math.log10((lam * pair[h, w] / ch if ch else 0.0) + (1 - lam) * uni(w))
        out.append((i, held(i), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores_brute(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(L, "CHUNK_TOKENS", 300), monkeypatch.setattr(L, "SHARD_BYTES", 2000)
    rnd = random.Random(3)
    word = lambda: rnd.choice("abcdefgH") + str(int(rnd.paretovariate(0.6)) % 3000)
    docs = [(i, " ".join(word() for _ in range(rnd.randrange(0, 80)))) for i in range(200)] + [(500, None), (501, ""), (502, " \n"), (None, "a1 b1")]
    docs += [docs[4], docs[4]]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("Score", F.lit("x")).repartition(3)
    key = lambda r: (repr(r[0]), r[2], r[5])
    got = sorted((tuple(r) for r in L.score(df, fold(F.col("doc_id")) == 1).collect()), key=key)
    want = sorted(brute(docs, held), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 0.02 * w[2] + 0.02


def test_no_training_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = L.score(df, F.lit(True)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)}
    assert L.score(df.limit(0), F.lit(False)).count() == 0


def test_the_model_beats_the_base_on_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.score(df, fold(F.col("doc_id")) == 1).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert out["s"] > out["b"]
