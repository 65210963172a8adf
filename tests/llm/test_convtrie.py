"""Conversation prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from corpusflow.llm import convtrie as CT, queries as Q
from pyspark.sql import functions as F

TURN = "conv_id long, turn long, role string, text string, depth int, node string"


def rebuilt(rows):
    by = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            by.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), role, text))
    by = {c: [(r, t) for _, r, t in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = by.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    member = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            member.setdefault(tuple(turns[:d]), []).append(c)
    total = {p: [0, 0, 0] for p in member}
    for p in sorted(member, key=len, reverse=True):
        if not total[p][0]:
            total[p][1] = 1
        total[p][2] += (len(member[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            up = total[p[:-1]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + total[p][1], up[2] + total[p][2]
    out = []
    for p, ms in member.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(convs[c]) == len(p))
        out.append((min(ms), len(p), min(member[p[:-1]]) if p else None, len(ms), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(n, seed=3):
    rng, rows = random.Random(seed), []
    for c in range(n):
        if c % 11 == 7:
            continue                                   # absent, sometimes the first of a block
        common = [("user", "hi"), ("bot", "hello")] if c % 3 else []
        for i, (role, text) in enumerate(common + [(rng.choice(["user", "bot", None]), rng.choice(["a", "b", "", None, "é\n"])) for _ in range(rng.choice([0, 1, 3, 12]))]):
            rows.append((c, rng.choice([i, i, None]) if c % 4 == 1 else i, role, text, 0, "x"))
    rows += [(900, i, "user", "long" + str(i % 3), 0, "x") for i in range(300)]        # one very long conversation
    rows += [(901, i, "user", "long" + str(i % 3), 0, "x") for i in range(290)] + [(902, 2, "u", "t", 0, "x")] * 3
    rows += [(c, i, "user", f"same {i}", 0, "x") for c in range(1000, 1400, 5) for i in range(5)]       # copies
    rows += [(None, 1, "user", "nobody", 0, "x")]
    rng.shuffle(rows)
    return rows


def got(spark, rows, **sizes):
    df = spark.createDataFrame(rows, TURN).repartition(4)
    return sorted(map(tuple, CT.prefix_trie(*Q.rebuilt(df), **sizes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "band": 16, "limit": 5}, {"shard": 0, "band": 1, "limit": 2}])
def test_trie_equals_brute_force(spark, sizes):
    """One shard for all; small shards with a banded upper part and spilling queues; every inner node in the upper part.
    With nulls, ties, repeated turns, absent and turnless conversations, copies and extra columns of names used inside."""
    rows = conversations(60)
    assert got(spark, rows, **sizes) == brute(rebuilt(rows))


def test_no_conversations(spark):
    assert got(spark, []) == got(spark, [(None, 1, "a", "b", 0, "x")]) == []


def test_very_long_text_and_turnless_conversation(spark):
    # h of conversation 1 is at least one and the start of its block is absent: it has no turns left.
    c = next(c for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(c, 0, "user", "w" * 3_000_000, 0, "x"), (15, 0, "user", "w" * 3_000_000, 0, "x")]
    assert got(spark, rows) == brute(rebuilt(rows))


def test_queue_spills_and_keeps_the_order(monkeypatch):
    rng, q, want = random.Random(1), CT.Queue(3), {}
    messages = [(rng.randrange(-4, 4), bytes([rng.randrange(3)]) * 16, i, -i) for i in range(200)]
    for m in messages:
        q.push(m)
        want.setdefault(m[:2], []).append(m)
    assert q.runs
    for key in sorted(want):
        assert sorted(q.take(*key)) == sorted(want[key])
        assert list(q.take(*key)) == []


def test_end_hashes_of_many_equal_conversations(spark, monkeypatch):
    """The ids of one node come in several texts and over several partitions."""
    monkeypatch.setattr(CT, "IDS", 7)
    convs = spark.range(2000).select(F.col("id").alias("conv_id"), F.lit(1).cast("long").alias("length"))
    turns = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(b"0" * 16).alias("digest"), F.lit(3).cast("long").alias("bytes"), "length")
    out = {r["depth"]: r for r in CT.prefix_trie(turns, convs, shard=10).collect()}
    assert out[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(2000))).encode()).hexdigest() and out[0]["ends_sha256"] == CT.NONE
    assert (out[0]["n_children"], out[0]["n_leaves"], out[0]["saved_tokens"]) == (1, 1, 3 * 1999)
