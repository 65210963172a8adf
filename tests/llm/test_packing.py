"""Packing: ids against the tokenizer library, sequences against the rules and a plain best fit."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusflow.llm import packing as PK
from corpusflow.llm.queries import vocabulary

DOC = "doc_id long, text string, length int, sequence_id string, _rank int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


TEXTS = ["", "a", "It's IT'S  we'll\r\n\r\n x\t", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "naïve café — 漢字かな交じり文 ١٢٣ Ⅷ 😀👍🏽",
         "\u0085   x\u001c​﻿", "1234567890" * 30, " " * 50 + "\n" * 20, "한국어 텍스트", "́é", "don't" * 100]


def test_ids_are_those_of_the_library(library):
    encode = PK.encoder(vocabulary("byte_bpe_50k.json"))
    for t in TEXTS + ["".join(p) for p in itertools.permutations(["<|end", "oftext|>", " ", "é"])]:
        assert list(encode(t)) == library(t)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    if not hasattr(test_ids_of_any_text, "pair"):
        from tokenizers import Tokenizer
        path = vocabulary("byte_bpe_50k.json")
        test_ids_of_any_text.pair = PK.encoder(path), Tokenizer.from_file(path)
    fast, lib = test_ids_of_any_text.pair
    assert list(fast(text)) == lib.encode(text, add_special_tokens=False).ids


def test_other_files_go_to_the_library():
    encode = PK.encoder(vocabulary("word_bpe_49k.json"))
    from tokenizers import Tokenizer
    assert list(encode("Hello  World")) == Tokenizer.from_file(vocabulary("word_bpe_49k.json")).encode("Hello  World", add_special_tokens=False).ids


def check(packed, want, limit):
    """Every piece once, no sequence beyond the limit, offsets gapless from 0."""
    assert sorted((r["doc_id"] is None, r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def brute_pieces(rows, library, limit):
    out = []
    for doc_id, text, *_ in rows:
        ids = library(text or "") + [2]
        head = len(ids) % limit or limit
        for k, a in enumerate([0, *range(head, len(ids), limit)]):
            part = ids[a:head if k == 0 else a + limit]
            out.append((doc_id is None, doc_id, k, a, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return out


def test_packed_documents_equal_brute_force(spark, library):
    """Null, empty and very long texts, null and repeated ids, repeated rows, extra columns with names used inside."""
    rng = random.Random(5)
    rows = [(i if i % 10 else None, rng.choice(TEXTS) * rng.choice([1, 1, 5, 40]), 1, "s", 2) for i in range(300)]
    rows += [(7, None, 1, "s", 2)] * 3 + [(8, "word " * 60_000, 1, "s", 2)] + rows[:20] + [(9, "", 1, "s", 2)] * 1000
    df = spark.createDataFrame(rows, DOC).repartition(5)
    packed = PK.pack(PK.cut(df, vocabulary("byte_bpe_50k.json"), ids=True))
    got = packed.collect()
    n = check(got, brute_pieces(rows, library, 1024), 1024)
    assert n <= -(-sum(r["length"] for r in got) // 1024) + 2
    # The sequences themselves: the ids of their pieces, one after the other.
    whole = {r["sequence_id"]: r for r in PK.sequences(packed).collect()}
    assert len(whole) == n and all(len(r["ids"]) == r["length"] <= 1024 for r in whole.values())
    for r in got:
        assert whole[r["sequence_id"]]["ids"][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_small_limit_and_exact_multiples(spark, library):
    rows = [(i, "a b c d e f g h"[:2 * i + 1], 1, "s", 2) for i in range(8)]
    got = PK.pack(PK.cut(spark.createDataFrame(rows, DOC), vocabulary("byte_bpe_50k.json"), limit=4), limit=4).collect()
    check(got, brute_pieces(rows, library, 4), 4)


def test_empty_table_and_wrong_lengths(spark):
    path = vocabulary("byte_bpe_50k.json")
    assert PK.pack(PK.cut(spark.createDataFrame([], DOC), path)).collect() == []
    with pytest.raises(ValueError):
        PK.pack(PK.cut(spark.createDataFrame([(1, "a " * 50, 1, "s", 2)], DOC), path), limit=8)


def plain_best_fit(lengths, limit):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if fit:
            i = min(fit, key=lambda i: rooms[i])
            rooms[i] -= x
        else:
            rooms.append(limit - x)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.sampled_from([40, 64]))
def test_plan_uses_every_piece_and_packs_like_best_fit(lengths, limit):
    plan = PK.plan(Counter(lengths), limit)
    used = Counter()
    for parts, times in plan:
        assert sum(parts) <= limit and times > 0
        for x in parts:
            used[x] += times
    assert used == Counter(lengths)
    n = sum(t for _, t in plan)
    assert -(-sum(lengths) // limit) <= n <= plain_best_fit(lengths, limit) + 1


def test_exact_complements_are_taken():
    """Single, pair and triple complements, each under what is available."""
    assert PK.plan({700: 5, 324: 5}, 1024) == [((700, 324), 5)]
    assert sum(n for _, n in PK.plan({600: 3, 300: 3, 124: 3}, 1024)) == 3
    # Best fit alone needs three: 600 + 200 + 200, 600 + 150 + 150 + 74 and 74.
    assert PK.plan({600: 2, 200: 2, 150: 2, 74: 2}, 1024) == [((600, 150, 200, 74), 2)]
    assert PK.plan({512: 7}, 1024) == [((512, 512), 3), ((512,), 1)]
    assert PK.plan({}, 1024) == [] and PK.plan({1: 5000}, 1024)[0][1] >= 1


def test_slots_cover_positions_without_gaps():
    length, first, sequence, offset = PK.slots([((5, 3), 4), ((5, 5), 2), ((3,), 1)])
    assert list(zip(length, first, sequence, offset)) == [(3, 0, 0, 5), (3, 4, 6, 0), (5, 0, 0, 0), (5, 4, 4, 0), (5, 6, 4, 5)]
