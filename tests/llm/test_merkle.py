"""Merkle manifest against a plain recursive version."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import merkle as MK
from corpusflow.llm.ranks import ranked

DOC = "doc_id long, text string, lang string, source string, n_chars long, path string, _src int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    doc_id, text, lang, source, n = row[:5]
    return h(*[enc(v) for v in (doc_id, source, lang, n, text)])


def tree(nodes):
    """Root, and per node its steps (left, right) to the root."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, pos in enumerate(at):
            run = level[pos // 3 * 3:pos // 3 * 3 + 3]
            paths[i].append((run[:pos % 3], run[pos % 3 + 1:]))
            at[i] = pos // 3
        level = [h(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0], leaf(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, bytes.fromhex(x[1])))]) for s in names}
    root, above = tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        ordered = sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, bytes.fromhex(x[1])))
        for (doc_id, digest), path in zip(ordered, trees[s][1]):
            out.append((doc_id, digest, trees[s][0], root, [x for left, right in path + up for x in left + right]))
    return sorted(out, key=repr)


def rows_of(sizes, seed=1):
    rng, out = random.Random(seed), []
    for s, n in sizes.items():
        for _ in range(n):
            out.append((rng.choice([None, *range(40)]), rng.choice([None, "", "a\nb", "é" * 30, "x" * 5000]), rng.choice([None, "", "en"]), s, rng.choice([None, 0, 7]), "p", 1))
    out += out[:5]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sizes, small", [
    ({"web": 60, "news": 10, None: 4, "": 1, "ä": 2, "z": 27, "b": 28}, MK.SMALL), ({"web": 90, "a": 1}, 0), ({"one": 0, None: 1}, MK.SMALL)])
def test_manifest_equals_brute_force(spark, monkeypatch, sizes, small):
    """Null and empty values, repeated ids and rows, lone leaves, extra columns with names used inside; with ancestors
    sent to all tasks and without."""
    monkeypatch.setattr(MK, "SMALL", small)
    rows = rows_of(sizes)
    got = MK.manifest(spark.createDataFrame(rows, DOC).repartition(5)).select("doc_id", "leaf", "subroot", "root", MK.siblings(F.col("path")).alias("s"))
    assert sorted([(*r[:4], list(r[4])) for r in map(tuple, got.collect())], key=repr) == brute(rows)


def test_tampering_is_found(spark):
    rows = [(i, "one\ntwo" if i % 3 else "plain", "en", f"s{i % 2}", 3, "p", 1) for i in range(50)]
    docs = spark.createDataFrame(rows, DOC)
    out = MK.verify(MK.manifest(docs, {"text": F.replace("text", F.lit("\n"), F.lit(""))})).collect()
    assert len(out) == 50
    for r in out:
        assert r["verified"] == (r["doc_id"] % 3 == 0) == (r["folded_root"] == r["root"])
    assert all(r["verified"] for r in MK.verify(MK.manifest(docs)).collect())


def test_empty_table_and_long_text(spark):
    assert MK.verify(MK.manifest(spark.createDataFrame([], DOC))).collect() == []
    long = [(1, "w " * 2_000_000, None, None, None, None, None)]
    assert MK.manifest(spark.createDataFrame(long, DOC)).first()["root"] == leaf(long[0])


def test_positions_of_a_hot_group_and_of_equal_rows(spark):
    rows = [("hot", i % 7) for i in range(3000)] + [("b", 1)] * 50 + [("c", 5)]
    got = ranked(spark.createDataFrame(rows, "k string, o int"), ["k"], ["o"], "rank", "t").collect()
    for k in ("hot", "b", "c"):
        mine = sorted((r["rank"], r["o"]) for r in got if r["k"] == k)
        assert [r for r, _ in mine] == list(range(len(mine))) and [o for _, o in mine] == sorted(o for _, o in mine)
