"""Merkle dataset manifest: ternary hash trees per source and over the sources, proofs by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.common import stored
from corpusflow.llm.ranks import laid_out, ranked

RUN = 3                          # nodes under one parent
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SMALL = 10_000                   # rows of a table of ancestors that may be sent to all tasks


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hex(digest) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text, so no two rows are spelled alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """Leaf digest of a row, from its fields in the order of ``FIELDS``."""
    return hashed(*[field(columns[c]) for c in FIELDS])


def _above(column: str, levels: int = 1) -> Column:
    """Index of the ancestor some levels up."""
    return F.expr(f"{column} div {RUN ** levels}")


def _levels(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels of a forest. ``leaves(tree, idx, n, digest)`` are the nodes of level 0 of trees with ``n`` of them.
    Level k of the list holds the runs whose parents are on level k + 1: ``tree, idx, n, kids, digest``, those of the
    parent and the digests under it. The second table has the root of each tree: ``tree, level, digest``.

    A run is three rows, so each level is an aggregate over bounded groups, and a third of the size of the one below."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    cur, levels, roots, depth = leaves.select("tree", "idx", "n", "digest"), [], [], 0
    while True:
        roots.append(cur.where("n = 1").select("tree", F.lit(depth).alias("level"), "digest"))
        if most <= 1:
            break
        kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda k: k["digest"])
        runs = cur.where("n > 1").groupBy("tree", _above("idx").alias("up"), "n").agg(kids.alias("kids"))
        digest = F.unhex(hashed(F.array_join(F.transform("kids", _hex), "")))
        runs = stored(runs.select("tree", F.col("up").alias("idx"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), "kids", digest.alias("digest")),
                      f"merkle-{name}-{depth}")
        levels.append(runs)
        cur, most, depth = runs.select("tree", "idx", "n", "digest"), -(-most // RUN), depth + 1
    all_roots = roots[0]
    for r in roots[1:]:
        all_roots = all_roots.unionByName(r)
    return levels, stored(all_roots, f"merkle-{name}-roots")


def _siblings(runs: DataFrame) -> DataFrame:
    """A row per child of each run, ``idx`` its own, with the digests on its left and right."""
    kid = runs.select("tree", F.col("idx").alias("up"), "kids", F.posexplode("kids").alias("pos", "digest"))
    step = F.struct(F.slice("kids", F.lit(1), F.col("pos")).alias("left"),
                    F.slice("kids", F.col("pos") + 2, F.lit(RUN)).alias("right"))
    return kid.select("tree", (F.col("up") * RUN + F.col("pos")).alias("idx"), step.alias("step"))


def _climb(levels: list[DataFrame], tops: DataFrame, leaves: int, name: str) -> DataFrame:
    """Path of every leaf of a forest, ``tree, idx, path``: the steps (left and right digests) up to the root of its
    tree and on along ``tops(tree, level, path)``, what follows above that root.

    Pointer jumping: each node above the leaves first holds the segment to its parent, a root the one of ``tops``. A
    round joins the nodes with themselves: a node takes over the segment of the ancestor that its own segment ends at,
    so all segments reach twice as far. Nodes on levels that no later round ends at are left out. At the end each node
    of level 1 has its whole path, and a leaf puts its own step in front."""
    nodes = tops.select("tree", "level", F.lit(0).cast("long").alias("idx"), "path").where("level > 0")
    for k in range(1, len(levels)):
        nodes = nodes.unionByName(_siblings(levels[k]).select("tree", F.lit(k).alias("level"), "idx", F.array("step").alias("path")))
    nodes, span, part = stored(nodes, f"merkle-{name}-nodes"), 1, 0
    while span < len(levels):
        # Only trees of more than RUN ** span leaves have such ancestors, and each of them covers as many.
        far = nodes.where(F.col("level") > span)
        if leaves // RUN ** span <= SMALL:
            far = F.broadcast(far)
        far = far.select("tree", F.col("level").alias("_l"), F.col("idx").alias("_i"), F.col("path").alias("_more"))
        near = nodes.where((F.col("level") - 1) % (2 * span) == 0)
        near = near.withColumn("_l", F.col("level") + span).withColumn("_i", _above("idx", span))
        path = F.when(F.col("_more").isNull(), F.col("path")).otherwise(F.concat("path", "_more"))
        joined = near.join(far, ["tree", "_l", "_i"], "left").select("tree", "level", "idx", path.alias("path"))
        nodes, span, part = stored(joined, f"merkle-{name}-jump-{part}"), 2 * span, part + 1
    lone = tops.where("level = 0").select("tree", F.lit(0).cast("long").alias("idx"), "path")
    if not levels:
        return lone
    parents = nodes.where("level = 1").select("tree", F.col("idx").alias("_up"), F.col("path").alias("_more"))
    kids = _siblings(levels[0]).withColumn("_up", _above("idx"))
    return kids.join(parents, ["tree", "_up"]).select("tree", "idx", F.concat(F.array("step"), "_more").alias("path")).unionByName(lone)


def folded(start: Column, path) -> Column:
    """Root digest that follows from a leaf digest (hex) and the steps of its path."""
    def up(acc, step):
        return F.sha2(F.concat(F.array_join(F.transform(step["left"], _hex), ""), acc,
                               F.array_join(F.transform(step["right"], _hex), "")).cast("binary"), 256)
    return F.aggregate(path, start, up)


def siblings(path) -> Column:
    """Digests of a proof as hex texts in the order of the levels, from left to right."""
    return F.transform(F.flatten(F.transform(path, lambda s: F.concat(s["left"], s["right"]))), _hex)


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, claim), a row per row of ``docs``, digests as lowercase hex.

    A leaf is the SHA-256 of a row's ``doc_id, source, lang, n_chars, text``. Leaves of a source ascend by doc_id (null
    first, rows of one id by their digest) and every three neighbours, at the end of a level fewer, become one node above
    until one is left: the subroot, for a lone leaf itself. The subroots, by source (null first, then UTF-8 bytes), give
    the root in the same way. ``path`` is the proof of the leaf: per level the digests on its left and right, through the
    subroot to the root. ``claim`` is the leaf digest of the row after ``claimed`` replaced columns by others, for ``verify``.

    Null and empty values are told apart. Repeated rows are leaves of their own. Other columns are not looked at; empty
    input gives an empty result. Texts are read once and never moved, whatever their length: only digests are.

    The largest source is laid out by a range partitioning. A level is an aggregate over runs of three rows, and the
    proofs come by pointer jumping, see ``_climb``: about log2 of the height rounds, at most one table per round. Each
    table is written to the shared folder before the next one."""
    own = {c: F.col(f"`{c}`") for c in FIELDS}
    # A null source sorts before any other, also before the empty one.
    src = F.coalesce(F.concat(F.lit("="), own["source"]), F.lit(""))
    rows = stored(docs.select(own["doc_id"].alias("doc_id"), src.alias("_src"), F.unhex(leaf(own)).alias("digest"),
                              F.unhex(leaf({**own, **(claimed or {})})).alias("claim")), "merkle-leaves")
    rows, pieces = laid_out(rows, ["_src"], ["doc_id", "digest"], "merkle-ordered")
    pieces = stored(pieces, "merkle-pieces")
    sources = stored(ranked(pieces.groupBy("_src").agg(F.sum("_count").alias("n")), [], ["_src"], "tree", "merkle-sources"), "merkle-trees")
    total, trees = sources.agg(F.sum("n"), F.count("*")).first()
    pieces = pieces.join(sources, "_src")
    leaves = stored(rows.join(pieces, ["_src", "_p"]).select(
        "tree", (F.col("_at") + F.col("_shift")).alias("idx"), "n", "_p", "doc_id", "digest", "claim"), "merkle-level-0")
    levels, roots = _levels(leaves, "sources")
    upper, top = _levels(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).alias("n"), "digest"), "root")
    none = F.array().cast("array<struct<left:array<binary>,right:array<binary>>>")
    above = _climb(upper, top.select("tree", "level", none.alias("path")), trees, "root").select(F.col("idx").alias("tree"), "path")
    tops = stored(roots.join(above, "tree"), "merkle-tops")
    path = _climb(levels, tops.select("tree", "level", "path"), total or 0, "sources")
    root = top.first()
    # What all leaves of a source share is joined per piece of a source, never a whole source in one task.
    sub = pieces.select("tree", "_p").join(roots.select("tree", _hex("digest").alias("subroot")), "tree")
    out = leaves.join(path, ["tree", "idx"]).join(sub, ["tree", "_p"])
    return out.select("doc_id", _hex("digest").alias("leaf"), "subroot", F.lit(root["digest"].hex() if root else "").alias("root"), "path", _hex("claim").alias("claim"))


def verify(proofs: DataFrame) -> DataFrame:
    """``proofs`` (of ``manifest``) with the root that follows from each claim and whether it is the manifest's."""
    return proofs.withColumn("folded_root", folded(F.col("claim"), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
