"""Exact top-k search: columnar branch-and-bound over blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusflow.llm.common import stored

BLOCK = 8192             # candidates in a block
QUERIES = 2048           # queries in a block
WIDTH = 16               # dimensions added at a time
PILOT = 256              # candidates scored in full for the first threshold

_HITS = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", LongType())])


def quantised(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as a long; null where the vector is null or holds a null or
    non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = vector.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.floor(v * factor).cast("long")))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a table (id, q), the vectors padded to the widest."""
    col = table.column("q").combine_chunks()
    lens = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = np.zeros((len(lens), int(lens.max(initial=0))), dtype=np.int64)
    matrix[np.arange(matrix.shape[1])[None, :] < lens[:, None]] = col.flatten().to_numpy(zero_copy_only=False)
    return table.column("id").to_numpy().astype(np.int64), matrix


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """The k best candidates of a block for each query, as (query position, candidate position, score).

    The components are laid out dimension block by dimension block, the heaviest dimensions first. After each block
    a candidate stays only if its partial product plus the remaining mass, ``|rest of q| * |rest of c|``, can still
    reach the k-th best known score; the survivors are compacted and go on to the next block."""
    d = max(q.shape[1], c.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (q, c))
    out_q, out_c, out_s = [], [], []
    top = max(abs(int(q.min(initial=0))), int(q.max(initial=0))) * max(abs(int(c.min(initial=0))), int(c.max(initial=0))) * max(d, 1)
    if top >= 1 << 52:
        # Beyond exact doubles: whole numbers of any size, kept within a long at the end.
        scores = np.clip(q.astype(object) @ c.astype(object).T, -(1 << 63), (1 << 63) - 1) if d else np.zeros((len(q), len(c)), dtype=object)
        for i in range(len(q)):
            alive = [j for j in range(len(c)) if cid[j] != qid[i]]
            for j in sorted(alive, key=lambda j: (-scores[i, j], cid[j]))[:k]:
                out_q.append(i), out_c.append(j), out_s.append(int(scores[i, j]))
        return np.array(out_q, np.int64), np.array(out_c, np.int64), np.array(out_s, np.int64)
    order = np.argsort(-(c.astype(float) ** 2).sum(axis=0), kind="stable")
    qf, cf = q[:, order].astype(float), c[:, order].astype(float)
    cuts = list(range(0, d, WIDTH)) + [d]
    strips = [np.ascontiguousarray(cf[:, a:b]) for a, b in zip(cuts, cuts[1:])]        # vertical layout
    rest_c = [np.sqrt((cf[:, b:] ** 2).sum(axis=1)) for b in cuts[1:]]
    first = strips[0] @ qf[:, :cuts[1]].T if strips else np.zeros((len(c), len(q)))
    pilot = min(len(c), max(PILOT, 2 * k))
    full = cf[:pilot] @ qf.T if d else np.zeros((pilot, len(q)))
    for i in range(len(q)):
        own = cid != qid[i]
        known = full[:, i][own[:pilot]]
        floor = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        alive, part = np.flatnonzero(own), first[own, i]
        for s in range(len(strips)):
            if s:
                part = part + strips[s][alive] @ qf[i, cuts[s]:cuts[s + 1]]
            left = float(np.sqrt((qf[i, cuts[s + 1]:] ** 2).sum()))
            mass = left * rest_c[s][alive] * (1 + 1e-12) + (1e-3 if left else 0.0)
            if len(alive) > k:
                low = part - mass
                floor = max(floor, np.partition(low, len(low) - k)[len(low) - k])
            stay = part + mass >= floor
            alive, part = alive[stay], part[stay]
        best = np.lexsort((cid[alive], -part))[:k]
        out_q.extend([i] * len(best)), out_c.extend(alive[best]), out_s.extend(part[best])
    return np.array(out_q, np.int64), np.array(out_c, np.int64), np.array(out_s, np.int64)


def _search(k: int):
    def run(key, asks: pa.Table, cands: pa.Table) -> pa.Table:
        qid, q = _matrix(asks)
        cid, c = _matrix(cands)
        out = [(np.zeros(0, np.int64),) * 3]
        if len(cid):
            for at in range(0, len(qid), 256):
                i, j, s = search_block(qid[at:at + 256], q[at:at + 256], cid, c, k)
                out.append((qid[at + i], cid[j], s))
        return pa.table({n: np.concatenate([o[x] for o in out]).astype(np.int64) for x, n in enumerate(("query_id", "vec_id", "score"))})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` selects, the ``k`` rows with the largest
    integer inner product, ties to the smaller id; fewer if there are fewer. A row is no candidate of a query with
    its own id.

    Vectors that are null, or hold null or non-finite components, and rows with a null id take no part. Vectors of
    unequal length are padded with zeros; empty ones score 0. A repeated row is one row: equal (id, vector) pairs
    count once, and an id with several vectors has each of them as query and candidate (the best ``k`` are kept).
    Scores are exact; beyond a long they are kept at its ends.

    The queries, in blocks, meet all rows, in blocks: a grid of (query block, candidate block) cells, dealt by hash, each
    of bounded size. A cell gives at most ``k`` rows a query, and a rank filter prunes them before the shuffle."""
    v = (vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), quantised(F.col(f"`{embedding}`")).alias("q"), is_query.alias("ask"))
         .where("id IS NOT NULL AND q IS NOT NULL").groupBy("id", "q").agg(F.coalesce(F.max("ask"), F.lit(False)).alias("ask")))
    v = stored(v, "topk-vectors")
    n, asked = v.agg(F.count("*"), F.count_if("ask")).first()
    wide, high = max(1, -(-n // BLOCK)), max(1, -(-asked // QUERIES))
    cands = (v.select("id", "q", F.pmod(F.xxhash64("id", "q"), F.lit(wide)).cast("long").alias("c"))
             .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(high - 1).cast("long")))))
    asks = (v.where("ask").select("id", "q", F.pmod(F.xxhash64(F.lit(1), "id", "q"), F.lit(high)).cast("long").alias("a"))
            .withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(wide - 1).cast("long")))))
    hits = asks.groupBy("a", "c").cogroup(cands.groupBy("a", "c")).applyInArrow(_search(k), _HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
