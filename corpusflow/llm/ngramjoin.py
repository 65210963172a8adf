"""N-gram Jaccard join: count vectors of token groups in an R-tree, bounded by sums of coordinate minima."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from corpusflow.llm.common import append, batch_bytes, components, discard, mix, release, stored, without, word_hashes

NGRAM, NUM, DEN = 3, 90, 100      # words of a shingle; links from NUM * union <= DEN * intersection on
DIMS = 64                         # groups of a count vector
LEAF = 32                         # points of a leaf of the tree
BLOCK_SHINGLES = 1 << 21          # shingles of one block of a candidate class
BUCKETS, BUCKET_BLOCK = 1 << 23, 1 << 12      # counters of the frequency table, and those of one of its rows
TASKS = 64                        # tables of tasks that are added up first
STEPS = 12                        # steps of a weight in a doubling of the frequency
SEEN = 1 << 16                    # sets a task remembers
PART_FROM, SPARE = 6, 8           # elements of a part from which on parts make keys; one spare part for so many
CELL_SETS, CELL_BYTES = 2048, 1 << 22         # sketches of a block of the sets that share a key, and their bytes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOPS = [1]                       # largest size of each level, a quarter more than that of the one before
while _TOPS[-1] < 1 << 62:
    _TOPS.append(max(_TOPS[-1] + 1, _TOPS[-1] * 5 // 4))


def shingles(text, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text; a shorter text is one shingle, an empty one has none."""
    w = word_hashes(text)
    if not len(w):
        return w
    m = min(n, len(w))
    h = np.full(len(w) - m + 1, m, dtype=np.uint64)
    for i in range(m):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - m + 1 + i])
    return np.unique(h)


def changed(size: int, num: int = NUM, den: int = DEN) -> int:
    """Most elements that differ between a set of ``size`` and a larger partner: of a union of at most
    size * den / num elements the part that may differ, a tenth of size / 0.9 at 90 / 100."""
    return size * (den - num) // num


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BUCKETS)).astype(np.int64)


def keys(h: np.ndarray, num: int = NUM, den: int = DEN, weight: np.ndarray | None = None) -> np.ndarray:
    """Keys of a set, one of which every linked pair of sets shares: of parts of the set (``part_keys``) where a part
    holds ``PART_FROM`` elements or more, else of single elements (``element_keys``)."""
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    return (part_keys if num >= PART_FROM * (den - num) else element_keys)(h, num, den, weight)


def part_keys(h: np.ndarray, num: int, den: int, weight: np.ndarray | None) -> np.ndarray:
    """Keys of a set from parts of it: a part is one key with all its elements, so texts that have a passage in common
    share none, unless it fills whole parts.

    A linked pair whose smaller set is at most ``_TOPS[level]`` large differs in at most k elements (``changed``). With the
    elements dealt by hash into k + 1 + spare parts, spare + 1 parts at least are equal. In one order of parts by
    their contents, the same for all sets, the first of these is among the first k + 1 parts of either set: the ``spare``
    last ones, which are empty, small or hold what many texts share, need no key. A set has keys for each level that the
    smaller set of its pairs can have, mostly one or two."""
    n, out = len(h), []
    w = np.zeros(n, dtype=np.uint8) if weight is None else weight[_bucket(h)]
    own = mix(h)
    for level in range(bisect_left(_TOPS, -(-n * num // den)), bisect_left(_TOPS, n) + 1):
        k = changed(_TOPS[level], num, den)
        m, salt = k + 1 + k // SPARE, mix(np.array([level + 29], dtype=np.uint64))
        part = (mix(h ^ salt) % np.uint64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        at = np.flatnonzero(np.diff(part[order], prepend=-1))
        ids, count = part[order[at]], np.diff(at, append=n)
        content = np.add.reduceat(own[order], at, dtype=np.uint64)
        best = np.lexsort((ids, content, -count, np.minimum.reduceat(w[order], at)))[:k + 1]
        ids, content = ids[best], content[best]
        if len(ids) <= k:                                     # empty parts come last
            empty = np.setdiff1d(np.arange(m), ids)[:k + 1 - len(ids)]
            ids, content = np.append(ids, empty), np.append(content, np.zeros(len(empty), dtype=np.uint64))
        out.append(mix(content ^ mix(ids.astype(np.uint64) * _ODD + salt)))
    return np.unique(np.concatenate(out)).view(np.int64)


def element_keys(h: np.ndarray, num: int, den: int, weight: np.ndarray | None) -> np.ndarray:
    """Keys of a set from single elements.

    A linked pair of sets has at least ceil(size * num / den) elements in common, whichever size is meant. So among the
    first size - ceil(size * num / den) + 1 elements of each set, in an order that is the same for all sets, one is in both
    (prefix filter). The order is by ``weight`` of the element's bucket, then by the element itself: any order is right,
    and the one by rising frequency leaves what many texts share to the end, where it is no key of a text that has
    enough of its own. The second part of a key is a size level (powers of four) that the pair's smaller set can have."""
    n = len(h)
    common = -(-n * num // den)
    first = h if weight is None else h[np.lexsort((h, weight[_bucket(h)]))]
    first = mix(first[:n - common + 1])
    levels = mix(np.arange((common.bit_length() + 1) // 2, (n.bit_length() + 1) // 2 + 1, dtype=np.uint64) + np.uint64(17))
    return np.unique(mix(first[None, :] ^ levels[:, None])).view(np.int64)


_COUNTS = "block int, at binary, n binary"


def frequency_weights(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """How often the elements of each of ``BUCKETS`` hash buckets occur in the sets of all texts, as logarithms in steps of
    ``STEPS`` a doubling: one byte a bucket, whatever the size of the corpus. Tasks count in a table of their own and
    pass on what isn't zero; the sums are made in two rounds, ``TASKS`` tables first, each table row as a stream."""
    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.uint32)
        for batch in batches:
            for b in batch_bytes(batch, text):
                np.add.at(total, _bucket(shingles(b, words)), 1)
        yield from rows(range(BUCKETS // BUCKET_BLOCK), total.reshape(-1, BUCKET_BLOCK))

    def rows(blocks, tables):
        out = []
        for block, table in zip(blocks, tables):
            at = np.flatnonzero(table)
            if len(at):
                n = table[at].astype("<i8")
                out.append((block, at.astype("<u2").tobytes(), (n.astype("<u1") if n.max() < 256 else n).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))], names=["block", "at", "n"])

    def numbers(at, n):
        # Counts below 256 take a byte each.
        return np.frombuffer(n, "<u1" if 2 * len(n) == len(at) else "<i8").astype(np.int64)

    def tables(batches):
        block, table = None, None
        for batch in batches:
            for k, at, n in zip(*[c.to_pylist() for c in batch.columns]):
                if k != block:
                    if block is not None:
                        yield block, table
                    block, table = k, np.zeros(BUCKET_BLOCK, dtype=np.int64)
                table[np.frombuffer(at, "<u2")] += numbers(at, n)
        if block is not None:
            yield block, table

    def add(batches):
        for block, table in tables(batches):
            yield from rows([block], [table])

    def weigh(batches):
        # Only a byte a bucket comes to the driver.
        for block, table in tables(batches):
            w = np.minimum(np.log2(1.0 + table) * STEPS, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([w.tobytes()], pa.binary())], names=["block", "weight"])

    parts = docs.mapInArrow(count, _COUNTS).withColumn("_salt", F.floor(F.spark_partition_id() / TASKS))
    parts = parts.repartition("block", "_salt").sortWithinPartitions("_salt", "block").select("block", "at", "n").mapInArrow(add, _COUNTS)
    sums = parts.repartition("block").sortWithinPartitions("block").mapInArrow(weigh, "block int, weight binary")
    total = np.zeros((BUCKETS // BUCKET_BLOCK, BUCKET_BLOCK), dtype=np.uint8)
    for r in sums.collect():
        total[r["block"]] = np.frombuffer(r["weight"], np.uint8)
    return total.ravel()


def fingerprint(h: np.ndarray) -> bytes:
    """128 bits of a set, the same for equal sets only."""
    a = np.add.reduce(mix(h), dtype=np.uint64)
    b = np.add.reduce(mix(h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(h))), dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def sketch(h: np.ndarray) -> bytes:
    """Parities of the numbers of elements in groups by hash, a power of two of them from three quarters of the set's size
    on: two sets differ in at least as many elements as their parities do. Halves laid on each other (``folded``) are
    the sketch of half as many groups."""
    groups = 64
    while 4 * groups < 3 * len(h):
        groups *= 2
    odd = np.bincount((h & np.uint64(groups - 1)).astype(np.int64), minlength=groups) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches (64 groups a number) as sketches of ``width`` numbers."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_link(a: np.ndarray, b: np.ndarray, size_a, size_b, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Which rows of two tables of sketches (one of which can have a single row) can be of linked sets, which differ in
    (den - num) / (den + num) of their sizes' sum at most."""
    width = min(a.shape[1], b.shape[1])
    apart = np.bitwise_count(folded(a, width) ^ folded(b, width)).sum(axis=1, dtype=np.int64)
    return (apart * (den + num) <= (size_a + size_b) * (den - num)) & (size_a * den >= size_b * num) & (size_b * den >= size_a * num)


_SIG = [StructField("n_shingles", LongType()), StructField("_fp", BinaryType()), StructField("_r", LongType()), StructField("_keys", ArrayType(LongType())),
        StructField("_sketch", BinaryType())]


def _signatures(text: str, words: int, num: int, den: int, weight: np.ndarray):
    seen: set[bytes] = set()

    def run(batch: pa.RecordBatch):
        n, fp, short, ks, sk = [], [], [], [], []
        for b in batch_bytes(batch, text):
            h = shingles(b, words)
            f = fingerprint(h) if len(h) else None
            # A copy of a set whose keys this task has given needs none.
            again = f is None or f in seen
            n.append(len(h)), fp.append(f), short.append(int.from_bytes(f[:8], "big", signed=True) if f else None)
            ks.append(np.zeros(0, dtype=np.int64) if again else keys(h, num, den, weight))
            sk.append(None if again else sketch(h))
            if not again:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(f)
        return [pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(short, pa.int64()), pa.array(ks, pa.list_(pa.int64())), pa.array(sk, pa.binary())]
    return run


_NEAR = StructType([StructField("u", LongType()), StructField("v", LongType()), StructField("near", BooleanType())])
_TIES = StructType(_NEAR.fields[:2])


def _widths(sketches: list[bytes]) -> dict[int, np.ndarray]:
    """Places of the sketches of each width."""
    width = np.array([len(x) // 8 for x in sketches])
    return {int(w): np.flatnonzero(width == w) for w in np.unique(width)}


def _rows(sketches: list[bytes], at: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(sketches[i] for i in at.tolist()), "<u8").reshape(len(at), -1)


def _near_batches(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b"))
            n, m = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("n", "m"))
            near = np.zeros(len(a), dtype=bool)
            others = _widths(b)
            for x in _widths(a).values():
                for y in others.values():
                    at = np.intersect1d(x, y, assume_unique=True)
                    for part in np.array_split(at, 1 + len(at) // CELL_SETS):
                        if len(part):
                            near[part] = may_link(_rows(a, part), _rows(b, part), n[part], m[part], num, den)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("u")), batch.column(batch.schema.get_field_index("v")), pa.array(near)], names=_NEAR.names)
    return run


def ties_in_cell(rows: list[tuple], num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """Ties between the sets of a cell, rows (block, r, loose, n, sketch), that make the same connected classes as all pairs
    whose sketches can be of linked sets. Sets that are not loose are tied already; in a cell of two blocks only pairs
    across them are looked at."""
    block, ids, loose, sizes = (np.array([x[c] for x in rows]) for c in range(4))
    cross, sketches = len(np.unique(block)) > 1, [x[4] for x in rows]
    tables = {w: (at, _rows(sketches, at)) for w, at in _widths(sketches).items()}
    root = np.where(loose, np.arange(len(rows)), -1)
    cache: dict[tuple[int, int], np.ndarray] = {}
    out = []
    for i in np.flatnonzero(loose).tolist():
        own = np.frombuffer(sketches[i], "<u8")[None, :]
        for w, (at, table) in tables.items():
            ask = (root[at] != root[i]) & (~loose[at] | (at > i)) & (sizes[at] * den >= sizes[i] * num) & (sizes[i] * den >= sizes[at] * num)
            if cross:
                ask &= block[at] != block[i]
            if not ask.any():
                continue
            width = min(w, own.shape[1])
            if (w, width) not in cache:
                cache[w, width] = folded(table, width)
            at = at[ask]
            for j in at[may_link(cache[w, width][ask], own, sizes[at], sizes[i], num, den)].tolist():
                if root[j] != root[i]:
                    out.append((int(ids[i]), int(ids[j])))
                    root[root == root[j]] = root[i]
    return out


def _tie_batches(num: int, den: int):
    """Cells, one after the other, to ties."""
    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], names=_TIES.names)

    def run(batches):
        cell, rows = None, []
        for batch in batches:
            out = []
            for k, a, b, *x in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_key", "_a", "_b", "_block", "_r", "loose", "n_shingles", "_sketch"))):
                if (k, a, b) != cell:
                    out += ties_in_cell(rows, num, den) if rows else []
                    cell, rows = (k, a, b), []
                rows.append(tuple(x))
            yield batch_of(out)
        if rows:
            yield batch_of(ties_in_cell(rows, num, den))
    return run


def candidate_ties(sig: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v) of sets that share a key and whose sketches can be of linked sets, enough of them that every linked pair is
    connected by them.

    The sets of a key are compared with the smallest of it. What is loose, as its sketch is too far from the smallest's, is
    compared with the key's others, in cells of two blocks of about ``CELL_SETS`` sets; of keys with the same sets one is
    looked at. This grows with the loose ones times the sets of a key, of sketches of about an eighth of a byte an element."""
    spark = sig.sparkSession
    pairs = sig.select("_r", F.explode("_keys").alias("_key"))
    hub = pairs.groupBy("_key").agg(F.min("_r").alias("u"), F.max("_r").alias("_last")).where("u <> _last")
    met = stored(pairs.join(hub, "_key").where("_r <> u"), "ngram-met")
    release(spark)
    sets = met.select("_r").unionByName(met.select(F.col("u").alias("_r"))).distinct()
    sets = stored(sig.where("_sketch IS NOT NULL").select("_r", "n_shingles", "_sketch").join(sets, "_r", "left_semi").distinct(), "ngram-sketches")
    side = lambda r, n, s: sets.select(F.col("_r").alias(r), F.col("n_shingles").alias(n), F.col("_sketch").alias(s))
    asked = met.select("u", F.col("_r").alias("v")).distinct().join(side("u", "n", "a"), "u").join(side("v", "m", "b"), "v")
    asked = stored(asked.mapInArrow(_near_batches(num, den), _NEAR).groupBy("u", "v").agg(F.max("near").alias("near")), "ngram-asked")
    # A key of two sets has nothing left to compare: of more, some are neither the smallest nor the largest.
    between = met.where("_r <> _last")
    rest = between.select("_key", "u", "_r").unionByName(between.select("_key", "u", F.col("_last").alias("_r"))).distinct()
    far = asked.where("NOT near").select("u", F.col("v").alias("_r"), F.lit(True).alias("loose"))
    rest = stored(rest.join(far, ["u", "_r"], "left").select("_key", "_r", F.coalesce("loose", F.lit(False)).alias("loose")), "ngram-rest")
    discard(met)
    same = rest.groupBy("_key").agg(F.bit_xor(F.xxhash64("_r", "loose")).alias("x"), F.bit_xor(F.xxhash64("loose", "_r")).alias("y"), F.count("*").alias("n"), F.count_if("loose").alias("l"))
    once = same.where("n > 1 AND l > 0").groupBy("x", "y", "n", "l").agg(F.min("_key").alias("_key")).select("_key")
    rows = stored(rest.join(once, "_key", "left_semi").join(sets, "_r"), "ngram-cells")
    blocks = rows.groupBy("_key").agg(F.ceil(F.greatest(F.count("*") / CELL_SETS, F.sum(F.octet_length("_sketch")) / CELL_BYTES)).alias("_blocks"))
    cells = (rows.join(blocks, "_key").withColumn("_block", F.pmod(F.xxhash64("_r"), F.col("_blocks")))
             .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
             .withColumn("_a", F.least("_block", "_o")).withColumn("_b", F.greatest("_block", "_o")).drop("_o", "_blocks"))
    # So many tasks, though the rows are few: their work grows with the square of a cell.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cells.repartition(tasks, "_key", "_a", "_b").sortWithinPartitions("_key", "_a", "_b").mapInArrow(_tie_batches(num, den), _TIES)
    ties = stored(asked.where("near").select("u", "v").unionByName(found), "ngram-ties")
    for table in (rest, rows, asked, sets):
        discard(table)
    return ties


class RTree:
    """Points in boxes: leaves of at most ``LEAF`` points, packed by sort-tile-recursive order, and levels of boxes of
    boxes. A box holds the largest count per coordinate and the smallest and largest set size below."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = self._tile(np.arange(len(points)), np.argsort(-points.var(axis=0), kind="stable") if len(points) else np.zeros(0, int), 0)
        starts = np.arange(0, len(points), LEAF)
        p, s = points[self.order], sizes[self.order]
        self.levels = [(np.maximum.reduceat(p, starts, axis=0), np.minimum.reduceat(s, starts), np.maximum.reduceat(s, starts))] if len(points) else []
        while self.levels and len(self.levels[-1][1]) > LEAF:
            m, lo, hi = self.levels[-1]
            at = np.arange(0, len(lo), LEAF)
            self.levels.append((np.maximum.reduceat(m, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)))

    def _tile(self, idx: np.ndarray, axes: np.ndarray, depth: int) -> np.ndarray:
        if len(idx) <= LEAF or depth > 40:
            return idx
        idx = idx[np.argsort(self.sizes[idx] if not depth else self.points[idx, axes[(depth - 1) % len(axes)]], kind="stable")]
        half = -(-len(idx) // 2 // LEAF) * LEAF
        return np.concatenate([self._tile(idx[:half], axes, depth + 1), self._tile(idx[half:], axes, depth + 1)])

    def reach(self, q: np.ndarray, size: int, num: int = NUM, den: int = DEN) -> np.ndarray:
        """Points that may link with ``q``: boxes, then points, whose summed coordinate minima with q reach the overlap
        that a link needs."""
        if not self.levels:
            return np.zeros(0, dtype=np.int64)
        alive = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            m, lo, hi = self.levels[depth]
            bound = np.minimum(m[alive], q).sum(axis=1)
            alive = alive[(bound * (num + den) >= num * (size + lo[alive])) & (lo[alive] * num <= size * den) & (hi[alive] * den >= size * num)]
            below = len(self.points) if depth == 0 else len(self.levels[depth - 1][1])
            alive = (alive[:, None] * LEAF + np.arange(LEAF)[None, :]).ravel()
            alive = alive[alive < below]
        at = self.order[alive]
        return at[np.minimum(self.points[at], q).sum(axis=1) * (num + den) >= num * (size + self.sizes[at])]


def join_sets(sets: list[np.ndarray], block: np.ndarray, other: int | None, num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """Links between sets that make the same connected classes as all of their links: pairs already connected need no
    test. ``block`` names each set's block; with ``other`` only pairs across blocks are tested, else all.

    Each set probes the tree; surviving points of other classes are verified by counting their elements in the probe."""
    n = len(sets)
    sizes = np.array([len(h) for h in sets], dtype=np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    vocab, ids = np.unique(flat, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(sizes)])
    points = np.zeros((n, DIMS), dtype=np.int64)
    for i, h in enumerate(sets):
        points[i] = np.bincount((h % np.uint64(DIMS)).astype(np.int64), minlength=DIMS)
    tree = RTree(points, sizes)
    root = np.arange(n)
    mark = np.zeros(len(vocab), dtype=bool)
    links = []
    for i in range(n):
        near = tree.reach(points[i], int(sizes[i]), num, den)
        near = near[(near > i) & (root[near] != root[i])]
        if other is not None:
            near = near[block[near] != block[i]]
        if not len(near):
            continue
        mark[ids[start[i]:start[i + 1]]] = True
        near = np.sort(near)
        lens = sizes[near]
        pick = np.repeat(start[near] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        inter = np.add.reduceat(mark[ids[pick]].astype(np.int64), np.concatenate([[0], np.cumsum(lens)[:-1]]))
        mark[ids[start[i]:start[i + 1]]] = False
        for j in near[inter * den >= num * (sizes[i] + lens - inter)]:
            if root[j] != root[i]:
                links.append((i, int(j)))
                root[root == root[j]] = root[i]
    return links


_LINKS = StructType([StructField("u", BinaryType()), StructField("v", BinaryType())])


def _join_cell(words: int, num: int, den: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, b = key[1].as_py(), key[2].as_py()
        fp = table.column("_fp").to_pylist()
        sets = [shingles(x, words) for batch in table.to_batches() for x in batch_bytes(batch, "_text")]
        block = table.column("_block").to_numpy()
        links = join_sets(sets, block, b if a != b else None, num, den)
        return pa.table({"u": pa.array([fp[i] for i, _ in links], pa.binary()), "v": pa.array([fp[j] for _, j in links], pa.binary())})
    return run


BANDS = 1 << 32                   # numbers of blocks that a band may have


def size_band(size: str, num: int = NUM, den: int = DEN):
    """Band of a set by its size: linked sets, of which the smaller has at least num / den of the larger's elements, are in
    one band or in two neighbours (the width is a little over that ratio, for rounding)."""
    return F.floor(F.log(F.col(size).cast("double")) / max(float(np.log(den / num)) * (1 + 1e-9), 1e-12))


def with_neighbours(band: DataFrame) -> DataFrame:
    """(root, _band, _blocks) with the blocks that a block of the band is compared with: those of its own and of the
    neighbour bands. A class has as many bands as its sizes span, not as it has members."""
    row = Window.partitionBy("root").orderBy("_band")
    near = [F.when(f("_band").over(row) == F.col("_band") + d, f("_blocks").over(row)).otherwise(0) for f, d in ((F.lag, -1), (F.lead, 1))]
    out = band.select("*", near[0].alias("_below"), near[1].alias("_above"))
    part = lambda n, d: f"IF({n} > 0, transform(sequence(0L, {n} - 1), x -> (_band + {d}) * {BANDS}L + x), array())"
    return out.withColumn("_cells", F.expr(f"concat({part('_below', -1)}, {part('_blocks', 0)}, {part('_above', 1)})")).drop("_below", "_above")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = NGRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_fp, class_fp), a row a document: the size of its set, the smallest doc_id
    reachable over links, and fingerprints of its set and of its class (null for an empty set).

    A document's set holds the hashes of its distinct shingles of ``words`` words (64 bits); sets link from a Jaccard
    similarity of ``num`` / ``den`` on. Null, empty and blank texts have an
    empty set and are linked with nothing, so component_id is their own id. Rows with equal sets are one class without
    any comparison. A null id is never the smallest; a class of null ids only has null. Rows that share an id but not
    the text are separate nodes. Other columns are not looked at. Empty input: empty result.

    1. A first pass counts how often elements occur (``frequency_weights``). A second one gives the size, a fingerprint and
       the keys of each text's set (see ``keys``); texts are not moved.
    2. Equal sets become one row. Sets that share a key are candidates if their sketches can be of linked sets
       (``candidate_ties``): the connected classes of these ties hold every linked pair, and texts that have no more than a
       passage in common are not tied by it. A key is one sum and one join, however many share it.
    3. Only sets in a candidate class of two or more are fetched, each once, and compared within its class: blocks of
       about ``BLOCK_SHINGLES`` elements and of sizes that can link, each block and each pair of such blocks in a task.
       A cell builds the R-tree, probes it and verifies.
    4. The connected classes of the found links are the result."""
    d = F.col(f"`{doc_id}`")
    narrow = docs.select(d.alias("_id"), F.col(f"`{text}`").alias("_text"))
    spark = docs.sparkSession
    weight = frequency_weights(narrow.select("_text"), "_text", words)
    release(spark)
    sig = stored(without(append(narrow, _SIG, _signatures("_text", words, num, den, weight)), ["_text"]), "ngram-signatures")
    same = sig.where("n_shingles > 0").groupBy("_fp", "_id").agg(F.count("*").alias("_c"), F.max("n_shingles").alias("_n"), F.max("_r").alias("_r"))
    reps = stored(same.groupBy("_fp").agg(F.min("_id").alias("_min"), F.max("_n").alias("_n"), F.max("_r").alias("_r"), (F.max("_c") > 1).alias("_repeated")), "ngram-sets")
    release(spark)
    # Candidates are tied by half of the fingerprint: two sets that share it are at worst compared in vain.
    ties = candidate_ties(sig, num, den)
    keyed, sig = sig, stored(sig.select("_id", "n_shingles", "_fp"), "ngram-rows")
    discard(keyed)                                            # the keys are many times as large as the rest
    cand = components(ties, "ngram-candidates").withColumnRenamed("node", "_r")
    release(spark)
    # A class of one block is one cell. A larger one is cut into bands of sizes, so wide that linked sets are at most one
    # band apart, and each band into blocks.
    cand = cand.join(reps, "_r")
    big = cand.groupBy("root").agg(F.sum("_n").alias("_all"), F.count("*").alias("_members")).where("_members > 1").drop("_members")
    cand = cand.join(big, "root").withColumn("_band", F.when(F.col("_all") > BLOCK_SHINGLES, size_band("_n", num, den)).otherwise(0))
    band = cand.groupBy("root", "_band").agg(F.ceil(F.sum("_n") / BLOCK_SHINGLES).alias("_blocks"))
    cand = cand.join(with_neighbours(band), ["root", "_band"]).withColumn("_block", F.col("_band") * BANDS + F.pmod(F.xxhash64("_fp"), F.col("_blocks")))
    cand = stored(cand.select(F.col("_fp").alias("node"), "root", "_min", "_block", "_cells", "_repeated"), "ngram-members")
    # The texts of the members, found by id and told apart by fingerprint.
    texts = narrow.join(cand.select("_min").distinct(), narrow["_id"].eqNullSafe(cand["_min"]), "left_semi")

    def fps(batch: pa.RecordBatch):
        hs = [shingles(b, words) for b in batch_bytes(batch, "_text")]
        return [pa.array([fingerprint(h) if len(h) else None for h in hs], pa.binary())]

    # Texts move, not sets: a text takes about a third of the bytes of its hashes, and a cell makes them again.
    found = append(texts, [StructField("_fp", BinaryType())], fps)
    members = (found.join(cand, (found["_fp"] == cand["node"]) & found["_id"].eqNullSafe(cand["_min"]))
               .select("root", "_fp", "_text", "_block", "_cells", "_repeated"))
    # Only of a row that occurs twice a text comes twice.
    members = members.where("NOT _repeated").unionByName(members.where("_repeated").dropDuplicates(["root", "_fp"]))
    cells = (members.withColumn("_o", F.explode("_cells"))
             .select("root", F.least("_block", "_o").alias("_a"), F.greatest("_block", "_o").alias("_b"), "_fp", "_text", "_block"))
    links = cells.groupBy("root", "_a", "_b").applyInArrow(_join_cell(words, num, den), _LINKS)
    linked = components(links, "ngram-links")
    release(spark)
    lowest = linked.join(reps.select(F.col("_fp").alias("node"), "_min"), "node").groupBy("root").agg(F.min("_min").alias("_low"))
    linked = linked.join(lowest, "root").select(F.col("node").alias("_nfp"), "root", "_low")
    of_set = reps.select("_fp", "_min").join(linked, F.col("_fp") == F.col("_nfp"), "left").select(
        F.col("_fp").alias("_sfp"), F.coalesce("_low", "_min").alias("_c"), F.coalesce("root", "_fp").alias("class_fp"))
    out = sig.select("_id", "n_shingles", "_fp").join(of_set, F.col("_fp") == F.col("_sfp"), "left")
    return out.select(F.col("_id").alias(doc_id), "n_shingles", F.when(F.col("_fp").isNull(), F.col("_id")).otherwise(F.col("_c")).alias("component_id"),
                      F.col("_fp").alias("set_fp"), "class_fp")


_PLACE = [StructField("_fp", BinaryType()), StructField("_salt", LongType())]


def _first_rows(text: str, doc_id: str, words: int):
    """Rows with the fingerprints of their sets, without those whose id and set this task has passed on; rows with an empty
    set all stay, numbered."""
    def run(batches):
        seen, empty = set(), 0
        for batch in batches:
            fp, salt, stay = [], [], []
            for i, (b, d) in enumerate(zip(batch_bytes(batch, text), batch.column(batch.schema.get_field_index(doc_id)).to_pylist())):
                h = shingles(b, words)
                f = fingerprint(h) if len(h) else None
                if f is None:
                    empty += 1
                elif (f, repr(d)) in seen:
                    continue
                else:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add((f, repr(d)))
                fp.append(f), salt.append(0 if f else empty % (1 << 20)), stay.append(i)
            rows = batch if len(stay) == batch.num_rows else batch.take(pa.array(stay, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(fp, pa.binary()), pa.array(salt, pa.int64())], names=[*batch.schema.names, *(f.name for f in _PLACE)])
    return run


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = NGRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest id (null last), of equal ids
    that with the smallest fingerprint, of rows equal in both any one. Documents with an empty set all stay. The
    columns are those of ``docs``."""
    c = classes(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), words=words, num=num, den=den).where("set_fp IS NOT NULL")
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("i"), F.col("set_fp").alias("f"))).alias("p")
    rows = c.groupBy("set_fp", "doc_id", "class_fp").agg(F.count("*").alias("_kn"))
    best = rows.groupBy("class_fp").agg(pick).select("p.i", "p.f")
    keep = stored(best.join(rows, (best["f"] == rows["set_fp"]) & best["i"].eqNullSafe(rows["doc_id"])).select(F.col("i").alias("_ki"), F.col("f").alias("_kf"), "_kn"), "ngram-kept")

    # The rows move once, to their class's choice, so of equal ones the first is picked there: few, as a task passes a row's
    # equals on once only. Rows with an empty set go to many places.
    marked = docs.mapInArrow(_first_rows(text, doc_id, words), StructType([*docs.schema.fields, *_PLACE]))
    marked = marked.withColumn("_k", F.struct(F.col("_fp").alias("f"), F.col(f"`{doc_id}`").alias("i"), F.col("_salt").alias("s")))
    keep = keep.select(F.struct(F.col("_kf").alias("f"), F.col("_ki").alias("i"), F.lit(0).cast("long").alias("s")).alias("_kk"), "_kn")
    release(docs.sparkSession)
    out = marked.join(keep, F.col("_k") == F.col("_kk"), "left").where("_fp IS NULL OR _kn IS NOT NULL")
    out = out.withColumn("_row", F.row_number().over(Window.partitionBy("_k").orderBy("_k"))).where("_fp IS NULL OR _row = 1")
    return out.select([F.col(f"`{c}`") for c in docs.columns])
