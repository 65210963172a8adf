"""LM scoring: a smoothed bigram model in Elias-Fano tries, built and asked shard by shard."""

from __future__ import annotations

import json
import mmap
import zlib

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from corpusflow.llm.common import batch_bytes, mix, stored, word_hashes

CHUNK_TOKENS = 2_000_000     # tokens whose words and pairs a task sums up before it sends them
SHARD_BYTES = 16 << 20       # text for which there is one shard of the model
TRUST, TRUST_AT = 0.3, 10.0  # weight of a context's own counts: TRUST * c / (c + TRUST_AT)
END = np.uint64(0xE0D0_5E17_7E4C_E001)   # stands for the end of a text among the word hashes
RATIO_STEP, GAIN_STEP = 1 / 14, 1 / 4096


# ---- packed columns ----

def pack(a: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed; planes that are all zero are left out."""
    b = np.ascontiguousarray(a, dtype="<u8").view(np.uint8).reshape(-1, 8)
    n = 8 if not len(b) else max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    return bytes([n]) + zs.ZstdCompressor(level=1).compress(np.ascontiguousarray(b[:, :n].T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    n = data[0]
    raw = np.frombuffer(zs.ZstdDecompressor().decompress(data[1:], max_output_size=0) if len(data) > 1 else b"", dtype=np.uint8)
    out = np.zeros((len(raw) // n, 8), dtype=np.uint8)
    out[:, :n] = raw.reshape(n, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


# ---- Elias-Fano ----

class EliasFano:
    """Monotone sequence of whole numbers: the low bits in an array, the high bits in unary, with sampled counts of
    ones. ``find`` is a successor search in one bucket of equal high bits."""

    def __init__(self, head: dict, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.l, self.top = head["n"], head["l"], head["top"]
        self.low, self.high, self.ones = low, high, ones
        self.zeros = (np.arange(len(ones), dtype=np.int64) * 512 - ones.astype(np.int64))

    @staticmethod
    def build(v: np.ndarray):
        """(head, low, high, ones) of a sorted array."""
        n = len(v)
        top = int(v[-1]) if n else 0
        l = max(0, int(np.floor(np.log2(max(1, top + 1) / max(1, n))))) if n else 0
        low = np.zeros(n * l // 64 + 2, dtype=np.uint64)
        if l and n:
            part = v & np.uint64((1 << l) - 1)
            off = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, sh = (off >> np.uint64(6)).astype(np.int64), off & np.uint64(63)
            np.bitwise_or.at(low, word, part << sh)
            over = (sh + np.uint64(l)) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - sh[over]))
        pos = (v >> np.uint64(l)) + np.arange(n, dtype=np.uint64)
        words = -(-(n + (top >> l) + 2) // 512) * 8
        high = np.zeros(words, dtype=np.uint64)
        np.bitwise_or.at(high, (pos >> np.uint64(6)).astype(np.int64), np.uint64(1) << (pos & np.uint64(63)))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).reshape(-1, 8).sum(axis=1, dtype=np.int64))]).astype(np.uint64)
        return {"n": n, "l": l, "top": top}, low, high, ones

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Positions of the k-th one or zero, counted from 0."""
        before = self.ones.astype(np.int64) if ones else self.zeros
        block = np.searchsorted(before, k, side="right") - 1
        left = k - before[block]
        word = block * 8
        open_ = np.ones(len(k), dtype=bool)
        for _ in range(8):
            w = self.high[np.minimum(word, len(self.high) - 1)]
            c = np.bitwise_count(w if ones else ~w).astype(np.int64)
            open_ = open_ & (left >= c)
            left = np.where(open_, left - c, left)
            word = word + open_
        w = self.high[np.minimum(word, len(self.high) - 1)]
        w = w if ones else ~w
        at = np.zeros(len(k), dtype=np.int64)
        for size in (32, 16, 8, 4, 2, 1):
            half = np.bitwise_count((w >> at.astype(np.uint64)) & np.uint64((1 << size) - 1)).astype(np.int64)
            skip = left >= half
            left = np.where(skip, left - half, left)
            at = np.where(skip, at + size, at)
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), dtype=np.uint64)
        off = i.astype(np.uint64) * np.uint64(self.l)
        word, sh = (off >> np.uint64(6)).astype(np.int64), off & np.uint64(63)
        v = self.low[word] >> sh
        over = (sh + np.uint64(self.l)) > np.uint64(64)
        v[over] |= self.low[word[over] + 1] << (np.uint64(64) - sh[over])
        return v & np.uint64((1 << self.l) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, dtype=np.int64)
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it doesn't occur."""
        x = np.asarray(x, dtype=np.uint64)
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n:
            return out
        ok = np.flatnonzero(x <= np.uint64(self.top))
        x = x[ok]
        h = (x >> np.uint64(self.l)).astype(np.int64)
        end = self._select(h, False) - h
        start = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        want = x & np.uint64((1 << self.l) - 1)
        lo, hi = start, end.copy()
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            mid = (lo[live] + hi[live]) // 2
            less = self._low(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
        hit = lo < end
        hit[hit] = self._low(lo[hit]) == want[hit]
        out[ok[hit]] = lo[hit]
        return out


class Trie:
    """Two levels: contexts, and below each its words. Contexts, pointers and words are Elias-Fano sequences; words are
    stored relative to their context (plus the sum of the ranges of the contexts before, which keeps the whole level
    monotone), each with a quantised value. All levels lie in one block of memory that can be mapped."""

    PARTS = ("contexts", "pointers", "bases", "words")

    @staticmethod
    def build(h: np.ndarray, w: np.ndarray, value: np.ndarray) -> bytes:
        """From pairs sorted by (h, w), without repeats."""
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        last = np.concatenate([first[1:], [len(h)]]) - 1 if len(h) else first
        width = w[last] + np.uint64(1) if len(h) else w
        base = np.concatenate([[np.uint64(0)], np.cumsum(width, dtype=np.uint64)[:-1]]).astype(np.uint64) if len(h) else w
        seqs = {"contexts": h[first], "pointers": np.concatenate([first, [len(h)]]).astype(np.uint64), "bases": base,
                "words": w + np.repeat(base, np.diff(np.concatenate([first, [len(h)]]))) if len(h) else w}
        heads, blobs, at = {}, [], 0
        for name in Trie.PARTS:
            head, *arrays = EliasFano.build(seqs[name])
            head["at"] = []
            for a in arrays:
                head["at"].append([at, len(a)])
                blobs.append(a.tobytes())
                at += a.nbytes
            heads[name] = head
        heads["value"] = [at, len(value)]
        blobs.append(value.astype("<u2").tobytes())
        head = json.dumps(heads).encode()
        head += b" " * (-(len(head) + 8) % 8)
        return len(head).to_bytes(8, "little") + head + b"".join(blobs)

    def __init__(self, block):
        """``block``: bytes or a memory map of what ``build`` returned."""
        size = int.from_bytes(block[:8], "little")
        heads, start = json.loads(bytes(block[8:8 + size])), 8 + size
        for name in self.PARTS:
            arrays = [np.frombuffer(block, dtype="<u8", count=n, offset=start + at) for at, n in heads[name]["at"]]
            setattr(self, name, EliasFano(heads[name], *arrays))
        at, n = heads["value"]
        self.value = np.frombuffer(block, dtype="<u2", count=n, offset=start + at)

    def lookup(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Value of each pair, 0 where it was never seen: find the context, then the word among its successors."""
        out = np.zeros(len(h), dtype=np.uint16)
        c = self.contexts.find(h)
        at = np.flatnonzero(c >= 0)
        if len(at):
            c = c[at]
            i = self.words.find(self.bases.access(c) + w[at])
            inside = (i >= self.pointers.access(c).astype(np.int64)) & (i < self.pointers.access(c + 1).astype(np.int64))
            out[at[inside]] = self.value[i[inside]]
        return out


def mapped(block: bytes) -> mmap.mmap:
    m = mmap.mmap(-1, max(1, len(block)))
    m.write(block)
    return m


# ---- the passes ----

def _ordered(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by (h, w)."""
    if not len(w) or max(int(w.max()), int(h.max())) < 1 << 32:
        return np.argsort((h << np.uint64(32)) | w, kind="stable")
    return np.lexsort((w, h))


def _groups(w: np.ndarray, h: np.ndarray):
    """(order, starts of equal pairs in it)."""
    o = _ordered(w, h)
    if not len(o):
        return o, o
    return o, np.flatnonzero(np.concatenate([[True], (w[o][1:] != w[o][:-1]) | (h[o][1:] != h[o][:-1])]))


def _token_schema(id_type) -> StructType:
    return StructType([StructField("chunk", StringType()), StructField("shard", IntegerType()), StructField("ids", ArrayType(id_type)),
                       StructField("held", ArrayType(BooleanType())), StructField("lens", ArrayType(LongType())),
                       StructField("a", BinaryType()), StructField("b", BinaryType()), StructField("c", BinaryType())])


def _read(shards: int):
    """Batches (id, held, text) to chunks: a row with the chunk's documents, their tokens numbered by falling
    frequency in the chunk, and for each shard a row with its words: number in the chunk, hash, count in training texts."""
    def rows(name, ids, held, tokens, id_type):
        lens = np.array([len(t) for t in tokens], dtype=np.int64)
        flat = np.concatenate(tokens)
        vocab, inv, n = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        number = np.empty(len(vocab), dtype=np.int64)
        number[order] = np.arange(len(vocab))
        local = number[inv]
        train = np.bincount(local[np.repeat(~np.array(held, dtype=bool), lens)], minlength=len(vocab))
        words = vocab[order]
        shard = (words % np.uint64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[by], np.arange(shards + 1))
        out = [(name, -1, ids, held, lens.tolist(), pack(local.astype(np.uint64)), None, None)]
        for s in np.flatnonzero(np.diff(cut)):
            i = by[cut[s]:cut[s + 1]]
            out.append((name, int(s), None, None, None, pack(i.astype(np.uint64)), words[i].tobytes(), pack(train[i].astype(np.uint64))))
        cols = list(zip(*out))
        kinds = [pa.string(), pa.int32(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["chunk", "shard", "ids", "held", "lens", "a", "b", "c"])

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, held, tokens, size, kind = [], [], [], 0, None
        for batch in batches:
            kind = batch.column(0).type
            for i, h, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch_bytes(batch, "text")):
                t = np.append(word_hashes(b), END)
                ids.append(i), held.append(h), tokens.append(t)
                size += len(t)
                if size >= CHUNK_TOKENS:
                    yield rows(f"{part}-{number}", ids, held, tokens, kind)
                    ids, held, tokens, size, number = [], [], [], 0, number + 1
        if tokens:
            yield rows(f"{part}-{number}", ids, held, tokens, kind)
    return run


_COUNTS = StructType([StructField("chunk", StringType()), StructField("shard", IntegerType()), StructField("a", BinaryType()), StructField("b", BinaryType()),
                      StructField("c", BinaryType()), StructField("n", LongType()), StructField("v", LongType()), StructField("n1", LongType()), StructField("n2", LongType())])


def _count(shards: int):
    """All rows of a shard to the corpus counts of its words: an answer for each chunk with the words' numbers in the
    chunk, their corpus ids (frequent words first) and counts; and a row of totals."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        s = key[0].as_py()
        rows = table.to_pylist()
        hashes = [np.frombuffer(r["b"], dtype=np.uint64) for r in rows]
        counts = np.concatenate([unpack(r["c"]) for r in rows]).astype(np.int64)
        vocab, inv = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(vocab), dtype=np.int64)
        np.add.at(total, inv, counts)
        rank = np.empty(len(vocab), dtype=np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(vocab))
        out, at = [(None, s, None, None, None, int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum()))], 0
        for r, h in zip(rows, hashes):
            i = inv[at:at + len(h)]
            at += len(h)
            out.append((r["chunk"], s, r["a"], pack((rank[i] * shards + s + 1).astype(np.uint64)), pack(total[i].astype(np.uint64)), None, None, None, None))
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()] + [pa.int64()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_COUNTS.names)
    return run


def _pair_schema(id_type) -> StructType:
    return StructType([StructField("chunk", StringType()), StructField("cell", LongType()), StructField("ids", ArrayType(id_type)),
                       StructField("held", ArrayType(BooleanType())), StructField("n", ArrayType(LongType())), StructField("known", ArrayType(LongType())),
                       StructField("base", ArrayType(DoubleType())), StructField("score", ArrayType(DoubleType())), StructField("pairs", BinaryType())])


_PAIR_KINDS = lambda t: [pa.string(), pa.int64(), pa.list_(t), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]


def _blob(arrays: list[np.ndarray]) -> bytes:
    packed = [pack(a) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in packed)


def _unblob(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(unpack(data[at + 8:at + 8 + n]))
        at += 8 + n
    return out


def trust(count: np.ndarray) -> np.ndarray:
    return TRUST * count / (count + TRUST_AT)


def _pair_up(shards: int, total: dict):
    """A chunk and the counts of its words to: each document's exact figures and its score as if no pair had been
    seen; and for each shard the chunk's pairs, with training counts and the documents they occur in."""
    n_all, v, d, starts = total["n"], total["v"], total["d"], total["starts"]

    def run(key: tuple[pa.Scalar, ...], tokens: pa.Table, answers: pa.Table) -> pa.Table:
        kind = tokens.schema.field("ids").type.value_type
        row = tokens.to_pylist()[0]
        local = unpack(row["a"]).astype(np.int64)
        size = int(local.max(initial=-1)) + 1
        count, word = np.zeros(size, dtype=np.float64), np.zeros(size, dtype=np.uint64)
        for r in answers.to_pylist():
            i = unpack(r["a"]).astype(np.int64)
            word[i], count[i] = unpack(r["b"]), unpack(r["c"])
        lens = np.array(row["lens"], dtype=np.int64)
        ends = np.cumsum(lens)
        c, w = count[local], word[local]
        per_doc = lambda x: np.add.reduceat(x, np.concatenate([[0], ends[:-1]]))
        base = per_doc(np.log10((c + 0.5) / (n_all + 0.5 * (v + 1))))
        one = np.log10(np.where(c > 0, (c - d) / max(n_all, 1), max(d * v / max(n_all, 1), 1e-12) if n_all else 1.0))
        ctx, ctx_n = np.concatenate([[0], w[:-1]]).astype(np.uint64), np.concatenate([[0.0], c[:-1]])
        first = np.concatenate([[0], ends[:-1]])
        ctx[first], ctx_n[first] = 0, starts
        lam = trust(ctx_n)
        score = per_doc(one + np.log10(1 - lam))
        doc = np.repeat(np.arange(len(lens)), lens)
        out = [(row["chunk"], -1 - zlib.crc32(row["chunk"].encode()), row["ids"], row["held"], lens.tolist(), per_doc((c > 0).astype(np.int64)).tolist(),
                base.tolist(), score.tolist(), None)]
        use = (c > 0) & (ctx_n > 0)
        w, h, doc, c1, lam, ctx_n = w[use], ctx[use], doc[use], one[use], lam[use], ctx_n[use]
        train = ~np.array(row["held"], dtype=bool)[doc]
        # How much one more count of the pair adds, relative to what is there without it.
        ratio = np.clip(np.round((np.log10(lam / ((1 - lam) * ctx_n)) - c1) / RATIO_STEP) + 128, 0, 255).astype(np.uint64) if len(w) else w
        cell = (mix(w ^ mix(h)) % np.uint64(shards)).astype(np.int64)
        by = np.argsort(cell, kind="stable")
        cut = np.searchsorted(cell[by], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cut)):
            i = by[cut[s]:cut[s + 1]]
            o, start = _groups(w[i], h[i])
            i = i[o]
            gap = np.diff(h[i[start]].astype(np.int64), prepend=0).astype(np.uint64)
            out.append((row["chunk"], int(s), None, None, None, None, None, None, _blob([
                gap, w[i[start]], ratio[i[start]], np.add.reduceat(train[i].astype(np.int64), start).astype(np.uint64),
                np.diff(np.append(start, len(i))).astype(np.uint64), doc[i].astype(np.uint64)])))
        return pa.table([pa.array(x, k) for x, k in zip(zip(*out), _PAIR_KINDS(kind))], names=["chunk", "cell", "ids", "held", "n", "known", "base", "score", "pairs"])
    return run


def _score_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """All pairs of a shard: sum the training counts into a trie, then ask it for each chunk's pairs and return what they
    add to each document."""
    if key[0].as_py() < 0:
        return table
    kind = table.schema.field("ids").type.value_type
    names, blobs = table.column("chunk").to_pylist(), [_unblob(b) for b in table.column("pairs").to_pylist()]
    contexts = [np.cumsum(b[0].astype(np.int64)).astype(np.uint64) for b in blobs]
    h, w = np.concatenate(contexts), np.concatenate([b[1] for b in blobs])
    n, z = np.concatenate([b[3] for b in blobs]).astype(np.int64), np.concatenate([b[2] for b in blobs])
    seen = n > 0
    h, w, n, z = h[seen], w[seen], n[seen], z[seen]
    o, start = _groups(w, h)
    if len(o):
        n = np.add.reduceat(n[o], start)
        h, w, z = h[o][start], w[o][start], z[o][start]
    gain = np.log10(1 + n * 10.0 ** ((z.astype(np.float64) - 128) * RATIO_STEP))
    trie = Trie(mapped(Trie.build(h, w, np.clip(np.round(gain / GAIN_STEP), 0, 65535).astype(np.uint16))))
    out = []
    for name, ctx, b in zip(names, contexts, blobs):
        add = np.repeat(trie.lookup(ctx, b[1]) * GAIN_STEP, b[4].astype(np.int64))
        doc = b[5].astype(np.int64)
        sums = np.bincount(doc, weights=add)
        at = np.flatnonzero(sums)
        out.append((name, None, None, None, None, None, None, None, _blob([at.astype(np.uint64), np.round(sums[at] * 4096).astype(np.uint64)])))
    return pa.table([pa.array(x, k) for x, k in zip(zip(*out), _PAIR_KINDS(kind))], names=["chunk", "cell", "ids", "held", "n", "known", "base", "score", "pairs"])


def _finish(names: list[str], n_all: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["ids"] is not None)
        score = np.array(own["score"])
        for r in rows:
            if r["ids"] is None:
                at, add = _unblob(r["pairs"])
                score[at.astype(np.int64)] += add / 4096
        kind = table.schema.field("ids").type.value_type
        cols = [pa.array(own["ids"], kind), pa.array(own["held"], pa.bool_()), pa.array(own["n"], pa.int64()), pa.array(own["known"], pa.int64()),
                pa.array([n_all] * len(score), pa.int64()), pa.array(own["base"], pa.float64()), pa.array(score, pa.float64())]
        return pa.table(cols, names=names)
    return run


def score(docs: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for every row of ``docs``.

    Tokens are the words and one end; the model learns from the rows where ``held_out`` is false. base_score is the sum
    of log10((c + 1/2) / (N + (V + 1) / 2)); score is the log10 probability of the text under the bigram model

        p(w | h) = t(h) c(h, w) / c(h) + (1 - t(h)) p(w),   t(h) = TRUST c(h) / (c(h) + TRUST_AT),

    where p(w) discounts each count by the Good-Turing estimate and gives what is freed to the unknown word; a context
    never seen has t = 0. Null and empty texts are one end. A null ``held_out`` counts as false. Repeated rows are
    documents of their own. Without training rows N and V are 0 and both scores follow the formulas. Other columns are
    not looked at; empty input gives an empty result.

    Nothing of the model is held whole anywhere. Texts become chunks of hashed words, stored once. Words meet in shards
    that return corpus counts to the chunks; then the pairs of each chunk, summed, meet in shards by pair, where the
    trie is built in a memory map and asked on the spot, and only sums per document come back. A word or pair
    that fills the corpus is one entry a chunk, and shards follow a hash, so none is larger than the others."""
    held = F.coalesce(held_out, F.lit(False)).cast("boolean")
    base = docs.select(F.col(f"`{doc_id}`").alias("id"), held.alias("held"), F.col(f"`{text}`").alias("text"))
    id_type = base.schema["id"].dataType
    size = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    tokens = stored(base.mapInArrow(_read(shards), _token_schema(id_type)), "lm-chunks")
    counts = stored(tokens.where("shard >= 0").select("chunk", "shard", "a", "b", "c").groupBy("shard").applyInArrow(_count(shards), _COUNTS), "lm-counts")
    t = counts.where("chunk IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n1", "n2")]).first()
    starts = tokens.where("shard = -1").select(F.sum(F.size(F.filter("held", lambda x: ~x))).alias("s")).first()["s"] or 0
    d = min(0.9, max(0.1, t["n1"] / (t["n1"] + 2 * t["n2"]))) if t["n1"] else 0.5
    total = {"n": t["n"], "v": t["v"], "d": d, "starts": float(starts)}
    chunk = tokens.where("shard = -1").select("chunk", "ids", "held", "lens", "a")
    answers = counts.where("chunk IS NOT NULL").select("chunk", "a", "b", "c")
    schema = _pair_schema(id_type)
    pairs = chunk.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_pair_up(shards, total), schema)
    sums = pairs.groupBy("cell").applyInArrow(_score_pairs, schema)
    fields = [StructField(doc_id, id_type), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
              StructField("train_tokens", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType())]
    return sums.groupBy("chunk").applyInArrow(_finish([f.name for f in fields], int(t["n"])), StructType(fields))
