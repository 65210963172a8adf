"""Best-fit packing: exact complements of lengths by single, pair and triple sums, then best fit for what is left."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from corpusflow.llm.common import append, stored
from corpusflow.llm.ranks import ranked

LIMIT, END = 1024, 2

# Fixed value: the public word pattern of byte-level vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---- token ids --------------------------------------------------------------------------------------------------

def _alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies spell bytes with: printable Latin-1 by themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def encoder(path: str):
    """Function from a text to its ids, those the ``tokenizers`` library gives for the file without special tokens added.
    A plain byte-level file is run by ``tiktoken``, four times as fast; any other file by the library itself."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], spec["added_tokens"]
    pre = spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex")
             and not pre.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")))
    # The rank of a merge has to be the order of the ids it makes.
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]] if plain else []
    if plain and None not in made and all(a < b for a, b in zip(made, made[1:])):
        import tiktoken
        byte, special = _alphabet(), {a["content"]: a["id"] for a in added}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        run = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: run.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer
    run = Tokenizer.from_file(path)
    run.no_truncation()
    run.no_padding()
    return lambda text: np.array(run.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


_ENCODERS: dict = {}      # one per worker process and file


def _encoder(path: str):
    if path not in _ENCODERS:
        _ENCODERS[path] = encoder(path)
    return _ENCODERS[path]


_PIECE = [StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids_crc32", LongType())]


def cut(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end: int = END, ids: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), with ``ids`` also the ids themselves: the pieces of each document's ids,
    ``end`` appended. A document of at most ``limit`` ids is one piece. A longer one is cut into pieces of ``limit``;
    what doesn't fill one is its first piece.

    ``vocabulary`` is the path of a tokenizer file that all workers can read. Special strings in texts are the library's
    default: their own id. A null or empty text is the end alone. Texts of any length are encoded whole, one at a time.
    Repeated rows and ids give pieces of their own. Other columns are not looked at; an empty table gives no pieces."""
    id_type = docs.schema[doc_id].dataType
    fields = [StructField("doc_id", id_type), *_PIECE, *([StructField("ids", ArrayType(IntegerType()))] if ids else [])]

    def run(batches):
        encode = _encoder(vocabulary)
        for batch in batches:
            row, piece, start, length, crc, data = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                tokens = np.append(encode(t.as_py() or "").astype("<u4"), np.uint32(end)).astype("<u4")
                head = (len(tokens) - 1) % limit + 1
                edges = [0, *range(head, len(tokens) + 1, limit)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = tokens[a:b]
                    row.append(i), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(part.tobytes()))
                    if ids:
                        data.append(part.astype(np.int32))
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                arrays.append(pa.array(data, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, StructType(fields))


# ---- the plan: a function of how many pieces there are of each length ---------------------------------------------

class Complements:
    """Lengths still available, with an index of the sums that one, two or three of them make. Availability only falls, so
    a sum found to be unreachable stays so and is never searched again."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        n = len(counts)
        here = np.flatnonzero(counts)
        self.pairs, self.triples = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        for a in here:
            s = a + here
            self.pairs[s[s < n]] = True
        for s in np.flatnonzero(self.pairs):
            t = s + here
            self.triples[t[t < n]] = True

    def single(self, total: int) -> tuple | None:
        return (total,) if self.left[total] else None

    def pair(self, total: int) -> tuple | None:
        """The pair of available lengths with this sum that is most alike, so that short pieces stay for small gaps."""
        if not self.pairs[total]:
            return None
        a = np.arange((total + 1) // 2, total)
        ok = a[(self.left[a] > 0) & (self.left[total - a] > (a == total - a))]
        return (int(ok[0]), int(total - ok[0])) if len(ok) else None

    def triple(self, total: int) -> tuple | None:
        if not self.triples[total]:
            return None
        first = np.arange(total - 2, 0, -1)
        first = first[np.argsort(np.abs(3 * first - total), kind="stable")]
        for a in first[(self.left[first] > 0) & self.pairs[total - first]]:
            self.left[a] -= 1
            rest = self.pair(total - a)
            self.left[a] += 1
            if rest:
                return (int(a), *rest)
            if self.pair(total - a) is None:
                self.pairs[total - a] = False
        return None


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths of their pieces, how many such sequences), using up ``counts`` (length to number of pieces).

    From the longest length down, combinations that fill a sequence exactly are taken as often as the available counts
    allow: first a length with its single complement, then with a pair, then with a triple. What is left is packed by best
    fit, from the longest down: a piece goes into the fullest sequence that has room. Pairs and triples use up short
    pieces that best fit may need more, so the plan is made with complements of up to three, two and one pieces, and the
    one with the fewest sequences counts. Equal sequences are one entry throughout, so the work depends on the number of
    different lengths, at most ``limit``, and not on the number of pieces."""
    have = np.zeros(limit + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    tries = [_complete(have, limit, most) for most in (3, 2, 1)]
    return min(tries, key=lambda t: sum(n for _, n in t))


def _complete(have: np.ndarray, limit: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    index, full = Complements(have), []
    for find in (lambda gap: () if gap == 0 else index.single(gap), index.pair, index.triple)[:most]:
        for length in range(limit, 0, -1):
            while index.left[length]:
                index.left[length] -= 1
                rest = find(limit - length)
                index.left[length] += 1
                if rest is None:
                    break
                uses = {x: (length, *rest).count(x) for x in (length, *rest)}
                times = min(int(index.left[x]) // k for x, k in uses.items())
                for x, k in uses.items():
                    index.left[x] -= k * times
                full.append(((length, *rest), times))
    return full + _best_fit(index.left, limit)


def _best_fit(left: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    rooms: list[list] = [[] for _ in range(limit + 1)]       # by free room: (lengths, how many)
    for length in range(limit, 0, -1):
        n, room = int(left[length]), length
        while n and room <= limit:
            if not rooms[room]:
                room += 1
                continue
            lengths, times = rooms[room].pop()
            take = min(n, times)
            if take < times:
                rooms[room].append((lengths, times - take))
            rooms[room - length].append(((*lengths, length), take))
            n -= take
            # A sequence just filled may take another piece of this length, and is fuller than the others.
            if room - length >= length:
                room -= length
        each = limit // length
        for k, times in ((each, n // each), (n % each, 1)):
            if k and times:
                rooms[limit - k * length].append(((length,) * k, times))
    return [x for r in rooms for x in r]


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Places for the pieces of each length, as intervals of their position among their equals: (length, first position,
    first sequence_id, offset), sorted. Position p of an interval belongs to the sequence ``first sequence_id + p - first``."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in sequences:
        offset = 0
        for length in lengths:
            at = used.get(length, 0)
            out.append((length, at, sequence, offset))
            used[length] = at + times
            offset += length
        sequence += times
    out.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


# ---- packing ------------------------------------------------------------------------------------------------------

def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` (of ``cut``, or any with a ``length`` from 1 to ``limit``) with ``sequence_id`` and ``offset``: sequences of
    at most ``limit``, pieces without gaps from 0.

    Only the number of pieces per length comes to the driver, at most ``limit`` rows, and the plan made of it goes to all
    tasks: intervals of positions, their number bounded by the number of lengths. Every piece finds its place by its
    position among the pieces of its length, counted over a range partitioning, so that a length that a third of all
    have is spread. Ties (equal doc_id, piece and content) are alike, so either may come first. No pieces: empty result."""
    rows = stored(pieces, "pack-pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and not 0 < min(counts) <= max(counts) <= limit:
        raise ValueError(f"lengths of pieces have to be from 1 to {limit}")
    length, first, sequence, offset = slots(plan(counts, limit))
    key = (length << 44) + first

    def place(batch):
        n = batch.column(batch.schema.get_field_index("length")).to_numpy()
        p = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
        i = np.searchsorted(key, (n << 44) + p, side="right") - 1
        return [pa.array(sequence[i] + p - first[i]), pa.array(offset[i])]

    at = ranked(rows, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank", "pack-ranks")
    return append(at, [StructField("sequence_id", LongType()), StructField("offset", LongType())], place).drop("_rank")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of packed pieces that carry their ``ids``, a row per sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
