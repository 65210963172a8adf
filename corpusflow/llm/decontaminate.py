"""Benchmark decontamination: Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from corpusflow.llm.common import append, texts

WINDOW = 10              # words of a test string
PATTERN_BYTES = 32 << 20  # text of the test items in one pass over the documents

# Bytes that stand for themselves in a word; all others end it. Other than ASCII, every byte belongs to a word.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def split_words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WuManber:
    """Search of many strings of words. Strings of one length form a group with its own tables: the block is the
    last two words (one, for strings of one word), ``shift`` says how far the end may move for a block, and the strings
    whose shift is 0 lie in buckets by the hash of their block and first word."""

    def __init__(self, items, window: int = WINDOW):
        """items: pairs (item id as string, text). Windows of ``window`` words; a shorter item is one window."""
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple, set] = defaultdict(set)
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in split_words(text)]
            if w:
                m = min(window, len(w))
                for i in range(len(w) - m + 1):
                    owners[tuple(w[i:i + m])].add(item)
        self.groups = []
        by_len = defaultdict(list)
        for p, own in owners.items():
            by_len[len(p)].append((p, own))
        for m, patterns in sorted(by_len.items()):
            block = min(2, m)
            shift, buckets = {}, defaultdict(list)
            for p, own in patterns:
                for end in range(block, m + 1):
                    b = p[end - block:end]
                    shift[b] = min(shift.get(b, m), m - end)
                buckets[hash((p[m - block:], p[0]))].append((p, own))
            self.groups.append((m, block, shift, dict(buckets)))

    def find(self, words: list[bytes]):
        """(word positions inside an occurrence, items with one)."""
        get = self.ids.get
        w = [get(x, 0) for x in words]
        n, hit, items = len(w), set(), set()
        for m, block, shift, buckets in self.groups:
            far = m - block + 1
            i = m
            while i <= n:
                b = (w[i - 2], w[i - 1]) if block == 2 else (w[i - 1],)
                s = shift.get(b, far)
                if s:
                    i += s
                    continue
                found = buckets.get(hash((b, w[i - m])))
                if found:
                    here = tuple(w[i - m:i])
                    for p, own in found:
                        if p == here:
                            hit.update(range(i - m, i))
                            items |= own
                i += 1
        return hit, items


_STATE = [StructField("_dc_words", LongType()), StructField("_dc_hit", ArrayType(LongType())), StructField("_dc_items", ArrayType(StringType()))]
_held: dict[str, WuManber] = {}


def _matcher(token: str, shared) -> WuManber:
    """The tables of a pass, made once per worker; only the last ones are kept."""
    if token not in _held:
        _held.clear()
        _held[token] = WuManber(shared.value)
    return _held[token]


def find_hits(docs: DataFrame, items: list[tuple[str, str]], text: str) -> DataFrame:
    """One pass over the documents with one part of the test items; what earlier passes found is kept."""
    shared, token = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    again = "_dc_hit" in docs.columns

    def run(batch: pa.RecordBatch):
        find = _matcher(token, shared).find
        words, hits, owns = [], [], []
        for t in texts(batch, text):
            w = split_words(t)
            h, own = find(w)
            words.append(len(w)), hits.append(h), owns.append(own)
        if again:
            old = [batch.column(batch.schema.get_field_index(f.name)).to_pylist() for f in _STATE[1:]]
            hits, owns = [h | set(o) for h, o in zip(hits, old[0])], [w | set(o) for w, o in zip(owns, old[1])]
        return [pa.array(words, pa.int64()), pa.array([sorted(h) for h in hits], pa.list_(pa.int64())),
                pa.array([sorted(o) for o in owns], pa.list_(pa.string()))]

    return append(docs, _STATE, run)


def parts(benchmark: DataFrame, item_id: str, text: str, limit: int = PATTERN_BYTES):
    """The test items in parts of at most ``limit`` bytes (one longer item is a part of its own). Only one part
    at a time is held by the driver."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    part, held = [], 0
    for r in rows.toLocalIterator():
        if part and held + len(r["t"]) * 4 > limit:
            yield part
            part, held = [], 0
        part.append((r["i"], r["t"]))
        held += len(r["t"]) * 4
    yield part


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  limit: int = PATTERN_BYTES) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated.

    A test string is a window of ``WINDOW`` consecutive words of a test item, or a whole shorter item; a document
    word inside any occurrence is hit. items_sha256 is of the ids of the occurring items as strings, sorted and
    comma-joined (of the empty string if there is none). Null or empty text: no words, not contaminated. Test items
    with null id or text, or without words, take no part; several rows of one id are one item. Repeated documents
    are judged each on their own. Columns named like a new one are replaced.

    The test set is cut into parts of bounded size; each part is a pass over the documents, in place, without a
    shuffle. A usual test set is one part."""
    out = docs
    for part in parts(benchmark, item_id, item_text, limit):
        out = find_hits(out, part, text)
    found = {"n_words": F.col("_dc_words"), "n_hit": F.size("_dc_hit").cast("long"), "n_items": F.size("_dc_items").cast("long"),
             "items_sha256": F.sha2(F.concat_ws(",", "_dc_items").cast("binary"), 256), "contaminated": F.size("_dc_hit") > 0}
    return out.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in found] + [c.alias(n) for n, c in found.items()])
