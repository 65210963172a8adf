"""Token counts: byte-pair merging with a heap over a linked list of symbols."""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from corpusflow.llm.common import append, texts

LIMIT = 2048
HELD_WORDS = 1 << 20         # words whose counts a worker remembers

# Fixed values of the vocabulary file's format: its word pattern and its white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = regex.compile(PATTERN)
_BEYOND = regex.compile(r"[^\x00-\x1b\x20-ɏ]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in set(plain):
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Counter:
    """Numbers of tokens under a vocabulary file of byte-level pair merges with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.known = set(model["vocab"])
        self.end = model.get("end_of_word_suffix") or ""
        self.symbol = byte_symbols()
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words: dict[str, int] = {}
        self.path, self.exact = path, None

    def count_word(self, word: str) -> int:
        """Symbols of one word less the merges: the pair of lowest rank, the leftmost of equals, is merged until no
        pair is left. Pairs wait in a heap; the symbols are a doubly linked list, and a pair whose symbols have
        changed since is passed over."""
        s = [self.symbol[b] for b in word.encode("utf-8")]
        s[-1] += self.end
        s = [x for x in s if x in self.known]
        n, rank = len(s), self.rank
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(s, s[1:])) if p in rank]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = a + b, None
            merges += 1
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
                p = (s[i], s[k])
                if p in rank:
                    heapq.heappush(heap, (rank[p], i, p))
            h = before[i]
            if h >= 0:
                p = (s[h], s[i])
                if p in rank:
                    heapq.heappush(heap, (rank[p], h, p))
        return n - merges

    def pieces(self, text: str) -> list[str]:
        """Normalised words of a text without special strings. Up to U+024F composition, lower case and letter
        classes are the same everywhere; texts beyond go by the vocabulary library's own normaliser and splitter,
        whose Unicode tables are the ones to match."""
        if _BEYOND.search(text) is None:
            return _SPLIT.findall(unicodedata.normalize("NFC", text).lower())
        if self.exact is None:
            from tokenizers import Tokenizer
            self.exact = Tokenizer.from_file(self.path)
            self.back = {c: b for b, c in enumerate(self.symbol)}
        norm = self.exact.normalizer.normalize_str(text)
        return [bytes(self.back[c] for c in w).decode("utf-8") for w, _ in self.exact.pre_tokenizer.pre_tokenize_str(norm)]

    def count(self, text: str) -> int:
        parts, total = [text], 0
        if self.special is not None and "<" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        held = self.words
        for part in parts:
            for w in self.pieces(part):
                n = held.get(w)
                if n is None:
                    n = self.count_word(w)
                    if len(w) <= 64:
                        if len(held) >= HELD_WORDS:
                            held.clear()
                        held[w] = n
                total += n
        return total


_counters: dict[str, Counter] = {}
_FIELDS = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` plus n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``vocabulary`` is the path of the file on every machine. Null text counts as empty: 0 and 0. Special strings inside
    a text are one token each. Columns of the new names are replaced. Rows stay where they are read; each worker keeps
    the counts of words it has met, a bounded number of them."""
    def run(batch: pa.RecordBatch):
        c = _counters.get(vocabulary) or _counters.setdefault(vocabulary, Counter(vocabulary))
        ts = texts(batch, text)
        n = [c.count(t) for t in ts]
        return [pa.array([len(t.encode("utf-8")) for t in ts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

    return append(docs, _FIELDS, run)
