"""Toxicity: compression-distance classification with zstandard dictionaries."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from corpusflow.llm.common import append, texts

WORDS, BYTES = 8, 512        # a window holds so many words, in so many bytes at most
LEVEL = 9
ORDINARY_DICT, TOXIC_DICT = 131072, 8192   # bytes, of spelled text
PIECE = 5                    # characters of a piece, blanks around a word included
MARKED_Z, MARKED_RATIO, MARKED_DOCS = 12.0, 10, 5   # how surely, how much, and in how many toxic texts, a piece has to be over-represented
GAIN = 4                     # bytes from which a window counts as gaining
SAMPLE_ROWS = 8000           # labelled rows of a class that training looks at, at most
SAMPLE_CHARS = 12_000_000    # and their characters; a text of over a hundredth of them takes no part in training


def windows(text: str) -> list[bytes]:
    """The text in lower case, cut into windows; every word is in exactly one (words of over ``BYTES`` are cut)."""
    w = text.lower().split()
    out = []
    for i in range(0, len(w), WORDS):
        b = " ".join(w[i:i + WORDS]).encode("utf-8", "replace")
        out.extend([b] if len(b) <= BYTES else [b[j:j + BYTES] for j in range(0, len(b), BYTES)])
    return out


def spelled(window: bytes) -> bytes:
    """Every byte followed by its two next ones. A word comes to three times its length, a match costs the same, so
    that one short word shows in the compressed length."""
    n = len(window)
    out = bytearray(3 * n)
    out[0::3], out[1::3], out[2::3] = window, (window[1:] + b" ")[:n], (window[2:] + b"  ")[:n]
    return bytes(out)


def _compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False,
                                                     write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)
    return zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(content or b" ", dict_type=zs.DICT_TYPE_RAWCONTENT), compression_params=params)


def _train(size: int, samples: list[bytes]) -> bytes:
    """Dictionary of the samples; where there are too few to train on, the samples themselves."""
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b" ".join(samples)[-size:]


def _distinct_texts(rows: list[str]) -> list[str]:
    """Texts without near copies of an earlier one (any of four min-hashes over word triples is the same), so that
    the words of a much-copied text don't look like words of its class."""
    seen, out = set(), []
    for t in rows:
        w = t.lower().split()
        grams = [" ".join(w[i:i + 3]).encode("utf-8", "replace") for i in range(max(1, len(w) - 2))]
        own = {(s, min(zlib.crc32(g, s * 0x9E3779B9 & 0xFFFFFFFF) for g in grams)) for s in range(1, 5)}
        if not own & seen:
            out.append(t)
        seen |= own
    return out


def pieces(text: str) -> set[str]:
    """The words of a text between blanks, and the runs of ``PIECE`` characters in them."""
    own = {f" {w} " for w in text.lower().split()}
    return own | {w[i:i + PIECE] for w in own for i in range(len(w) - PIECE + 1)}


def marked_words(toxic: list[str], ordinary: list[str]) -> set[str]:
    """Words that hold a piece found in far more toxic texts than its rate in ordinary texts lets expect. Pieces make
    words of a common stem count together, in however few texts each of them is."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(pieces(t))
    a = {p: n for p, n in a.items() if n >= MARKED_DOCS}
    for t in ordinary:
        b.update(pieces(t) & a.keys())
    marks = set()
    for p, n in a.items():
        mean = len(toxic) * (b[p] + 1) / max(1, len(ordinary))
        if n >= MARKED_RATIO * mean and (n - mean) / mean ** 0.5 >= MARKED_Z:
            marks.add(p)
    return {w for t in toxic for w in set(t.lower().split()) if pieces(w) & marks}


class Model:
    """Two dictionaries and a calibration. The ordinary dictionary is trained on ordinary windows; the toxic one on
    the words of toxic texts that hold over-represented pieces, as they occur, and goes in front of the ordinary content, so that the two
    compressed lengths of a window differ only by what the toxic training adds."""

    def __init__(self, ordinary: bytes = b"", toxic: bytes = b"", weights=None, prior: float = 0.0):
        self.ordinary, self.toxic, self.weights, self.prior = ordinary, toxic, weights, prior
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def features(self, text: str) -> list[float]:
        """Gains of the toxic dictionary in bytes: the largest, the mean of the three largest, the mean of all, the
        largest as a share of its window, and the number of windows that gain, on a log scale."""
        if self._pair is None:
            self._pair = _compressor(self.ordinary).compress, _compressor(self.toxic + self.ordinary).compress
        a, b = self._pair
        ws = windows(text)
        if not ws:
            return [0.0] * 5
        gain = np.array([len(a(w)) - len(b(w)) for w in map(spelled, ws)], dtype=float)
        top = np.sort(gain)[::-1]
        share = (gain / np.maximum(60, [len(w) for w in ws])).max()
        return [top[0], top[:3].sum() / 3, gain.mean(), 100 * share, float(np.log1p((gain >= GAIN).sum()))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        mean, scale, beta = self.weights
        z = float(np.dot((np.array(self.features(text)) - mean) / scale, beta[1:]) + beta[0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    beta, pen = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    pen[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + pen, x.T @ (w * (y - p)) - pen @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(rows: list[tuple[str, int]], counts: dict[int, int]) -> Model:
    """Train on (text, 0 or 1). Two thirds of the texts make the dictionaries, the rest calibrates the gains by
    logistic regression; ``counts`` are the labelled rows of each class, to which the classes are weighted."""
    total = max(1, sum(counts.values()))
    prior = min(0.49, counts.get(1, 0) / total)
    part = {c: [t for t, y in rows if y == c] for c in (0, 1)}
    if len(part[0]) < 6 or len(part[1]) < 6:
        return Model(prior=prior)
    fit = {c: _distinct_texts([t for i, t in enumerate(part[c]) if i % 3]) for c in part}
    marked = marked_words(fit[1], fit[0])
    seen = [spelled(f" {w} ".encode("utf-8", "replace")) for t in fit[1] for w in t.lower().split() if w in marked]
    samples = [b"".join(seen[i:i + 8]) for i in range(0, len(seen), 8)]
    model = Model(_train(ORDINARY_DICT, [spelled(w) for t in fit[0] for w in windows(t)]), _train(TOXIC_DICT, samples) if samples else b"", None, prior)
    held = [(t, c) for c in part for i, t in enumerate(part[c]) if not i % 3]
    x, y = np.array([model.features(t) for t, _ in held]), np.array([c for _, c in held], dtype=float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    share = {c: counts[c] / max(1, (y == c).sum()) / total * len(y) for c in (0, 1)}
    model.weights = mean, scale, _logistic((x - mean) / scale, y, np.where(y == 1, share[1], share[0]))
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Model from the labelled rows of ``labels`` (doc_id, label). Training looks at a bounded sample: of each class
    the first ``rows`` ids in hash order, as far as their texts together stay within ``chars`` characters. Texts of over
    ``chars`` / 100 characters are left out of it, so that none can use up the bound of its class. Ids with null labels or
    none take no part; an id labelled twice is toxic if one label says so; of several texts with one id the longest
    counts, of equally long ones the first. Without enough rows, an empty table included, the model is its prior."""
    y = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
         .agg(F.max((F.col(label) == 1).cast("int")).alias("y")))
    counts = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    order = Window.partitionBy("y").orderBy("_h", "_id")
    hashed = y.withColumn("_h", F.xxhash64("_id"))
    # The first ids of a class come from the sorted tops of all tasks.
    first = hashed.where("y = 0").orderBy("_h", "_id").limit(rows).unionByName(hashed.where("y = 1").orderBy("_h", "_id").limit(rows))
    docs = docs.select(F.col(f"`{doc_id}`").alias("d"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    # At most 2 * rows ids: small enough to send to every task.
    sized = (docs.join(F.broadcast(first), F.col("d") == F.col("_id")).groupBy("_id", "y", "_h").agg(F.max(F.length("t")).alias("n"))
             .where(F.col("n") <= chars // 100).withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("upto") <= chars))
    found = (docs.join(F.broadcast(sized.select("_id", "y", "_h", "n")), F.col("d") == F.col("_id")).where(F.length("t") == F.col("n"))
             .groupBy("_id", "y", "_h").agg(F.min("t").alias("t")).collect())
    return train([(r["t"], r["y"]) for r in sorted(found, key=lambda r: (r["_h"], r["_id"]))], counts)


_FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
_held: dict[str, Model] = {}


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 from 0.5). Whole texts are scored, window by window; only the text
    is looked at. Null and empty texts get the score of a text without any gain; a model without enough labelled
    rows of both classes gives every text the share of toxic rows, below 0.5. Repeated rows get the same score, a text of
    any length one of all its windows, an empty table no rows. Columns of these names are replaced."""
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batch: pa.RecordBatch):
        if token not in _held:
            _held.clear()
            _held[token] = shared.value
        s = [_held[token].score(t) for t in texts(batch, text)]
        return [pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())]

    return append(docs, _FIELDS, run)
