"""Helpers the pipeline operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from corpusflow.session import configure, cut_lineage

CHUNK = 1 << 20          # bytes of text hashed at once


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a directory, read by Spark (the path may be one only Spark can open)."""
    return configure(spark).read.parquet(f"{base}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared directory and read back: computed once, survives a lost executor."""
    return cut_lineage(df, name)


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them once the driver's garbage collector has found
    their jobs gone, which a job that keeps its driver idle can put off for long. Tables that Python's collector has
    not let go of yet hold theirs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: Column, buckets: int = 5) -> Column:
    """crc32 of the id as text, modulo ``buckets``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % buckets, F.lit(0)).cast("int")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns whose names (in any case) are about to be added."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def append(df: DataFrame, fields: Sequence[StructField], fn: Callable[[pa.RecordBatch], Sequence[pa.Array]]) -> DataFrame:
    """``df`` plus computed columns, batch by batch. A column of the same name is replaced: ``fn`` still
    sees it, under its own name, in the batch."""
    new = {f.name.lower() for f in fields}
    keep = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in keep] + [f.name for f in fields]

    def run(batches):
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(cols + list(fn(batch)), names=names)

    return df.mapInArrow(run, StructType(keep + list(fields)))


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


_rng = np.random.default_rng(20240817)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _STEP, dtype=np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


_POW = _powers(1 << 12)


def word_hashes(text: bytes | np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of an UTF-8 text after lower-casing A-Z, in order.
    The separators are ASCII, so bytes can be tested alone. Long texts go piece by piece."""
    b = np.frombuffer(text, dtype=np.uint8) if isinstance(text, (bytes, bytearray, memoryview, pa.Buffer)) else text
    if len(b) > CHUNK:
        out, at = [], 0
        while at < len(b):
            end = min(len(b), at + CHUNK)
            if end < len(b):
                gaps = np.flatnonzero(_SPACE[b[at:end]])
                while not len(gaps) and end < len(b):          # a word longer than a piece stays whole
                    more = min(len(b), end + CHUNK)
                    gaps, base = np.flatnonzero(_SPACE[b[end:more]]), end
                    end = more if not len(gaps) else base + int(gaps[0]) + 1
                    if len(gaps):
                        break
                else:
                    if len(gaps) and end < len(b):
                        end = at + int(gaps[-1]) + 1
            out.append(_hash_piece(b[at:end]))
            at = end
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    return _hash_piece(b)


def _hash_piece(b: np.ndarray) -> np.ndarray:
    global _POW
    word = ~_SPACE[b]
    if not word.any():
        return np.zeros(0, dtype=np.uint64)
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    at = np.flatnonzero(word)
    first = np.zeros(len(b), dtype=np.int64)
    first[starts] = starts
    pos = at - np.maximum.accumulate(first)[at]
    longest = int(pos.max()) + 1
    if longest > len(_POW):
        _POW = _powers(1 << longest.bit_length())
    value = _BYTE[_LOWER[b[at]]] * _POW[pos]
    begin = np.flatnonzero(pos == 0)
    return mix(np.add.reduceat(value, begin))


def batch_bytes(batch: pa.RecordBatch, name: str):
    """Yield the UTF-8 bytes of each text of a batch as a view, null as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(col)):
        yield raw[off[i]:off[i + 1]] if valid[i] else raw[:0]


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of an edge table (u, v) by large-star and small-star rounds: (node, root),
    root the smallest node of its component. Every round is an aggregate and a join, stored before the next;
    nothing is gathered per node, so a node with a great many neighbours costs no single task."""
    cur = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    def star(e: DataFrame, both: bool) -> DataFrame:
        # Large star looks at all neighbours of a node, small star at the smaller ones.
        side = e.select("u", "v")
        if both:
            side = side.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = side.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        rows = side.join(low, "u")
        if both:
            out = rows.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = mark(cur)
    while before[0]:
        large = stored(star(cur, True), name)
        small = stored(star(large, False), name)
        discard(large), discard(cur)
        cur = small
        after = mark(cur)
        if after == before:
            break
        before = after
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
