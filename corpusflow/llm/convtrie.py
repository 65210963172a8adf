"""Conversation prefix trie: subtree totals by time-forward processing, in shards of bounded size and across their roots."""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from corpusflow.llm.common import stored
from corpusflow.llm.ranks import laid_out
from corpusflow.operators.scan import ordinal_bucket, prefix_scan

SHARD = 1 << 18          # turns below a node from which on it is a node of the upper part
BAND = 4096              # levels of a shard of the upper part
MESSAGES = 1 << 19       # messages a priority queue holds in memory
SALTS = 32               # copies of a node of the upper part in joins with the rows under it
SPAN = 4096              # levels of a conversation that share a join key
IDS = 1 << 16            # ids joined into one text

NONE = hashlib.sha256(b"").hexdigest()


def ordered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order, without their texts: (conv_id, piece, pos, digest, bytes) and the pieces of each conversation,
    (conv_id, piece, n) with ``n`` the turns of the whole conversation.

    ``pos`` counts from 0 along ``turn`` (null first), then role, then digest. A null role or text is the empty one. The
    digest is of role and text, ``bytes`` the UTF-8 length of the text. Rows without a conv_id take no part. A
    conversation of any length is spread over its pieces; join by ``conv_id, piece``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = stored(conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")), "trie-turns")
    rows, pieces = laid_out(rows, ["conv_id"], ["turn", "role", "digest"], "trie-ordered")
    pieces = stored(pieces, "trie-pieces")
    turns = rows.join(pieces, ["conv_id", "_p"]).select(
        "conv_id", F.col("_p").alias("piece"), (F.col("_at") + F.col("_shift")).alias("pos"), "digest", "bytes")
    size = pieces.groupBy("conv_id").agg(F.sum("_count").alias("n"))
    return turns, pieces.join(size, "conv_id").select("conv_id", F.col("_p").alias("piece"), "n")


def _parts(pos, digest) -> list[Column]:
    """Four 32-bit numbers of a turn at its place. A prefix is known by their sums."""
    a, b = F.xxhash64(pos, digest), F.xxhash64(F.lit(1), digest, pos)
    return [F.shiftrightunsigned(x, s).bitwiseAND(F.lit(0xFFFFFFFF)) for x in (a, b) for s in (0, 32)]


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def _paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and prefix of it, the empty one included: (conv_id, depth, node, parent, bytes, rest), ``rest``
    the turns after the prefix. Prefix sums run over pieces of a conversation, so one of any length is spread."""
    names = ["_a", "_b", "_c", "_d"]
    marked = turns.select("conv_id", "pos", "bytes", "length", *[p.alias(f"_v{n}") for n, p in zip(names, _parts(F.col("pos"), F.col("digest")))])
    run = prefix_scan(marked, ["conv_id"], ["pos"], ordinal_bucket("pos"), {n: ("sum", F.col(f"_v{n}")) for n in names})
    own = _node(F.col("pos") + 1, [F.col(n) for n in names])
    up = _node(F.col("pos"), [F.col(n) - F.col(f"_v{n}") for n in names])
    rows = run.select("conv_id", (F.col("pos") + 1).alias("depth"), own.alias("node"), up.alias("parent"), "bytes", (F.col("length") - F.col("pos") - 1).alias("rest"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), _node(zero, [zero] * 4).alias("node"), F.lit(None).cast("binary").alias("parent"),
                         zero.alias("bytes"), F.col("length").alias("rest"))
    return stored(rows.unionByName(roots), "trie-paths")


class Queue:
    """Priority queue of messages (time, node, leaves, saved), smallest (time, node) first. Beyond ``limit`` messages the
    queue writes them as a sorted run to an unnamed temporary file of the task, and merges the runs as it is read."""

    record = struct.Struct(">q16sqq")

    def __init__(self, limit: int = MESSAGES):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        self.heap.sort()
        run = tempfile.TemporaryFile()
        run.writelines(self.record.pack(*m) for m in self.heap)
        run.seek(0)
        self.heap = []
        self.runs.append(run)
        self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        data = self.runs[run].read(self.record.size)
        if data:
            heapq.heappush(self.heads, (self.record.unpack(data), run))
        else:
            self.runs[run].close()

    def take(self, time: int, node: bytes):
        """Remove and yield the messages for a node."""
        while True:
            if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
                if self.heap[0][:2] != (time, node):
                    return
                yield heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][:2] == (time, node):
                message, run = heapq.heappop(self.heads)
                self._advance(run)
                yield message
            else:
                return


_TOTALS = StructType([StructField("node", BinaryType()), StructField("outside", BinaryType()), StructField("n_children", LongType()),
                      StructField("n_leaves", LongType()), StructField("saved_tokens", LongType())])


def _forward(nodes: DataFrame, limit: int, one_task: bool = False) -> DataFrame:
    """Totals of all nodes of all shards: (node, outside, n_children, n_leaves, saved_tokens). ``nodes`` has ``shard`` (the
    id of its topmost node), ``depth, node, parent, up`` (the parent's depth) and what is known at a node before
    anything arrives: ``kids, leaves, saved``. ``outside`` is the parent of a topmost node, null for others.

    Spark sorts the shards externally by reverse level. A task reads them as a stream: a node takes its messages out of
    the queue, adds them to its own and sends the sum to its parent's time. Only the queue is held."""
    def run(batches):
        shard, queue = None, None
        for batch in batches:
            out = []
            for s, depth, node, parent, up, kids, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                if s != shard:
                    shard, queue = s, Queue(limit)
                for _, _, more, kept in queue.take(-depth, node):
                    kids, leaves, saved = kids + 1, leaves + more, saved + kept
                top = node == s
                if not top:
                    queue.push((-up, parent, leaves, saved))
                out.append((node, parent if top else None, kids, leaves, saved))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_TOTALS.names)
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    rows = nodes.select("shard", "depth", "node", "parent", "up", "kids", "leaves", "saved").where("node IS NOT NULL")
    rows = rows.coalesce(1) if one_task else rows.repartition("shard")
    return rows.sortWithinPartitions("shard", F.col("depth").desc(), "node").mapInArrow(run, _TOTALS)


def _mail(totals: DataFrame) -> DataFrame:
    """What topmost nodes pass to their parents, a row per parent."""
    return totals.where("outside IS NOT NULL").groupBy(F.col("outside").alias("node")).agg(
        F.count("*").alias("_kids"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))


def _with_mail(nodes: DataFrame, mail: DataFrame) -> DataFrame:
    j = nodes.join(mail, "node", "left")
    for c in ("kids", "leaves", "saved"):
        j = j.withColumn(c, F.col(c) + F.coalesce(f"_{c}", F.lit(0)))
    return j.drop("_kids", "_leaves", "_saved")


def _salt() -> Column:
    return F.pmod(F.xxhash64("conv_id"), F.lit(SALTS))


def _salted(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def _upper_totals(upper: DataFrame, paths: DataFrame, band: int, limit: int) -> DataFrame:
    """Totals of the nodes that are too heavy for one shard, ``kids, leaves, saved`` holding what the shards below sent.
    They are cut into bands of levels; a shard is what hangs under one node on the first level of a band."""
    first = paths.select("conv_id", F.col("depth").alias("_d"), F.col("node").alias("shard"))
    upper = upper.withColumn("_d", F.col("depth") - F.col("depth") % band)
    upper = stored(upper.join(first, ["conv_id", "_d"]).drop("_d"), "trie-upper")
    totals = stored(_forward(upper, limit), "trie-upper-totals")
    if (upper.agg(F.max("depth")).first()[0] or 0) < band:
        return totals
    # Across the roots of the bands: each is a node whose parent is the root of the shard that its own parent is in.
    roots = totals.join(upper.where("node = shard").select("node", "depth"), "node")
    at = upper.select(F.col("node").alias("outside"), F.col("shard").alias("parent"))
    tree = roots.join(at, "outside", "left").select(
        F.lit(b"").alias("shard"), "depth", "node", F.coalesce("parent", F.lit(b"")).alias("parent"), (F.col("depth") - band).alias("up"),
        F.lit(0).cast("long").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    whole = _forward(tree, limit, one_task=True).select("node", "n_leaves", "saved_tokens")
    sent = roots.select("node", "outside").join(whole, "node")
    return stored(_forward(_with_mail(upper, _mail(sent)), limit), "trie-upper-whole")


def _end_hashes(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end. Runs of ids are joined to texts where a range
    partitioning put them; per node the texts then pass through one digest, as a stream."""
    ends = paths.where("rest = 0").select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def join(batches):
        seq = 0
        for batch in batches:
            part, node, ids = (batch.column(i).to_pylist() for i in (0, 1, 2))
            out, at = [], 0
            while at < len(node):
                end = at + 1
                while end < len(node) and node[end] == node[at] and end - at < IDS:
                    end += 1
                out.append((node[at], part[at], seq, ",".join(map(str, ids[at:end]))))
                seq, at = seq + 1, end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["node", "_p", "_seq", "ids"])

    def digest(batches):
        node, sha, out = None, None, []
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node:
                    if node is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = n, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "ends_sha256"])
                out = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])

    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.string()]
    texts = ends.select(F.spark_partition_id().alias("_p"), "node", "conv_id").mapInArrow(join, "node binary, _p int, _seq long, ids string")
    return (texts.repartition("node").sortWithinPartitions("node", "_p", "_seq").select("node", "ids")
            .mapInArrow(digest, StructType([StructField("node", BinaryType()), StructField("ends_sha256", StringType())])))


def prefix_trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, band: int = BAND, limit: int = MESSAGES) -> DataFrame:
    """The trie of all prefixes of conversations, a row per node: conv_id (its smallest member) and depth, which name the
    node, parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes of its subtree), saved_tokens (over
    its subtree, bytes of a node's last turn times its members but one) and ends_sha256 (of the ids of the members that
    end here, ascending, joined by commas).

    ``turns(conv_id, pos, digest, bytes, length)`` are the turns, ``pos`` gapless from 0 and ``length`` the turns of the
    whole conversation; ``convs(conv_id, length)`` has each conversation once, also those without turns, which are
    members of the root alone. No conversation: no row. Equal conversations share all nodes; turns are equal if their
    digests are. Texts are not looked at, so their length doesn't matter; other columns are not either.

    1. Every prefix is named by position-dependent hashes summed along its conversation (``_paths``); an aggregate over the
       names makes the nodes, so a first turn or a conversation that a third of all share is summed before it is moved.
    2. A node with more than ``shard`` turns after it, copies counted, is in the upper part; what hangs under the others
       is a shard of its own, of that size at most, however the hot ones are shared. Shards are sorted by reverse level
       and processed forward in time, see ``_forward``.
    3. The shards' roots pass their totals up, summed per parent, and the upper part, smaller by about ``shard`` times, is
       processed in the same way (``_upper_totals``), in bands of levels, so that one very long conversation is spread."""
    paths = _paths(turns, convs)
    nodes = stored(paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.max("bytes").alias("bytes"), F.sum("rest").alias("weight")), "trie-nodes")
    work = nodes.select("node", "parent", "conv_id", "depth", (F.col("depth") - 1).alias("up"), F.lit(0).cast("long").alias("kids"),
                        F.when(F.col("weight") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), "weight")
    heavy = work.where(F.col("weight") > shard)
    # The topmost light node on the path of every conversation.
    above = (paths.withColumn("_salt", _salt()).join(_salted(heavy.select("node")), ["node", "_salt"])
             .groupBy("conv_id").agg(F.max("depth").alias("_h")))
    first = convs.select("conv_id").join(above, "conv_id", "left").select("conv_id", (F.coalesce("_h", F.lit(-1)) + 1).alias("depth"))
    tops = paths.join(first, ["conv_id", "depth"]).select(
        "conv_id", F.col("depth").alias("_first"), F.col("node").alias("shard"),
        F.explode(F.sequence(F.floor(F.col("depth") / SPAN), F.floor((F.col("depth") + F.col("rest")) / SPAN))).alias("_span"))
    light = (work.where(F.col("weight") <= shard).withColumn("_span", F.floor(F.col("depth") / SPAN))
             .join(tops, ["conv_id", "_span"]).where("depth >= _first").drop("_span", "_first"))
    below = stored(_forward(light, limit), "trie-shards")
    upper = _upper_totals(_with_mail(heavy, _mail(below)), paths, band, limit)
    totals = below.unionByName(upper)
    # Parents: a light one has few children, a heavy one is met by its children in parts.
    full = nodes.join(totals.drop("outside"), "node").join(_end_hashes(paths), "node", "left")
    tagged = full.join(below.where("outside IS NOT NULL").select("node", F.lit(True).alias("_top")), "node", "left")
    tagged = stored(tagged.withColumn("_top", F.coalesce("_top", F.lit(False)) | (F.col("weight") > shard)), "trie-full")
    names = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "weight")
    inner = tagged.where("NOT _top").join(names.where(F.col("weight") <= shard).drop("weight"), "parent", "left")
    outer = tagged.where("_top").withColumn("_salt", _salt()).join(_salted(names.where(F.col("weight") > shard).drop("weight")), ["parent", "_salt"], "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256")]
    return inner.select(columns).unionByName(outer.select(columns))
