"""Mixing sources to target weights: Efraimidis-Spirakis sampling in DataFrame functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.llm.common import stored

WORDS = r"[^\x20\x09-\x0D]+"
RUN_ROWS = 4096          # rows of one run of the prefix sum
SEED = "mix"


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """Targets of a table (source, source_size): the sources by code point, null last, get the repeating
    ``weights``; they share ``share`` of all sizes; no target goes above ``cap`` times its source, the excess is
    shared again by weight. The end of that resharing in closed form: with the sources in order of size / weight,
    the ones up to some point are at their cap and the others share the rest by weight.

    One row per source passes the two windows without partition, never a row per document."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (sizes.withColumn("w", w.cast("long"))
         .withColumn("all_size", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
         .withColumn("size_to", F.sum("source_size").over(upto) - F.col("source_size"))
         .withColumn("w_to", F.sum("w").over(upto) - F.col("w"))
         # The rate the rest would share by if every source before this one were at its cap.
         .withColumn("rate", (F.lit(share) * F.col("all_size") - cap * F.col("size_to")) / (F.col("all_w") - F.col("w_to")))
         .withColumn("capped", F.col("w") * F.col("rate") >= cap * F.col("source_size"))
         .withColumn("final", F.min(F.when(~F.col("capped"), F.struct(F.col("size_to"), F.col("rate")))).over(everything)))
    # Capped sources come first in this order, so the first open one has the final rate.
    return t.select("source", "source_size", F.when(F.col("capped") | F.col("final").isNull(), (cap * F.col("source_size")).cast("double"))
                    .otherwise(F.col("w") * F.col("final.rate")).alias("target"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """Number in (0, 1) from the id alone: 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def quality(text: Column) -> Column:
    """Quality weight from the text alone: the share of its characters that are letters, to the eighth power. Tables,
    symbol noise and digit dumps fall off steeply against prose. 1 for null and empty texts."""
    other = "".join(chr(c) for c in range(128) if not chr(c).isalpha())
    return F.when(F.length(text) > 0, F.pow(F.length(F.translate(text, other, "")) / F.length(text), F.lit(8.0))).otherwise(1.0)


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weight: str | None = None,
        weights=(3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = SEED) -> DataFrame:
    """``docs`` plus size, source_size, target, taken.

    Every document gets the key ``-ln(u) / weight`` (a small key is early; a larger weight makes it smaller); weight
    is a column, by default the quality of the text. A source takes as many complete epochs as its target holds; what is
    left of the target goes to the documents with the smallest keys, as long as half of the next one still fits. A
    document is taken whole or not, so a source ends within half a document of its target, and nothing is taken more
    than ``cap`` times when ``cap`` is a whole number.

    Null text: size 0, taken 0. Null, non-positive or infinite weight: 1. Null source: its own, last source. Equal
    keys: order by id, size and hash of the text; rows equal in all of these are taken together. Columns named
    like a new one are replaced. Empty input: empty result.

    The texts are read twice and never shuffled. The first pass keeps a narrow row a document; its prefix sums run over
    pieces of about ``RUN_ROWS`` documents of a source by key, summed first, so the largest source is spread over all
    tasks. They end in one row a source, the last key still taken, to which the second pass compares."""
    def measured(df: DataFrame) -> DataFrame:
        wt = F.col(f"`{weight}`").cast("double") if weight else quality(F.col(f"`{text}`"))
        wt = F.when((wt > 0) & (wt < float("inf")), wt).otherwise(1.0)
        return df.withColumns({"_src": F.col(f"`{source}`").cast("string"), "_size": words(F.col(f"`{text}`")), "_id": F.col(f"`{doc_id}`"),
                               "_key": -F.log(uniform(F.col(f"`{doc_id}`"), seed)) / wt, "_hash": F.xxhash64(F.col(f"`{text}`"))})

    rows = stored(measured(docs).select("_src", "_key", "_id", "_size", "_hash"), "mix-keys")
    sizes = rows.groupBy(F.col("_src").alias("source")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("n"))
    sizes = stored(sizes, "mix-sizes")
    plan = (source_targets(sizes.drop("n"), weights, share, cap).withColumnRenamed("source", "s2")
            .join(sizes.select(F.col("source").alias("s3"), "n"), F.col("s2").eqNullSafe(F.col("s3"))).drop("s3")
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap).cast("long"))).otherwise(0).cast("long"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
            .withColumn("pieces", F.ceil(F.col("n") / RUN_ROWS).cast("long")))
    plan = stored(plan, "mix-plan")
    # Pieces by key. Scaled by the mean weight, 1 - exp(-key) is near uniform, so the pieces hold about as many rows each.
    rows = rows.join(plan.select("s2", "pieces", "rest"), F.col("_src").eqNullSafe(F.col("s2"))).drop("s2")
    scale = F.lit(float(rows.agg(F.expr("percentile_approx(_key, 0.5)")).first()[0] or 1.0) or 1.0)
    rows = rows.withColumn("_piece", F.least(F.col("pieces") - 1, F.floor((1 - F.exp(-F.lit(math.log(2)) * F.col("_key") / scale)) * F.col("pieces"))).cast("long"))
    sums = rows.groupBy("_src", "_piece").agg(F.sum("_size").alias("s"))
    before = sums.select(F.col("_src").alias("s4"), F.col("_piece").alias("p4"), (F.sum("s").over(
        Window.partitionBy("_src").orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("s")).alias("before"))
    piece = Window.partitionBy("_src", "_piece").orderBy("_key", "_id", "_size", "_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (rows.withColumn("inside", F.sum("_size").over(piece) - F.col("_size"))
            .join(before, F.col("_src").eqNullSafe(F.col("s4")) & (F.col("_piece") == F.col("p4")))
            .where(F.col("before") + F.col("inside") + F.col("_size") / 2 <= F.col("rest"))
            .groupBy(F.col("_src").alias("s5")).agg(F.max(F.struct("_key", "_id", "_size", "_hash")).alias("last")))
    plan = stored(plan.join(last, F.col("s2").eqNullSafe(F.col("s5")), "left").drop("s5", "n", "pieces", "rest"), "mix-cuts")
    out = measured(docs).join(plan.withColumnsRenamed({"source_size": "_ss", "target": "_t"}), F.col("_src").eqNullSafe(F.col("s2")))
    more = F.col("last").isNotNull() & (F.col("epochs") < cap) & (F.struct("_key", "_id", "_size", "_hash") <= F.col("last"))
    new = {"size": F.col("_size"), "source_size": F.col("_ss"), "target": F.col("_t"),
           "taken": F.col("_size") * (F.col("epochs") + F.when(more, 1).otherwise(0))}
    return out.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in new] + [c.alias(n) for n, c in new.items()])
