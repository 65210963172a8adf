"""Integrity checks across layers, and the repairs that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.base import HANGUL, col, contains_any, let
from .links import first_by_id


def presence_flags(rows: DataFrame, key: str, layers: dict[str, DataFrame]) -> DataFrame:
    """One boolean per layer: does it hold the key?"""
    for name, layer in layers.items():
        ids = layer.select(F.col(layer.columns[0]).alias(key)).distinct().withColumn(name, F.lit(True))
        rows = rows.join(ids, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return rows


def orphans(index: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Index rows whose key is in no base row (complete, no row cap)."""
    return index.join(base.select(key), key, "left_anti")


def duplicate_groups(docs: DataFrame, key: str) -> DataFrame:
    """Every member of a group with more than one row, with the group size. Counts are partial
    aggregates and members stay rows, so a huge group is never collected. Rows without a key are a group."""
    sizes = docs.groupBy(key).agg(F.count("*").alias("group_size")).where("group_size > 1")
    sizes = sizes.withColumnRenamed(key, "_group")
    return docs.join(sizes, docs[key].eqNullSafe(sizes["_group"])).select(key, *[c for c in docs.columns if c != key], "group_size")


def duplicate_report(docs: DataFrame, key: str, expected_id: Column, layers: dict[str, DataFrame]) -> DataFrame:
    """Duplicate members with id check, encoded-address flag, address bytes and layer flags."""
    rows = duplicate_groups(docs, key)
    rows = rows.select("*", (F.col("id") == expected_id).alias("id_match"),
                       F.contains(F.coalesce("url", F.lit("")), F.lit("%")).alias("encoded_url"),
                       F.lower(F.hex(F.encode(F.coalesce("url", F.lit("")), "UTF-8"))).alias("url_hex"))
    return presence_flags(rows, "id", layers)


def key_violations(table: DataFrame, key: list[str]) -> DataFrame:
    return table.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def id_mismatches(rows: DataFrame, expected: Column) -> DataFrame:
    return rows.withColumn("expected_id", expected).where(~F.col("id").eqNullSafe(F.col("expected_id")))


# Path words of list pages.
ARCHIVE_WORDS = ["newsletter", "column-before", "economy-dictionary", "economy-news", "category"]


def is_suspicious_url(url) -> Column:
    """More than one path segment, or a known list word at the start of one."""
    def rule(p):
        segments = F.filter(F.split(p["path"], "/"), lambda s: s != "")
        return p["ok"] & ((F.size(segments) > 1) | contains_any(p["path"], ["/" + w for w in ARCHIVE_WORDS]))
    return F.coalesce(let(U.url_parts(url), rule), F.lit(False))


def is_spa_shell(html) -> Column:
    """Script-rendered page captured without its post body."""
    h = col(html)
    shell = F.contains(h, F.lit('id="main-outlet"')) | F.contains(h, F.lit('id="discourse-comments"'))
    return shell & ~F.contains(h, F.lit('itemprop="text"'))


def id_samples(rows: DataFrame, site: str, expected: Column, done: DataFrame) -> DataFrame:
    """Per site: row count and one sample row with its id check and completed flag."""
    sample = rows.withColumn("_expected", expected).groupBy(F.col(site).alias("site")).agg(
        F.count("*").alias("n"), F.min(F.struct("id", "url", "_expected")).alias("s"))
    flat = sample.select("site", "n", F.col("s.id").alias("id"), F.col("s._expected").alias("expected_id"),
                         (F.col("s.id") == F.col("s._expected")).alias("id_match"))
    return presence_flags(flat, "id", {"completed": done})


# --- repairs ---------------------------------------------------------------------------------------

def clean_errors(rows: DataFrame, pattern: str = "(?i)document not found", error: str = "error") -> DataFrame:
    """Rows whose error text does not match; a missing error is kept."""
    return rows.where(F.col(error).isNull() | ~F.col(error).rlike(pattern))


def split_by_pattern(rows: DataFrame, url: Column, pattern: str, negate: bool = False) -> DataFrame:
    """Add ``removed``: does the address match the purge pattern (or, negated, fail to)?"""
    hit = F.coalesce(url.rlike(pattern), F.lit(False))
    return rows.withColumn("removed", ~hit if negate else hit)


def queue_item_url(payload, site_key: str | None = None) -> Column:
    """Address a purge tests in a queue item: its ``url``, or the whole text when it is not JSON.
    Items of another site are never tested."""
    from ..functions.jsonx import is_json_object, json_field
    p = col(payload)
    own = F.lit(True) if site_key is None else F.coalesce(json_field(p, "$.site") == site_key, F.lit(False))
    return F.when(~is_json_object(p), p).when(own, json_field(p, "$.url"))


def repair_noise_ids(urls: DataFrame, id_rule) -> DataFrame:
    """Replace rows whose id carries Hangul or percent escapes by one clean row per recomputed id,
    unless that id exists. Rows without a usable address stay as they are."""
    flagged = urls.withColumn("_noise", F.coalesce(F.col("id").rlike(HANGUL + "|%"), F.lit(False)))
    flagged = flagged.withColumn("_url", F.when(F.col("_noise"), U.strip_tracking("url")))
    flagged = flagged.withColumn("_clean", F.when(F.col("_noise"), F.nullif(id_rule(F.col("_url")), F.lit(""))))
    kept = flagged.where("_clean IS NULL").select("id", "url", "title", "status")
    moved = flagged.where("_clean IS NOT NULL").select(
        F.col("_clean").alias("id"), F.col("_url").alias("url"), F.col("title"),
        F.col("id").alias("_old"))
    # Several noisy rows may clean to one id: the smallest old id wins.
    fresh = first_by_id(moved, ["_old"], ["id"]).join(kept.select("id"), "id", "left_anti").select(
        "id", "url", F.coalesce("title", F.lit("Recovered Clean Target")).alias("title"), F.lit("new").alias("status"))
    return kept.unionByName(fresh)


def migrate_ids(rows: DataFrame, expected: Column, tie: str) -> DataFrame:
    """``outcome`` per row: ``ok`` (id already right), ``migrated`` (first row of a wrong id whose
    right id is free), ``duplicate`` (dropped), ``skipped`` (no address or id)."""
    e = rows.withColumn("expected_id", F.when(F.coalesce("url", F.lit("")) != "", F.nullif(expected, F.lit(""))))
    right = F.col("id") == F.col("expected_id")
    # One aggregation answers both questions per id: does a row hold it, and who wants it first?
    holds = e.where("id IS NOT NULL").select(F.col("id").alias("expected_id"), F.lit(True).alias("h"),
                                             F.lit(None).cast(e.schema[tie].dataType).alias("w"))
    wants = e.where("expected_id IS NOT NULL AND id IS NOT NULL").where(~right).select(
        "expected_id", F.lit(False).alias("h"), F.col(tie).alias("w"))
    claims = holds.union(wants).groupBy("expected_id").agg(F.max("h").alias("_held"), F.min("w").alias("_first"))
    out = e.join(claims, "expected_id", "left")
    outcome = (F.when(F.col("expected_id").isNull() | F.col("id").isNull(), "skipped").when(right, "ok")
               .when(F.col("_held") | (F.col(tie) != F.col("_first")), "duplicate").otherwise("migrated"))
    return out.withColumn("outcome", outcome).drop("_held", "_first")


def migration_summary(migrated: DataFrame) -> DataFrame:
    return migrated.groupBy("outcome").agg(F.count("*").alias("n"))


def prune_empty(sessions: DataFrame, transcripts: DataFrame, key: str = "session_id") -> DataFrame:
    """Add ``keep``: does a transcript of the session exist?"""
    return presence_flags(sessions, key, {"keep": transcripts.select(key)})
