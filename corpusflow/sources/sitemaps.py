"""Sitemaps: address lists and indexes of other sitemaps, parsed with a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.base import trim_ws
from ..session import cut_lineage

ENTRY = "array<struct<loc:string,lastmod:string>>"
SCHEMA = f"url {ENTRY}, sitemap {ENTRY}, _corrupt_record string"
DEPTH = 10       # rounds over index files; the protocol asks for one


def parse_sitemaps(files: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """``sitemap, kind, loc, lastmod, error`` of sitemap texts: kind ``url`` for an address, ``sitemap`` for the address of
    another sitemap, ``error`` for a text that is no XML or holds neither."""
    doc = F.from_xml(F.col(xml), SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"})
    # The one-element explode keeps the parse from being repeated for each field.
    rows = files.select(F.col(url).alias("sitemap"), F.explode(F.array(doc)).alias("d"))
    tag = lambda name: F.transform(F.coalesce(F.col(f"d.{name}"), F.array().cast(ENTRY)), lambda e: F.struct(
        F.lit(name).alias("kind"), trim_ws(e["loc"]).alias("loc"), trim_ws(e["lastmod"]).alias("lastmod"), F.lit(None).cast("string").alias("error")))
    found = F.filter(F.concat(tag("url"), tag("sitemap")), lambda e: F.coalesce(e["loc"], F.lit("")) != "")
    broken = F.col("d").isNull() | F.col("d._corrupt_record").isNotNull()
    none, reason = F.lit(None).cast("string"), F.when(broken, "not well-formed").otherwise("no entries")
    bad = F.array(F.struct(F.lit("error").alias("kind"), none.alias("loc"), none.alias("lastmod"), reason.alias("error")))
    each = F.when(broken | (F.size(found) == 0), bad).otherwise(found)
    return rows.select("sitemap", F.explode(each).alias("e")).select("sitemap", "e.*")


def sitemap_entries(files: DataFrame, roots: DataFrame, url: str = "url", xml: str = "xml", depth: int = DEPTH) -> DataFrame:
    """``sitemap, loc, lastmod, error``: the addresses listed by the sitemaps of ``roots(url)`` and by all that their indexes
    name, directly or through other indexes, from the captured ``files``. Each sitemap is read once, also where indexes
    name each other. A sitemap that wasn't captured, is broken, or lies deeper than ``depth`` has an error row."""
    parsed = cut_lineage(parse_sitemaps(files.dropDuplicates([url]), url, xml), "sitemaps")
    known = parsed.select("sitemap").distinct()
    seen = cut_lineage(roots.select(F.col("url").alias("sitemap")).distinct(), "sitemap-seen")
    new = seen
    for _ in range(depth):
        named = parsed.where("kind = 'sitemap'").join(new, "sitemap", "left_semi").select(F.col("loc").alias("sitemap")).distinct()
        new = cut_lineage(named.join(seen, "sitemap", "left_anti"), "sitemap-new")
        if new.isEmpty():
            break
        seen = seen.unionByName(new)
    listed = parsed.where("kind <> 'sitemap'").join(seen, "sitemap", "left_semi").select("sitemap", "loc", "lastmod", "error")
    lost = seen.join(known, "sitemap", "left_anti").select("sitemap", *[F.lit(None).cast("string").alias(c) for c in ("loc", "lastmod")], F.lit("not captured").alias("error"))
    deeper = parsed.where("kind = 'sitemap'").join(seen, "sitemap", "left_semi").select(F.col("loc").alias("sitemap")).distinct().join(seen, "sitemap", "left_anti")
    deeper = deeper.select("sitemap", *[F.lit(None).cast("string").alias(c) for c in ("loc", "lastmod")], F.lit("too deep").alias("error"))
    return listed.unionByName(lost).unionByName(deeper)
