"""Image references of captures, and rewriting of image and resource links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def image_references(docs: DataFrame, keep: list[str], html: str, markdown: str, domain: Column) -> DataFrame:
    """Distinct image addresses of markup and Markdown: ``src``, absolute ``url``, ``action``.

    Actions: ``keep`` (inline data, image proxies), ``favicon`` (dropped), ``download``.
    """
    found = F.array_distinct(F.concat(T.html_images(html), T.markdown_images(markdown)))
    rows = docs.select(*keep, domain.alias("_domain"), F.explode(found).alias("src"))
    s, low = F.col("src"), F.lower("src")
    inline = F.startswith(s, F.lit("data:"))
    url = (F.when(inline | low.rlike("^https?://"), s).when(F.startswith(s, F.lit("//")), F.concat(F.lit("https:"), s))
           .when(F.startswith(s, F.lit("/")), F.concat(F.lit("https://"), "_domain", s))
           .otherwise(F.concat(F.lit("https://"), "_domain", F.lit("/"), s)))
    icon = F.contains(low, F.lit("favicon")) | F.endswith(low, F.lit(".ico"))
    action = F.when(inline, "keep").when(icon, "favicon").when(F.contains(low, F.lit("_next/image")), "keep").otherwise("download")
    return rows.select(*keep, "src", url.alias("url"), action.alias("action"))


def planned_path(site: Column, year: Column, month: Column, doc_id: Column, ordinal: Column, ext: Column) -> Column:
    """Local address a downloaded image gets."""
    return F.concat(F.lit("/"), site, F.lit("/"), year, F.lit("/"), month, F.lit("/images/"), doc_id,
                    F.lit("/img_"), ordinal.cast("string"), ext)


def rewrite_images(docs: DataFrame, key: str, text: str, mapping: DataFrame) -> DataFrame:
    """Replace ``src`` by ``path`` inside each document and add the mapping ``footer``.

    ``mapping`` (``key, src, path``) is grouped per document: its size is the number of images of one
    document, so the collected list is bounded by the document itself.
    """
    pairs = mapping.where("src <> path").groupBy(key).agg(
        F.sort_array(F.collect_set(F.struct(F.col("src").alias("from"), F.col("path").alias("to")))).alias("_pairs"))
    joined = docs.join(pairs, key, "left")
    empty = F.array().cast("array<struct<from:string,to:string>>")
    listed = F.array_join(F.transform("_pairs", lambda p: F.concat(F.lit("- `"), p["from"], F.lit("` -> `"), p["to"], F.lit("`\n"))), "")
    footer = F.when(F.col("_pairs").isNotNull(), F.concat(F.lit("\n\n---\n### Collected Images\n"), listed)).otherwise("")
    return joined.withColumn(text, T.replace_pairs(text, F.coalesce("_pairs", empty))).withColumn("footer", footer).drop("_pairs")


def rewrite_resources(docs: DataFrame, key: str, text: str, resources: DataFrame, ext: str | None = None) -> DataFrame:
    """``(:/id)`` links to ``(images/id.ext)`` for ids of the resource table; others stay."""
    links = docs.select(key, *([ext] if ext else []), F.explode(T.resource_ids(text)).alias("id"))
    known = links.join(resources.select("id"), "id")
    suffix = F.coalesce(F.col(ext), F.lit("png")) if ext else F.lit("png")
    mapping = known.select(key, F.concat(F.lit("(:/"), "id", F.lit(")")).alias("src"),
                           F.concat(F.lit("(images/"), "id", F.lit("."), suffix, F.lit(")")).alias("path"))
    return rewrite_images(docs, key, text, mapping).drop("footer")
