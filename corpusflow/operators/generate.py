"""Work generation: search addresses, listing pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import first_filled
from ..sites import site

SEARCH_BASE = "https://www.linkedin.com/jobs/search/?"
PAGE_STEP = 25


def _as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value] if value else [None]


def _registry(c: Column, names: dict) -> Column:
    """Registry value of a name, the name itself when it is not listed."""
    if not names:
        return c
    return F.coalesce(F.element_at(F.create_map(*[F.lit(str(x)) for kv in names.items() for x in kv]), c), c)


def search_urls(targets: DataFrame, geo_registry: dict, parameter_registry: dict, settings: dict) -> DataFrame:
    """Search addresses of the enabled targets (``keywords, location, geo_id, enabled, start,
    max_page``): keywords x ages x sort orders x distances x pages, expanded row by row from the
    configured lists, so no join is involved."""
    def values(name):
        known = parameter_registry.get(name, {})
        return F.array(*[F.lit(known.get(v, v)).cast("string") for v in _as_list(settings.get(name))])

    pages = F.greatest(F.coalesce(F.col("max_page"), F.lit(settings.get("max_page") or 1)), F.lit(1))
    rows = (targets.where("coalesce(enabled, true)").withColumn("keyword", F.explode("keywords"))
            .withColumn("age", F.explode(values("f_TPR"))).withColumn("sort", F.explode(values("sortBy")))
            .withColumn("distance", F.explode(F.array(*[F.lit(v).cast("string") for v in _as_list(settings.get("distance"))])))
            .withColumn("page", F.explode(F.sequence(F.lit(0), pages - 1))))
    geo = F.element_at(F.create_map(*[F.lit(str(x)) for kv in geo_registry.items() for x in kv]), F.col("location")) \
        if geo_registry else F.lit(None).cast("string")
    param = lambda name, value: F.concat(F.lit(name + "="), F.url_encode(value))
    explicit = F.coalesce(F.col("start"), F.lit(settings.get("start")).cast("int"))
    start = F.when(F.col("page") > 0, F.col("page") * PAGE_STEP).when(explicit > 0, explicit)
    spelling = settings.get("spellCorrectionEnabled")
    parts = F.array(
        param("keywords", F.col("keyword")),
        F.coalesce(param("geoId", geo), param("geoId", F.nullif("geo_id", F.lit(""))),
                   param("location", F.nullif("location", F.lit("")))),
        param("distance", F.col("distance")),
        F.when(~F.coalesce("age", F.lit("")).isin("", "any time"), param("f_TPR", F.col("age"))),
        param("sortBy", F.nullif("sort", F.lit(""))),
        F.lit(None if spelling is None else f"spellCorrectionEnabled={str(spelling).lower()}").cast("string"),
        F.concat(F.lit("start="), start.cast("string")))
    return rows.select(F.concat(F.lit(SEARCH_BASE), F.array_join(F.array_compact(parts), "&")).alias("url"))


def with_direct_urls(urls: DataFrame, direct: DataFrame, skip_direct: bool = False) -> DataFrame:
    """Generated addresses followed by the trimmed direct ones, with ``origin`` 0 or 1 as order."""
    out = urls.select("url", F.lit(0).alias("origin"))
    if skip_direct:
        return out
    return out.unionByName(direct.select(F.trim("url").alias("url"), F.lit(1).alias("origin")).where("url <> ''"))


def page_urls(pages: DataFrame, site_keys: list[str], page: str = "page") -> DataFrame:
    """Listing addresses of a ``page`` column for several sites."""
    each = [pages.select("*", F.lit(k).alias("site"), F.explode(site(k).page_urls(F.col(page))).alias("url"))
            for k in site_keys]
    return reduce(DataFrame.unionByName, each)


def seed_rows(site_keys: list[str], session) -> DataFrame:
    """Configured seed addresses (a handful per site) as frontier candidates."""
    rows = [(k, u) for k in site_keys for u in site(k).seed_urls]
    seeds = session.createDataFrame(rows, "site string, url string")
    ids = reduce(lambda acc, k: F.when(F.col("site") == k, site(k).id_rule(F.col("url"))).otherwise(acc),
                 site_keys, F.lit(None).cast("string"))
    title = first_filled(F.element_at(F.filter(F.split("url", "/"), lambda s: s != ""), -1), F.lit("Seed URL"))
    return seeds.select("site", ids.alias("id"), "url", title.alias("title"))
