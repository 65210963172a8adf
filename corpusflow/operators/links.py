"""Link discovery: captured pages to new frontier rows.

One plan per run: pages -> anchors -> outcome per link -> one row per new id. The only shuffles are
the aggregation by id and the anti-join against the known ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.base import contains_any, let, trim_ws
from ..functions.text import decode_entities
from ..sites import SiteSpec

# Script, style and comment bodies hold no anchors.
_INVISIBLE = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->"
# Attributes before href are passed whole, so that neither ``data-href`` nor a bracket in quotes counts.
_HREF = r"""(?is)<a(?=\s)(?:[^"'>\s]+|\s(?!href\s*=)|"[^"]*"|'[^']*')*+\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def union_sources(*tables: DataFrame) -> DataFrame:
    """All capture tables as one; a column a table lacks becomes NULL."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def anchors(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per ``a[href]``: the kept page columns, ``pos`` and the decoded ``href``."""
    visible = F.regexp_replace(F.col(html), _INVISIBLE, " ")
    hrefs = F.regexp_extract_all(visible, F.lit(_HREF), F.lit(1))
    keep = keep or [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.posexplode(hrefs).alias("pos", "_raw"))
    href = decode_entities(F.regexp_replace("_raw", r"""^["']|["']\z""", ""))
    return rows.select(*keep, "pos", href.alias("href"))


def outcome_of(href: Column, domain: Column, site: SiteSpec, compat: bool = True) -> Column:
    """Struct ``url, shared, outcome, dst_id`` of one href; each step is bound once with ``let`` and
    the address is split into its parts once."""
    def result(url, shared, why):
        reason = (F.when(why.isNotNull(), why).when(url.isNull(), "domain")
                  .when(F.substring_index(url, "?", 1).rlike(U.BINARY_PATTERN), "binary")
                  .when(~site.passes_filter(url), "filtered"))
        return let(site.id_rule(url), lambda i: F.struct(
            url.alias("url"), shared.alias("shared"),
            F.coalesce(reason, F.when(F.coalesce(i, F.lit("")) == "", "id_null"), F.lit("ok")).alias("outcome"),
            i.alias("dst_id")))

    def place(p):
        """Address on the domain, or the domain address a share link carries."""
        own = U.same_domain(p["host"], domain)
        share = U.shared_target(U.parts_text(p), domain)
        url = F.when(p["ok"] & own, U.strip_parts(p)).when(p["ok"], U.strip_tracking(share))
        return let(F.struct(url.alias("url"), (p["ok"] & ~own).alias("shared"), p["ok"].alias("ok")),
                   lambda a: result(a["url"], a["shared"] & a["url"].isNotNull(),
                                    F.when(~a["ok"], F.lit("protocol"))))

    def refuse(why):
        return result(F.lit(None).cast("string"), F.lit(False), why)

    def judge(h):
        bad = (F.when(href == "", "empty").when(U.is_malformed_href(h, compat), "malformed")
               .when(contains_any(h, site.exclude), "excluded"))
        return let(bad, lambda b: F.when(b.isNotNull(), refuse(b)).otherwise(
            let(U.url_parts(U.absolute_href(h, domain)), place)))
    return let(U.clean_href(href), judge)


def link_outcomes(links: DataFrame, domain: Column, site: SiteSpec, compat: bool = True) -> DataFrame:
    """Add ``url``, ``shared``, ``outcome`` and ``dst_id`` to anchor rows.

    Outcomes: ``empty, malformed, excluded, protocol, domain, binary, filtered, id_null, ok``. The
    one-element explode keeps later filters on ``outcome`` from being expanded below the rule chain.
    """
    rows = links.select("*", F.explode(F.array(outcome_of(F.col("href"), domain, site, compat))).alias("_l"))
    return rows.select(*links.columns, "_l.url", "_l.shared", "_l.outcome", "_l.dst_id")


def known_ids(*id_tables: DataFrame) -> DataFrame:
    """Frontier, queue and completed ids as one distinct column ``dst_id``."""
    out = id_tables[0].toDF("dst_id")
    for t in id_tables[1:]:
        out = out.union(t.toDF("dst_id"))
    return out.where("dst_id IS NOT NULL").distinct()


def first_by_id(links: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """First row per id in a total order; the partial aggregation runs before the shuffle, so an id
    that a third of all links share costs one row per task."""
    keys = keys or ["dst_id"]
    rest = [c for c in links.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return links.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest])


def discover_new(outcomes: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """New ``(dst_id, url)`` rows: accepted links, first occurrence per id, id not known yet."""
    accepted = outcomes.where("outcome = 'ok'").select("dst_id", "url", *order)
    return first_by_id(accepted, order).join(known, "dst_id", "left_anti").select("dst_id", "url")


def link_funnel(outcomes: DataFrame, known: DataFrame) -> DataFrame:
    """One row of counters over all links. Links collapse to (id, outcome) counts first."""
    grouped = outcomes.groupBy("dst_id", "outcome", "shared").agg(F.count("*").alias("n"))
    flagged = grouped.join(known.withColumn("known", F.lit(True)), "dst_id", "left")
    per_id = flagged.groupBy("dst_id", "outcome").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("shared"), F.col("n")).otherwise(0)).alias("n_shared"),
        F.max(F.coalesce("known", F.lit(False))).alias("known"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    is_new = (F.col("outcome") == "ok") & ~F.col("known")
    out = F.col("outcome")
    reached = out.isin("binary", "filtered", "id_null", "ok")
    return per_id.agg(
        total(out != "empty").alias("total_anchors"),
        total(out == "malformed").alias("malformed_skipped"),
        total(out == "excluded").alias("exclude_skipped"),
        total(out == "protocol").alias("protocol_skipped"),
        total(out == "domain").alias("domain_skipped"),
        F.coalesce(F.sum(F.when(reached, F.col("n") - F.col("n_shared"))), F.lit(0)).alias("domain_matched"),
        F.coalesce(F.sum(F.when(reached, F.col("n_shared"))), F.lit(0)).alias("share_extracted"),
        total(out == "binary").alias("binary_skipped"),
        total(out.isin("id_null", "ok")).alias("after_clean"),
        total(out == "id_null").alias("id_null"),
        (total(out == "ok") - F.coalesce(F.sum(F.when(is_new, 1)), F.lit(0))).alias("dedup_skipped"),
        F.coalesce(F.sum(F.when(is_new, 1)), F.lit(0)).alias("new_urls"))


def company_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct company ids found in raw markup under either spelling, with their canonical address."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*/comp(?:any|ay)/[^"]*)"'), F.lit(1))
    clean = F.regexp_replace(F.substring_index(trim_ws(F.col("u")), "?", 1), r"/\z", "")
    rows = pages.select(F.explode(F.array_distinct(found)).alias("u")).select(F.when(
        clean.rlike("^/comp(any|ay)"), F.concat(F.lit("https://www.linkedin.com"), clean)).otherwise(clean).alias("u"))
    return (rows.where(F.col("u").rlike(r"^http.*/comp(any|ay)/"))
            .select(U.company_id("u").alias("company_id")).where("company_id <> ''").distinct()
            .withColumn("url", F.concat(F.lit("https://www.linkedin.com/company/"), "company_id")))
