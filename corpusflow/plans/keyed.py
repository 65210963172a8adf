"""Queries of tables that are kept up to date: schedules, bucketed tables, summaries, counts of the same pass."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import places as PL
from ..operators import search as SE
from ..operators import sketches as SK
from ..operators import stats as ST
from ..session import work_path
from ..sources import buckets as BK
from ..sources import ingest as IN
from ..streaming import streams as STR
from . import texts as TX
from .discovery import UPSERT_SQL, upsert_rows
from .flows import INDEX_SQL, arriving, changed_documents
from .registry import query
from .stats import INGEST_SQL, funnel_layers


@query("rate_schedule", """
WITH r AS (SELECT event_type AS site, event_id, epoch_us(ts) AS us, CASE event_type WHEN 'view' THEN 3 WHEN 'error' THEN 0 ELSE 180 END * 1000000 AS s,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
 m AS (SELECT *, max(us - i * s) OVER (PARTITION BY site ORDER BY i) + i * s AS allowed FROM r)
SELECT site, event_id, allowed AS allowed_us, (allowed - us) / 1000000.0 AS wait_s FROM m""")
def rate_schedule(t):
    """Events as requests of five sites, one of them without spacing."""
    slack = F.when(F.col("site") == "view", 3).when(F.col("site") == "error", 0).otherwise(180)
    out = ST.rate_schedule(t.events.select(F.col("event_type").alias("site"), "event_id", "ts"), "site", "ts", "event_id", slack)
    return out.select("site", "event_id", F.unix_micros("allowed_at").alias("allowed_us"), "wait_s")


@query("geo_alias_join", TX.GEO_SQL)
def geo_alias_join(t):
    """The country rules with the aliases as a table."""
    aliases = PL.alias_rows(t.spark, G.COUNTRY_ALIASES)
    return PL.standardize_locations(TX.places(t), "loc", aliases).select("c_custkey", "country")


@query("index_buckets", INDEX_SQL)
def index_buckets(t):
    """The index update on a bucketed index: only the buckets of the changed documents are written."""
    old, new = changed_documents(t)
    path = work_path(t.spark, "index")
    BK.create_index(old, SE.postings(old, fields=["title"]), path, 64)
    BK.update_index(t.spark, path, new, SE.postings(new, fields=["title"]))
    return t.spark.read.parquet(f"{path}/postings").groupBy("term").agg(F.count("*").alias("n"))


@query("upsert_buckets", UPSERT_SQL)
def upsert_buckets(t):
    """The keyed upsert on a bucketed table."""
    target, updates = upsert_rows(t)
    path, table = work_path(t.spark, "keyed"), f"customers_{uuid.uuid4().hex[:8]}"
    BK.create_keyed(target, table, f"{path}/first", ["c_custkey"], 16)
    return t.spark.table(BK.upsert_keyed(t.spark, table, updates, path, ["c_custkey"], ["c_name"], ["c_acctbal"]))


@query("funnel_sketch", """
WITH u AS (SELECT source AS site, doc_id AS id FROM documents), h AS (SELECT site, id FROM u JOIN labels ON doc_id = id),
 s AS (SELECT site, id FROM u JOIN labels ON doc_id = id WHERE quality = 1)
SELECT site, count(DISTINCT id) AS urls, (SELECT count(DISTINCT id) FROM h WHERE h.site = u.site) AS html, (SELECT count(DISTINCT id) FROM s WHERE s.site = u.site) AS silver,
  count(DISTINCT id) - (SELECT count(DISTINCT id) FROM h WHERE h.site = u.site) AS urls_not_html FROM u GROUP BY site""")
def funnel_sketch(t):
    """Distinct ids per site and layer from a summary table of sketches, one per site, layer and part of the rows."""
    layers = {k: v for k, v in funnel_layers(t, "doc_id").items() if k != "indexed"}
    path = work_path(t.spark, "sketches")
    for name, rows in layers.items():
        SK.summarize(rows.withColumn("day", F.col("doc_id") % 3), name, "doc_id", "site", "day").write.mode("append").parquet(path)
    return SK.funnel(t.spark.read.parquet(path), list(layers), minus=[("urls", "html")])


@query("ingest_observed", INGEST_SQL)
def ingest_observed(t):
    """Counts of source and kept rows from the pass that writes them."""
    bad = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    path = work_path(t.spark, "ingest")
    IN.ingest(t.orders, lambda rows: rows.join(bad, "o_custkey", "left_anti"), path, 0)
    return IN.ingest_counts(t.spark, path)


@query("stream_ingest_counts", INGEST_SQL)
def stream_ingest_counts(t):
    """The same from a stream of several micro-batches."""
    bad = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    path = work_path(t.spark, "ingest")
    stream = arriving(t, t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    STR.each_batch(stream, f"{path}/_checkpoint", lambda df, i: IN.ingest(df, lambda rows: rows.join(bad, "o_custkey", "left_anti"), path, i)).awaitTermination()
    return IN.ingest_counts(t.spark, path)
