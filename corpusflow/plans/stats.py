"""Statistics, log, queue and progress queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logs as LG
from ..operators import stats as ST
from ..operators.scan import ordinal_bucket
from .registry import query

START, END = "2024-01-03", "2024-02-03"
TYPES = ["click", "error", "purchase", "signup", "view"]


def docs_by_event(t):
    """Events stand in for documents: type = site, time = collected."""
    return t.events.select(F.col("event_type").alias("site"), "ts")


def _counts(t):
    return ST.daily_counts(docs_by_event(t), START, END, "ts")


_DAY = "CAST(ts + INTERVAL 9 HOUR AS DATE)"
_COUNTS = f"""c AS (SELECT {_DAY} AS day, event_type AS site, count(*) AS n FROM events
  WHERE {_DAY} BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL),
 spine AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 DAY)) AS DATE) AS day)"""
_PIVOT = "p AS (SELECT spine.day AS day, " + ", ".join(
    f"CAST(coalesce(sum(n) FILTER (site = '{s}'), 0) AS BIGINT) AS {s}" for s in TYPES) + """,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM spine LEFT JOIN c ON spine.day = c.day GROUP BY spine.day)"""


@query("kst_day", f"SELECT event_id, CAST({_DAY} AS VARCHAR) AS day FROM events")
def kst_day(t):
    from ..functions.dates import kst_day as day
    return t.events.select("event_id", day("ts").cast("string").alias("day"))


@query("daily_counts", f"WITH {_COUNTS} SELECT CAST(day AS VARCHAR) AS day, site, n FROM c")
def daily_counts(t):
    return _counts(t).withColumn("day", F.col("day").cast("string"))


@query("daily_spine", f"""WITH {_COUNTS}
SELECT CAST(spine.day AS VARCHAR) AS day, site, coalesce(n, 0) AS n FROM spine LEFT JOIN c ON spine.day = c.day""")
def daily_spine(t):
    return ST.with_spine(_counts(t), START, END).withColumn("day", F.col("day").cast("string"))


@query("daily_pivot", f"WITH {_COUNTS}, {_PIVOT} SELECT CAST(day AS VARCHAR) AS day, * EXCLUDE (day) FROM p")
def daily_pivot(t):
    return ST.daily_pivot(_counts(t), TYPES, START, END).withColumn("day", F.col("day").cast("string"))


_CELL = lambda s: f"CASE WHEN {s} > 0 THEN '**' || {s} || '**' ELSE '0' END"


@query("stats_markdown", f"""WITH {_COUNTS}, {_PIVOT}
SELECT CAST(day AS VARCHAR) AS ord, '| ' || day || ' | ' || {" || ' | ' || ".join(_CELL(s) for s in TYPES)} || ' | **' || total || '** |' AS line FROM p
UNION ALL SELECT '!0', '| Date | {' | '.join(TYPES)} | Total |'
UNION ALL SELECT '!1', '| :--- | {' | '.join([':---:'] * len(TYPES))} | :---: |'""")
def stats_markdown(t):
    return ST.markdown_report(ST.daily_pivot(_counts(t), TYPES, START, END), TYPES)


@query("stats_summary", f"""WITH {_COUNTS}, d AS (SELECT day, sum(n) AS total FROM c GROUP BY day)
SELECT CAST((SELECT max(total) FROM d) AS BIGINT) AS max_daily, (SELECT string_agg(DISTINCT site, ',' ORDER BY site) FROM c) AS sites,
       'all' AS part
UNION ALL SELECT CAST((SELECT max(total) FROM (SELECT sum(n) total FROM c WHERE contains(site, 'i') GROUP BY day)) AS BIGINT),
  (SELECT string_agg(DISTINCT site, ',' ORDER BY site) FROM c WHERE contains(site, 'i')), 'i'
UNION ALL SELECT 10, '', 'none'""")
def stats_summary(t):
    c = _counts(t)
    each = [ST.stats_summary(c, part).select("max_daily", F.array_join("sites", ",").alias("sites"), F.lit(name).alias("part"))
            for part, name in ((None, "all"), ("i", "i"), ("no-such-site", "none"))]
    return each[0].union(each[1]).union(each[2])


FUNNEL_SQL = """
WITH l AS (SELECT source AS site, 'urls' AS layer FROM documents
 UNION ALL SELECT d.source, 'html' FROM documents d JOIN labels USING (doc_id)
 UNION ALL SELECT d.source, 'silver' FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1
 UNION ALL SELECT d.source, 'indexed' FROM documents d JOIN benchmark b ON d.doc_id = b.item_id)
SELECT site, count(*) FILTER (layer = 'urls') AS urls, count(*) FILTER (layer = 'html') AS html,
       count(*) FILTER (layer = 'silver') AS silver, count(*) FILTER (layer = 'indexed') AS indexed FROM l GROUP BY site"""


def funnel_layers(t, *columns):
    """Documents, those with a label, those of good quality and those of the benchmark as layers of a site."""
    d = t.documents.select("doc_id", F.col("source").alias("site"))
    labelled = d.join(t.labels, "doc_id")
    layers = {"urls": d, "html": labelled, "silver": labelled.where("quality = 1"),
              "indexed": d.join(t.benchmark.select(F.col("item_id").alias("doc_id")), "doc_id")}
    return {k: v.select("site", *columns) for k, v in layers.items()}


@query("site_funnel", FUNNEL_SQL)
def site_funnel(t):
    return ST.site_funnel(funnel_layers(t))


def queue_items(t):
    """Events as queue items: type = queue, payload JSON with a site for most, broken text for some."""
    payload = (F.when(F.col("event_type") == "error", F.concat(F.lit("https://raw/"), "event_id"))
               .when(F.col("event_type") == "view", F.concat(F.lit('{"id": '), "event_id", F.lit("}")))
               .otherwise(F.concat(F.lit('{"site": "s'), "user_id", F.lit('", "url": "https://u/'), "event_id", F.lit('"}'))))
    return t.events.select(F.col("event_type").alias("queue"), "event_id", "user_id", payload.alias("payload"), "ts")


_ITEMS = """items AS (SELECT event_type AS queue, event_id, user_id, CASE event_type WHEN 'error' THEN 'https://raw/' || event_id
  WHEN 'view' THEN '{"id": ' || event_id || '}' ELSE '{"site": "s' || user_id || '", "url": "https://u/' || event_id || '"}' END AS payload, ts FROM events)"""


@query("queue_counts", f"""WITH {_ITEMS} SELECT queue, CASE WHEN queue IN ('error', 'view') THEN 'Unknown' ELSE 's' || user_id END AS site,
 count(*) AS n FROM items GROUP BY ALL""")
def queue_counts(t):
    return ST.queue_counts(queue_items(t))


@query("queue_peek", f"""WITH {_ITEMS}, r AS (SELECT queue, payload, row_number() OVER (PARTITION BY queue ORDER BY event_id) AS rank FROM items)
SELECT * FROM r WHERE rank <= 20""")
def queue_peek(t):
    return ST.queue_peek(queue_items(t), 20, "queue", ["event_id"]).select("queue", "payload", "rank")


@query("queue_dump", f"""WITH {_ITEMS} SELECT queue, CAST(floor(event_id / 1000) AS BIGINT) AS part, count(*) AS items,
 '[' || string_agg(CASE WHEN queue = 'error' THEN '{{"raw":"' || payload || '"}}' ELSE payload END, ',' ORDER BY event_id) || ']' AS json FROM items GROUP BY 1, 2""")
def queue_dump(t):
    return ST.queue_dump(queue_items(t), "queue", "payload", ["event_id"])


@query("queue_deltas", """
WITH s AS (SELECT event_type AS queue, date_trunc('hour', ts) AS poll, count(*) AS n FROM events GROUP BY ALL)
SELECT queue, strftime(poll, '%Y-%m-%d %H') AS poll, n, n - lag(n) OVER (PARTITION BY queue ORDER BY s.poll) AS delta FROM s""")
def queue_deltas(t):
    snap = t.events.groupBy(F.col("event_type").alias("queue"), F.date_trunc("hour", "ts").alias("poll")).agg(F.count("*").alias("n"))
    out = ST.snapshot_deltas(snap, "poll", "queue", "n")
    return out.withColumn("poll", F.date_format("poll", "yyyy-MM-dd HH"))


# --- logs ---------------------------------------------------------------------------------------------

def log_lines(t):
    """Events as worker log lines: JSON errors, debug and info records, bracketed text, stack lines,
    broken JSON."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    e, kind = F.col("event_id").cast("string"), F.col("event_type")
    error = F.concat(F.lit('{"timestamp":"'), stamp, F.lit('","level":"ERROR","error_name":"E'), "user_id",
                     F.lit('","message":"failed '), "user_id", F.lit(" on attempt "), e, F.lit('","site":"s'), "user_id", F.lit('"}'))
    view = F.concat(F.lit('{"time":"'), stamp, F.lit('","level":"'), F.when(F.col("value") < 20, "debug").otherwise("info"),
                    F.lit('","msg":"seen \\u001b[90mgrey"}'))
    click = F.concat(F.lit("  [site-"), "user_id", F.lit("] warn slow page "), e)
    purchase = F.concat(F.lit("[fetcher] TSError near line "), "user_id")
    signup = F.when(F.col("value") < 20, F.lit("   at run (worker:1)")).otherwise(F.concat(F.lit("{broken "), e, F.lit("}")))
    line = (F.when(kind == "error", error).when(kind == "view", view).when(kind == "click", click)
            .when(kind == "purchase", purchase).otherwise(signup))
    events = t.spread("events") if hasattr(t, "spread") else t.events
    return events.select(F.concat(F.lit("w"), F.substring(kind, 1, 1)).alias("service"), F.col("event_id").alias("idx"), line.alias("line"))


_LOGS = r"""lines AS (SELECT 'w' || substr(event_type, 1, 1) AS service, event_id AS idx, event_type, user_id, value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp,
  CASE event_type WHEN 'error' THEN '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '","level":"ERROR","error_name":"E' || user_id || '","message":"failed ' || user_id || ' on attempt ' || event_id || '","site":"s' || user_id || '"}'
   WHEN 'view' THEN '{"time":"..","level":"x"}' WHEN 'click' THEN '[site-' || user_id || '] warn slow page ' || event_id
   WHEN 'purchase' THEN '[fetcher] TSError near line ' || user_id
   ELSE CASE WHEN value < 20 THEN 'at run (worker:1)' ELSE '{broken ' || event_id || '}' END END AS line FROM events),
 parsed AS (SELECT service, idx, CASE WHEN event_type IN ('error', 'view') THEN stamp ELSE '2024-02-01T00:00:00.000Z' END AS ts,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' WHEN 'purchase' THEN 'ERROR' ELSE 'INFO' END AS level,
  CASE event_type WHEN 'error' THEN 'E' || user_id || ': failed ' || user_id || ' on attempt ' || idx WHEN 'view' THEN 'seen grey' ELSE line END AS message,
  CASE event_type WHEN 'error' THEN 's' || user_id WHEN 'click' THEN 'site-' || user_id ELSE 'Unknown' END AS site
  FROM lines WHERE NOT (event_type = 'view' AND value < 20) AND NOT (event_type = 'signup' AND value < 20))"""
_RUN_TS = "2024-02-01T00:00:00.000Z"


@query("log_parse", f"WITH {_LOGS} SELECT *, '' AS url FROM parsed")
def log_parse(t):
    return LG.parse_logs(log_lines(t), _RUN_TS, reserved=["fetcher"]).drop("stack")


@query("log_facets", f"""WITH {_LOGS}, f AS (SELECT * FROM parsed WHERE level = 'WARN' AND contains(lower(message), 'page 1'))
SELECT 'site' AS facet, site AS value, count(*) AS n FROM f GROUP BY 2
UNION ALL SELECT 'service', service, count(*) FROM f GROUP BY 2""")
def log_facets(t):
    rows = LG.parse_logs(log_lines(t), _RUN_TS, reserved=["fetcher"])
    return LG.log_facets(LG.filter_logs(rows, "WARN", "PAGE 1"))


@query("log_page", f"""WITH {_LOGS}, f AS (SELECT * FROM parsed WHERE level = 'ERROR' AND (contains(lower(message), 'failed 1') OR contains(lower(site), 'failed 1') OR contains(lower(service), 'failed 1')))
SELECT service, idx, ts, level, message, site FROM f WHERE service = 'we' ORDER BY ts DESC, idx DESC LIMIT 30 OFFSET 30""")
def log_page(t):
    rows = LG.filter_logs(LG.parse_logs(log_lines(t), _RUN_TS, reserved=["fetcher"]), "ERROR", "FAILED 1")
    return LG.log_page(rows, service="we", page=2).drop("url", "stack")


def _piped(t):
    return log_lines(t).select(F.concat("service", F.lit(" | "), "line").alias("line"))


@query("log_service", f"""WITH {_LOGS} SELECT service, event_type <> 'view' AND line = content AS same, count(*) AS n
FROM (SELECT *, line AS content FROM lines) GROUP BY ALL""")
def log_service(t):
    """Service and content of piped lines, compared with the line that was piped."""
    service, content = LG.split_service("piped")
    rows = log_lines(t).withColumn("piped", F.concat("service", F.lit(" | "), "line"))
    same = (F.col("service") != "wv") & (content == F.trim("line"))
    return rows.select(service.alias("service"), same.alias("same")).groupBy("service", "same").agg(F.count("*").alias("n"))


@query("error_summary", f"""WITH {_LOGS}, b AS (SELECT service, CASE event_type WHEN 'error' THEN 'E' || user_id || ': failed ' || user_id
   WHEN 'purchase' THEN substr(line, 1, 100) ELSE 'Stack Trace Line' END AS pattern
  FROM lines WHERE event_type IN ('error', 'purchase') OR (event_type = 'signup' AND value < 20))
SELECT 'pattern' AS kind, pattern AS value, count(*) AS n FROM b GROUP BY 2 UNION ALL SELECT 'service', service, count(*) FROM b GROUP BY 2
UNION ALL SELECT 'total', '', count(*) FROM b""")
def error_summary(t):
    return LG.error_summary(_piped(t))


# --- progress and gaps ----------------------------------------------------------------------------------

@query("progress_eta", """
WITH b AS (SELECT *, epoch_us(ts) AS us, row_number() OVER w AS done, min(epoch_us(ts)) OVER w AS t0, count(*) OVER (PARTITION BY event_type) AS total
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
 e AS (SELECT *, CAST(floor((us - t0) / 1000000) AS BIGINT) AS elapsed_s FROM b)
SELECT event_type, event_id, done, total, elapsed_s, CASE WHEN done > 1 THEN CAST(floor(elapsed_s / (done - 1) * (total - (done - 1))) AS BIGINT) END AS left_s FROM e""")
def progress_eta(t):
    """Each event type is one run; its events are the completions."""
    total = t.events.groupBy("event_type").agg(F.count("*").alias("total"))
    rows = t.events.select("event_type", "event_id", "ts").join(total, "event_type")
    from ..operators.scan import time_bucket
    return ST.progress(rows, ["event_type"], ["ts", "event_id"], "ts", "total", time_bucket("ts", "day")).drop("ts")


@query("rate_violations", """
WITH g AS (SELECT event_type AS site, event_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id)) / 1000000.0 AS gap_s FROM events)
SELECT site, event_id, round(gap_s, 3) AS gap_s FROM g WHERE gap_s < CASE site WHEN 'view' THEN 60 ELSE 180 END""")
def rate_violations(t):
    rows = t.events.select(F.col("event_type").alias("site"), "event_id", "ts")
    slack = F.when(F.col("site") == "view", 60).otherwise(180)
    return ST.rate_violations(rows, "site", "ts", "event_id", slack).select("site", "event_id", F.round("gap_s", 3).alias("gap_s"))


@query("heartbeat_gaps", """
WITH g AS (SELECT user_id, event_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1000000.0 AS gap_s FROM events)
SELECT user_id, event_id, round(gap_s, 3) AS gap_s FROM g WHERE gap_s > 180""")
def heartbeat_gaps(t):
    out = ST.heartbeat_gaps(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")
    return out.select("user_id", "event_id", F.round("gap_s", 3).alias("gap_s"))


@query("capture_change", """
WITH g AS (SELECT user_id, event_id, value AS size, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS size_before FROM events)
SELECT * FROM g WHERE size_before > 0 AND abs(size - size_before) / size_before > 0.15""")
def capture_change(t):
    """Event values as capture sizes of one address per user."""
    rows = t.events.select("user_id", "event_id", F.col("value").alias("size"))
    return ST.capture_changes(rows, "user_id", ["event_id"], "size", ordinal_bucket("event_id"))


INGEST_SQL = """
SELECT count(*) AS original, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS new FROM orders"""


@query("ingest_counts", INGEST_SQL)
def ingest_counts(t):
    kept = t.orders.join(t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    return ST.ingest_counts(t.orders, kept)
