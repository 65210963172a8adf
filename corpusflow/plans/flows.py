"""Source, sink and streaming queries. The streams run to the end of the available data and return
what their sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import convo as CO
from ..operators import search as SE
from ..operators.scan import ordinal_bucket
from ..sources import readers as RD
from ..session import cut_lineage, work_path
from ..sources import sinks as SK
from ..streaming import stateful as SF
from ..streaming import streams as ST
from . import domains as DM
from . import stats as SQ
from .registry import query
from .texts import NL, S, C


@query("scan_bronze", "SELECT page_id, url, html FROM pages")
def scan_bronze(t):
    return t.pages.select("page_id", "url", "html")


@query("scan_projected", "SELECT page_id, url FROM pages WHERE url LIKE 'https%'")
def scan_projected(t):
    return t.pages.select("page_id", "url").where(F.startswith("url", F.lit("https")))


@query("src_url_list", "SELECT url FROM pages UNION ALL SELECT url || '/b' FROM pages WHERE url LIKE 'https%'")
def src_url_list(t):
    """Lines with blanks, comments, continuation marks and non-addresses around the page addresses."""
    text = S("# ", F.col("url"), "\n\n  ", F.col("url"), " \\\nftp:x\n", F.when(F.startswith("url", F.lit("https")), S(F.col("url"), "/b")).otherwise(""))
    return RD.url_lines(t.pages.select(F.explode(F.split(text, "\n")).alias("value")), http_only=True)


@query("src_sitemap", "SELECT 'https://y.test/magazine/detail/' || page_id || '/' AS url, CAST(page_id AS VARCHAR) AS id FROM pages")
def src_sitemap(t):
    """Every page listed twice in its own sitemap, next to a foreign entry."""
    loc = S("<url><loc>https://y.test/magazine/detail/", C("page_id"), "/</loc></url>")
    maps = t.pages.select(F.concat(loc, loc, S("<loc>https://other.test/", C("page_id"), "</loc>")).alias("xml"))
    return RD.sitemap_rows(maps, "xml", "y.test")


@query("src_api_nodes", """
SELECT event_id, 0 AS pos, CAST(event_id AS VARCHAR) AS id, 's' || user_id AS slug, event_type AS title FROM events""")
def src_api_nodes(t):
    """Events as captured list pages of both API shapes, with an entry that lacks its slug."""
    nodes = S('[{"id": ', C("event_id"), ', "slug": "s', C("user_id"), '", "title": "', F.col("event_type"), '"}, {"id": 1}]')
    body = F.when(F.col("event_type") == "view", S('{"topic_list": {"topics": ', nodes, "}}")).otherwise(S('{"data": {"posts": {"nodes": ', nodes, "}}}"))
    return RD.api_nodes(t.events.select("event_id", body.alias("j")), ["event_id"], "j")


def _markdown_files(t):
    path = work_path(t.spark, "md")
    t.documents.select("text", F.col("source").alias("book")).write.option("lineSep", "\n").partitionBy("book").text(path)
    return path


@query("src_md_dir", f"SELECT 'book=' || source AS book, CAST(sum(length(text) - length(replace(text, {NL}, '')) + 1) AS BIGINT) AS lines FROM documents GROUP BY 1")
def src_md_dir(t):
    """Documents written as text files per book, read back whole."""
    path = _markdown_files(t)
    df = t.spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    files = RD._file_parts(df.select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("path")))
    return files.groupBy("book").agg(F.sum(F.size(F.split("content", "\n")) - 1).cast("bigint").alias("lines"))


@query("src_recursive_files", "SELECT 'book=' || source AS book, true AS found FROM documents GROUP BY 1")
def src_recursive_files(t):
    path = _markdown_files(t)
    files = RD.list_files(t.spark, [path, path], [".txt"])
    return files.select(F.element_at(F.split("path", "/"), -2).alias("book")).groupBy("book").agg((F.count("*") > 0).alias("found"))


@query("reset_rebuild", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS state, o_orderstatus AS site FROM orders""")
def reset_rebuild(t):
    """A table partitioned by site, one of whose sites is rebuilt."""
    path = work_path(t.spark, "reset")
    rows = t.orders.select("o_orderkey", F.lit("old").alias("state"), F.col("o_orderstatus").alias("site"))
    SK.reset_site(rows, path)
    SK.reset_site(rows.where("site = 'F'").withColumn("state", F.lit("new")), path)
    return t.spark.read.parquet(path)


@query("write_by_date", "SELECT o_orderstatus AS site, CAST(year(o_orderdate) AS VARCHAR) AS year, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month, count(*) AS n FROM orders GROUP BY ALL")
def write_by_date(t):
    path = work_path(t.spark, "dated")
    SK.write_by_date(t.orders.select(F.col("o_orderstatus").alias("site"), "o_orderkey", "o_orderdate").repartition("site"), path, "markdown", "o_orderdate")
    back = t.spark.read.option("inferSchema", "false").schema("o_orderkey bigint, site string, year string, month string").parquet(f"{path}/markdown")
    return back.groupBy("site", "year", "month").agg(F.count("*").alias("n"))


# --- streams -----------------------------------------------------------------------------------------------

def stream_table(t, name):
    """A table of the directory as a file stream, whether it is one file or a folder of files; event times become instants."""
    schema, path = getattr(t, name).schema, f"{t.base}/{name}.parquet"
    if RD.is_folder(t.spark, path):
        return ST.file_stream(t.spark, path, schema, "*")
    return ST.file_stream(t.spark, t.base, schema, f"{name}.parquet")


def _events(t):
    return stream_table(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _run(t, name, stream, mode="append", key=None):
    path = work_path(t.spark, name)
    ST.log_of(stream, path, mode).awaitTermination()
    return ST.read_result(t.spark, path, key)


@query("stream_bronze", "SELECT CAST(page_id AS VARCHAR) AS id, url, md5(html) AS html FROM pages")
def stream_bronze(t):
    path = work_path(t.spark, "bronze")
    rows = stream_table(t, "pages").select(F.lit("uppity").alias("site"), C("page_id").alias("id"), "url", F.col("html").alias("raw_html"),
                                           F.lit("2024-02-01").cast("timestamp").alias("scraped_at"))
    ST.ingest_captures(rows.union(rows), path).awaitTermination()
    out = ST.read_result(t.spark, path, ["site", "id"], ["scraped_at"])
    return out.select("id", "url", F.md5("raw_html").alias("html"))


def _bronze(t):
    return stream_table(t, "pages").select(C("page_id").alias("id"), "url", F.col("html").alias("raw_html"), F.lit(None).cast("string").alias("raw_json"),
                                           F.lit("2024-02-01").cast("timestamp").alias("scraped_at"))


@query("stream_convert", "SELECT CAST(page_id AS VARCHAR) AS id, 'completed' AS status, true AS has_title FROM pages")
def stream_convert(t):
    """Silver and status of every page, converted in micro-batches."""
    path = work_path(t.spark, "convert")
    ST.convert_stream(_bronze(t), "uppity", path).awaitTermination()
    silver = ST.read_result(t.spark, path, ["id"])
    status = SK.current(SK.read_log(t.spark, f"{path}/status"), ["id"], []).select("id", "status")
    return silver.join(status, "id").select("id", "status", (F.col("title") != "").alias("has_title"))


@query("stream_index", r"""SELECT 'docs' AS kind, count(*) AS n FROM documents UNION ALL
SELECT 'terms', count(DISTINCT w) FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents)""")
def stream_index(t):
    """Documents indexed in micro-batches: document count and vocabulary of the result."""
    path = work_path(t.spark, "index")
    none = F.lit(None).cast("string")
    silver = stream_table(t, "documents").select(F.col("source").alias("site"), C("doc_id").alias("id"), F.lit("x").alias("title"), none.alias("geo"),
                                                 F.col("text").alias("content"), none.alias("published_at"), F.lit("2024-02-01").alias("updated_at"))
    ST.index_stream(silver, path, F.lit("2024-02-01")).awaitTermination()
    docs = ST.read_result(t.spark, path, ["id"]).agg(F.count("*").alias("n")).select(F.lit("docs").alias("kind"), "n")
    posts = ST.current_postings(t.spark, path).where("field = 4")
    return docs.union(posts.select("term").distinct().agg(F.count("*")).select(F.lit("terms"), "count(1)"))


def attempts(events):
    """Events as attempts: errors and clicks fail, every purchase error text is permanent."""
    kind = F.col("event_type")
    error = F.when(kind == "click", "HTTP status 404 when fetching").when(kind == "error", "timeout")
    return events.select(F.lit("s").alias("site"), C("user_id").alias("id"), F.col("event_id").alias("ord"), (~kind.isin("error", "click")).alias("ok"), error.alias("error"))


_RETRY = """a AS (SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS id, event_type NOT IN ('error', 'click') AS ok, event_type = 'click' AS permanent FROM events),
 b AS (SELECT *, coalesce(sum(CASE WHEN ok OR permanent THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM a),
 c AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY id, grp ORDER BY ord) AS run FROM b),
 d AS (SELECT ord, id, CAST(CASE WHEN ok THEN 0 ELSE (run - 1) % 3 + 1 END AS INTEGER) AS attempt, ok, permanent FROM c),
 states AS (SELECT ord, id, attempt, CASE WHEN ok THEN 'done' WHEN permanent THEN 'failed_permanent' WHEN attempt >= 3 THEN 'failed' ELSE 'retry' END AS outcome FROM d)"""


@query("retry_state", f"WITH {_RETRY} SELECT * FROM states")
def retry_state(t):
    """Batch twin of the retry stream."""
    return ST.retry_states(attempts(t.events), ordinal_bucket("ord")).select("ord", "id", "attempt", "outcome")


def arriving(t, rows, order, closing=None, parts=3):
    """A table as a stream of several micro-batches along ``order``, one file each; ``closing`` is a last row of its own."""
    path = work_path(t.spark, "arriving")
    low, high = rows.agg(F.min(order), F.max(order)).first()
    step = (high - low) / parts if high is not None else None
    for i in range(parts):
        part = rows if step is None else rows.where((F.col(order) >= F.lit(low + i * step)) & ((F.col(order) < F.lit(low + (i + 1) * step)) if i < parts - 1 else F.lit(True)))
        part.coalesce(1).write.parquet(f"{path}/{i}")
        if step is None:
            break
    if closing is not None:
        closing.select([F.col(c.name).cast(c.dataType).alias(c.name) for c in rows.schema]).coalesce(1).write.parquet(f"{path}/{parts}")
    return ST.file_stream(t.spark, path, rows.schema, files_per_batch=1)


@query("stream_retry", f"WITH {_RETRY} SELECT * FROM states")
def stream_retry(t):
    path = work_path(t.spark, "retry")
    SF.retry_stream(arriving(t, attempts(t.events), "ord"), path).awaitTermination()
    return ST.read_result(t.spark, path).select("ord", "id", "attempt", "outcome")


@query("stream_dead_letters", f"WITH {_RETRY} SELECT ord, id, outcome FROM states WHERE outcome LIKE 'failed%'")
def stream_dead_letters(t):
    """The second output of the retry stream."""
    path = work_path(t.spark, "retry")
    SF.retry_stream(arriving(t, attempts(t.events), "ord"), path).awaitTermination()
    return SK.read_log(t.spark, f"{path}/dead").select("ord", "id", "outcome")


_SILENT = """
WITH b AS (SELECT user_id AS worker, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS nx FROM events)
SELECT worker, us AS silent_since_us FROM b, (SELECT max(us) // 1000 * 1000 - 60000000 AS wm FROM b)
WHERE us + 180000000 <= wm AND (nx IS NULL OR nx - us > 180000000)"""


def _beats(t):
    return t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))


@query("silent_workers", _SILENT)
def silent_workers(t):
    """Events are beats of their user; also a worker that never comes back is found."""
    return SF.silences(_beats(t), "user_id", "ts")


@query("stream_heartbeat", _SILENT)
def stream_heartbeat(t):
    """The same alarms raised by timers, the beats arriving in several micro-batches."""
    beats = arriving(t, _beats(t).withColumn("us", F.unix_micros("ts")), "us")
    return _run(t, "heartbeat", SF.silent_workers(beats, "user_id", "ts"))


@query("stream_task_attach", DM.TASK_ATTACH_SQL)
def stream_task_attach(t):
    """Calls and finish messages as two streams, a line a second; a closing row on both sides ends the wait."""
    st = cut_lineage(DM.steps(t), "steps")
    at = lambda c: F.timestamp_seconds(F.col(c))
    calls = CO.pair_results(st).drop("args").withColumn("task_id", CO.waiting_task()).withColumn("ts", at("line_no"))
    done = CO.finish_messages(st).withColumn("ts", at("done_line"))
    # No nulls in the closing row, and no filter on it in the stream: either would be applied before the watermark sees it.
    end = t.spark.range(1).select(*[F.lit(-1).alias(c) for c in ("session_id", "line_no", "call_no", "done_line")], *[F.lit("").alias(c) for c in ("name", "result", "task_id", "report")],
                                  F.lit("2200-01-01").cast("timestamp").alias("ts"))
    calls, done = arriving(t, cut_lineage(calls, "calls"), "line_no", end), arriving(t, cut_lineage(done, "done"), "done_line", end)
    out = _run(t, "attach", SF.attach_tasks_stream(calls, done, "60 days")).where("session_id >= 0")
    return SF.final_results(out).select("session_id", "line_no", "call_no", "result")


@query("stream_dlq", f"WITH {SQ._ITEMS} SELECT CASE WHEN queue IN ('error', 'view') THEN 'Unknown' ELSE 's' || user_id END AS site, count(*) AS n FROM items GROUP BY 1")
def stream_dlq(t):
    class Streamed:
        events = _events(t)
    return _run(t, "dlq", ST.dead_letter_counts(SQ.queue_items(Streamed)), "update", ["site"])


@query("stream_dedupe", "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_id FROM events) GROUP BY 1")
def stream_dedupe(t):
    """Every event is delivered twice; one copy stays."""
    once = _events(t).select("user_id", "event_id", "ts")
    out = _run(t, "dedupe", ST.dedupe_in_flight(once.union(once), "ts", ["user_id", "event_id"], "60 days"))
    return out.groupBy("user_id").agg(F.count("*").alias("n"))


@query("stream_daily", f"SELECT CAST({SQ._DAY} AS VARCHAR) AS day, event_type AS site, count(*) AS n FROM events GROUP BY ALL")
def stream_daily(t):
    out = _run(t, "daily", ST.daily_view(_events(t), "ts", "event_type"), "update", ["day", "site"])
    return out.select(F.col("day").cast("string").alias("day"), "site", "n")


@query("stream_logs", f"WITH {SQ._LOGS} SELECT level, count(*) AS n FROM parsed GROUP BY 1")
def stream_logs(t):
    class Streamed:
        events = _events(t)
    out = _run(t, "logs", ST.parsed_logs(SQ.log_lines(Streamed), SQ._RUN_TS))
    return out.groupBy("level").agg(F.count("*").alias("n"))


INDEX_SQL = """
SELECT term, count(*) AS n FROM (SELECT CASE WHEN lang = 'fr' THEN 'renewed' ELSE lang END AS term FROM documents UNION ALL SELECT source FROM documents) GROUP BY 1"""


def changed_documents(t):
    """Documents of languages and sources, and the French ones again with another word."""
    def docs(rows, word):
        return rows.select(C("doc_id").alias("id"), F.lit("d").alias("site"), C("doc_id").alias("doc_id"), S(word, " ", F.col("source")).alias("title"))
    return docs(t.documents, F.col("lang")), docs(t.documents.where("lang = 'fr'"), F.lit("renewed"))


@query("index_update", INDEX_SQL)
def index_update(t):
    """An index of languages and sources; the French documents come again with another word."""
    old, new = changed_documents(t)
    path = work_path(t.spark, "index")
    SK.write_index(old, SE.postings(old, fields=["title"]), path)
    target = SK.update_index(t.spark, path, new, SE.postings(new, fields=["title"]))
    return t.spark.read.parquet(f"{target}/postings").groupBy("term").agg(F.count("*").alias("n"))
