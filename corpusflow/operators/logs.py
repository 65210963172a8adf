"""Worker log analytics over ``(service, idx, line)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import first_filled, let, match_group, trim_ws
from ..functions.text import strip_ansi

# Bracket words that are levels or marks, not site names; levels that are kept.
NOT_SITES = ["error", "warn", "info", "debug", "recursive"]
LEVELS = ["INFO", "WARN", "ERROR"]
_ERROR_TEXT = r"(?i)\berror\b|stderr|exception|TSError"
_FAILURE_LINE = r"(?i)TSError|error TS|Error:|Exception|^\s*at "


def split_service(line) -> tuple[Column, Column]:
    """Service before the first pipe and the text after it; both NULL without a pipe."""
    at = F.locate("|", F.col(line))
    return (F.when(at > 0, trim_ws(F.substring(F.col(line), F.lit(1), at - 1))),
            F.when(at > 0, trim_ws(F.substring(F.col(line), at + 1, F.length(line)))))


# Fields a worker log record may carry, under either name; the last one is set for broken JSON.
RECORD = ("timestamp string, time string, message string, msg string, level string, site string, url string, error_name string, "
          "error_stack string, stack string, _corrupt_record string")


def _record(c) -> Column:
    """Log record of a JSON text, parsed once; NULL when the text is no JSON object."""
    return let(F.from_json(c, RECORD), lambda r: F.when(r["_corrupt_record"].isNull(), r))


def parse_logs(logs: DataFrame, run_ts: str, line: str = "line", reserved: list[str] = ()) -> DataFrame:
    """``service, idx, ts, level, message, site, url, stack`` of JSON and text lines. Stack lines and
    other levels are dropped; a line without a time gets ``run_ts``. ``reserved`` are the names of the
    services themselves: in brackets they are no site."""
    unknown, none = F.lit("Unknown"), F.lit(None).cast("string")

    def row(ts, level, message, site, url, stack, keep):
        return F.struct(ts.alias("ts"), level.alias("level"), strip_ansi(message).alias("message"), site.alias("site"),
                        url.alias("url"), stack.alias("stack"), keep.alias("keep"))

    def from_record(r):
        message = first_filled(r["message"], r["msg"], F.lit("No message"))
        named = F.when(F.coalesce(r["error_name"], F.lit("")) != "", F.concat(r["error_name"], F.lit(": "), message)).otherwise(message)
        return row(first_filled(r["timestamp"], r["time"], F.lit(run_ts)), F.upper(first_filled(r["level"], F.lit("INFO"))), named,
                   first_filled(r["site"], unknown), F.coalesce(r["url"], F.lit("")), first_filled(r["error_stack"], r["stack"]), F.lit(True))

    def from_text(x):
        level = F.when(x.rlike(_ERROR_TEXT), "ERROR").when(x.rlike(r"(?i)\bwarn\b"), "WARN").otherwise("INFO")
        site = let(match_group(x, r"\[([a-zA-Z0-9_-]+)\]"), lambda b: F.when(b.isNotNull() & ~F.lower(b).isin([*NOT_SITES, *(w.lower() for w in reserved)]), b).otherwise(unknown))
        return row(F.lit(run_ts), level, x, site, F.lit(""), none, (x != "") & ~x.rlike(r"(?i)^at "))

    def parsed(x):
        braces = F.startswith(x, F.lit("{")) & F.endswith(x, F.lit("}"))
        broken = row(F.lit(run_ts), F.lit("INFO"), x, unknown, F.lit(""), none, F.lit(True))
        return F.when(braces, let(_record(x), lambda r: F.when(r.isNull(), broken).otherwise(from_record(r)))).otherwise(from_text(x))
    rows = logs.select("service", "idx", F.explode(F.array(let(trim_ws(line), parsed))).alias("p")).select("service", "idx", "p.*")
    return rows.where(F.col("keep") & F.col("level").isin(LEVELS)).drop("keep")


def filter_logs(rows: DataFrame, level: str = "All", search: str = "") -> DataFrame:
    if level != "All":
        rows = rows.where(F.col("level") == level)
    if search:
        needle = F.lit(search.lower())
        rows = rows.where(F.contains(F.lower("message"), needle) | F.contains(F.lower("site"), needle)
                          | F.contains(F.lower("service"), needle))
    return rows


def log_facets(rows: DataFrame) -> DataFrame:
    """Counts per site and per service in one pass, as ``facet, value, n``."""
    sets = rows.groupingSets([["site"], ["service"]], "site", "service").agg(
        F.count("*").alias("n"), F.grouping("site").alias("_g"))
    return sets.select(F.when(F.col("_g") == 0, "site").otherwise("service").alias("facet"),
                       F.when(F.col("_g") == 0, F.col("site")).otherwise(F.col("service")).alias("value"), "n")


def log_page(rows: DataFrame, site: str = "All", service: str = "All", page: int = 1, size: int = 30) -> DataFrame:
    """One page, newest first, later lines first within one instant."""
    if service != "All":
        rows = rows.where(F.col("service") == service)
    if site != "All":
        rows = rows.where(F.col("site") == site)
    return rows.orderBy(F.col("ts").desc(), F.col("idx").desc(), "service").offset((page - 1) * size).limit(size)


def error_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Failure rows ``service, pattern`` of piped log lines. The pattern of a JSON error is its name
    and the message before the attempt number; stack lines share one pattern."""
    service, content = split_service(line)
    one = F.struct(service.alias("service"), content.alias("content"),
                   F.contains(F.col(line), F.lit('"level":"ERROR"')).alias("json_error"))
    # The one-element explode keeps the filters below from repeating the split.
    rows = lines.select(F.explode(F.array(one)).alias("p")).select("p.*").where("service IS NOT NULL AND content <> ''")
    failed = F.col("json_error") | F.col("content").rlike(_FAILURE_LINE)

    def of_record(r):
        message = first_filled(r["message"], r["msg"], F.lit("No message"))
        return F.when(F.coalesce(r["error_name"], F.lit("")) != "", F.concat(
            r["error_name"], F.lit(": "), trim_ws(F.substring_index(message, "on attempt", 1)))).otherwise(message)
    raw = F.when(F.startswith("content", F.lit("at ")), "Stack Trace Line").otherwise(F.substring("content", 1, 100))
    pattern = F.when(F.col("json_error"), let(_record(F.col("content")), lambda r: F.when(r.isNotNull(), of_record(r)))).otherwise(raw)
    return rows.where(failed).select("service", pattern.alias("pattern"))


def error_summary(lines: DataFrame, line: str = "line") -> DataFrame:
    """Counts per pattern and per service as ``kind, value, n``; unparsable JSON errors only count in
    the total, kind ``total``."""
    rows = error_lines(lines, line)
    sets = rows.groupingSets([["pattern"], ["service"], []], "pattern", "service").agg(
        F.count("*").alias("n"), F.count("pattern").alias("n_parsed"), F.grouping_id().alias("_g"))
    kind = F.when(F.col("_g") == 1, "pattern").when(F.col("_g") == 2, "service").otherwise("total")
    out = sets.select(kind.alias("kind"), F.coalesce("pattern", "service", F.lit("")).alias("value"),
                      F.when(kind == "total", F.col("n")).otherwise(F.col("n_parsed")).alias("n"))
    return out.where("n > 0")
