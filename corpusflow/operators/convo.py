"""Agent sessions: step logs to messages, turns, tool calls, tasks, transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.base import col, contains_any, first_filled, let, match_group, trim_ws
from .scan import ordinal_bucket, prefix_scan

CALL = "struct<name:string,tool:string,args:string,arguments:string,input:string>"
STEP = f"type string, source string, content string, tool_calls array<{CALL}>"
TASK_ID = r"(task-\d+)"


def parse_steps(lines: DataFrame, line: str = "line") -> DataFrame:
    """Typed step rows of JSON lines; malformed and blank lines are dropped."""
    no_calls = F.array().cast(f"array<{CALL}>")

    def typed(x):
        calls = F.transform(F.coalesce(x["tool_calls"], no_calls), lambda c: F.struct(
            first_filled(c["name"], c["tool"], F.lit("unknown")).alias("name"),
            F.coalesce(c["args"], c["arguments"], c["input"], F.lit("{}")).alias("args")))
        return F.when(x["_corrupt_record"].isNull(), F.struct(
            x["type"].alias("type"), x["source"].alias("source"), F.coalesce(x["content"], F.lit("")).alias("content"), calls.alias("tool_calls")))
    keep = [c for c in lines.columns if c != line]
    # One parse per line; the one-element explode keeps the filter from adding a second one.
    rows = lines.select(*keep, F.explode(F.array(let(F.from_json(F.col(line), STEP + ", _corrupt_record string"), typed))).alias("_s"))
    return rows.where("_s IS NOT NULL").select(*keep, "_s.*")


def step_kind() -> Column:
    """``user``, ``assistant``, ``system`` or ``result`` of a step row."""
    return (F.when(F.col("type") == "USER_INPUT", "user").when(F.col("type") == "PLANNER_RESPONSE", "assistant")
            .when((F.col("type") == "SYSTEM_MESSAGE") | (F.col("source") == "SYSTEM"), "system").otherwise("result"))


def messages(steps: DataFrame) -> DataFrame:
    """User and assistant messages with their position ``step`` inside the session."""
    rows = steps.withColumn("kind", step_kind()).where(F.col("kind").isin("user", "assistant"))
    num = prefix_scan(rows, ["session_id"], ["line_no"], ordinal_bucket("line_no"), {"step": ("sum", F.lit(1))})
    return num.select("session_id", "line_no", (F.col("step") - 1).alias("step"), F.col("kind").alias("role"), "content", "tool_calls")


def pair_results(steps: DataFrame) -> DataFrame:
    """One row per tool call with its result: the k-th result after an assistant step answers its
    k-th call; a user message closes the step, surplus results are dropped."""
    rows = steps.withColumn("kind", step_kind())
    b = ordinal_bucket("line_no")
    n = prefix_scan(rows, ["session_id"], ["line_no"], b, {"_n": ("sum", F.when(F.col("kind") == "result", 1).otherwise(0))})
    opened = F.when(F.col("kind") == "assistant", F.struct("line_no", "_n")).when(
        F.col("kind") == "user", F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.col("_n")))
    placed = prefix_scan(n, ["session_id"], ["line_no"], b, {"_a": ("last", opened)})
    results = placed.where("kind = 'result' AND _a.line_no >= 0").select(
        "session_id", F.col("_a.line_no").alias("line_no"), (F.col("_n") - F.col("_a._n")).cast("bigint").alias("call_no"), F.col("content").alias("result"))
    calls = rows.where("kind = 'assistant'").select("session_id", "line_no", F.posexplode("tool_calls").alias("p", "c"))
    calls = calls.select("session_id", F.col("line_no").cast("bigint").alias("line_no"), (F.col("p") + 1).cast("bigint").alias("call_no"), "c.name", "c.args")
    return calls.join(results, ["session_id", "line_no", "call_no"], "left")


def finish_messages(steps: DataFrame) -> DataFrame:
    """Finish messages of background tasks: ``session_id, done_line, task_id, report``."""
    done = steps.withColumn("kind", step_kind()).where("kind = 'system'").select(
        "session_id", F.col("line_no").alias("done_line"), match_group("content", TASK_ID).alias("task_id"),
        match_group("content", r"finished with result:([\s\S]*)").alias("report"))
    return done.where("task_id IS NOT NULL AND report IS NOT NULL")


def waiting_task() -> Column:
    """Background task that a call's result names."""
    return F.when(F.col("name") == "run_command", match_group("result", TASK_ID))


def attach_tasks(calls: DataFrame, steps: DataFrame) -> DataFrame:
    """Results of background commands replaced by what their finish message reports: the last finish
    message of the task named in the result, if it comes after the call."""
    done = finish_messages(steps).groupBy("session_id", "task_id").agg(F.max(F.struct("done_line", "report")).alias("d"))
    joined = calls.withColumn("task_id", waiting_task()).join(done, ["session_id", "task_id"], "left")
    finished = F.concat(F.lit("[Background Task "), "task_id", F.lit(" finished]\n"), trim_ws("d.report"))
    result = F.when(F.col("d.done_line") > F.col("line_no"), finished).otherwise(F.col("result"))
    return joined.select(*[c for c in calls.columns if c != "result"], "task_id", result.alias("result"))


def task_states(results: DataFrame, order: str) -> DataFrame:
    """Latest state per task from command results: launched (command, log) then finished."""
    r = F.col("result")
    launched = results.select("session_id", F.col(order).alias("o"), trim_ws(match_group(r, r"task id: ([^\n]+)")).alias("task_id"),
                              F.coalesce(trim_ws(match_group(r, r"Task Description: ([^\n]+)")), F.lit("Unknown")).alias("command"),
                              F.coalesce(trim_ws(match_group(r, r"Task logs are available at: ([^\n]+)")), F.lit("N/A")).alias("log"))
    ended = results.select("session_id", F.col(order).alias("o"), match_group(r, r'Task id "([^"]+)" finished with result').alias("task_id"))
    start = launched.where("task_id IS NOT NULL").groupBy("session_id", "task_id").agg(F.max(F.struct("o", "command", "log")).alias("s"))
    stop = ended.where("task_id IS NOT NULL").groupBy("session_id", "task_id").agg(F.max("o").alias("stop"))
    done = F.coalesce(F.col("stop") > F.col("s.o"), F.lit(False))
    return start.join(stop, ["session_id", "task_id"], "left").select(
        "session_id", "task_id", "s.command", F.col("s.o").alias("started"), F.when(done, "Completed").otherwise("Running").alias("status"), "s.log")


def turns(msgs: DataFrame) -> DataFrame:
    """Turns of a session: a user message opens one, the last assistant message before the next user
    answers it. Assistant messages before any user belong to a turn with user ``N/A``."""
    rows = msgs.where(F.col("role").isin("user", "assistant"))
    is_user = F.col("role") == "user"
    t = prefix_scan(rows, ["session_id"], ["step"], ordinal_bucket("step"), {"turn": ("sum", F.when(is_user, 1).otherwise(0))})
    answer = F.max(F.when(~is_user, F.struct("step", "content", *[c for c in ("tool_calls",) if c in msgs.columns])))
    g = t.groupBy("session_id", "turn").agg(
        F.max(F.when(is_user, F.struct("step", "content"))).alias("u"), answer.alias("a"), F.min("step").alias("first_step"))
    extra = [F.col("a.tool_calls").alias("tool_calls")] if "tool_calls" in msgs.columns else []
    return g.select("session_id", "turn", F.coalesce("u.step", F.col("first_step") - 1).alias("user_step"),
                    F.coalesce(trim_ws("u.content"), F.lit("N/A")).alias("request"),
                    F.coalesce(trim_ws("a.content"), F.lit("N/A")).alias("answer"), *extra)


# Category of a turn by the files it touched, in order of precedence.
CATEGORY_RULES = [("Doc/Rules", "#doc #rules", [".agents", "AGENTS.md"]), ("Crawler/Dev", "#crawler #dev", ["src/crawler/sites/"]),
                  ("Frontend/Dev", "#frontend #dev", ["src/viewer/frontend/"]), ("DB/Migration", "#db #migration", ["src/database/"])]


def touched_files(tool_calls, root: str) -> Column:
    """Files of the calls relative to ``root``; paths outside are dropped."""
    paths = F.transform(col(tool_calls), lambda c: first_filled(
        F.get_json_object(c["args"], "$.TargetFile"), F.get_json_object(c["args"], "$.AbsolutePath")))
    inside = F.filter(paths, lambda p: F.startswith(p, F.lit(root + "/")))
    return F.transform(inside, lambda p: F.substring(p, F.lit(len(root) + 2), F.length(p)))


def turn_categories(rows: DataFrame, root: str) -> DataFrame:
    """Add ``files, category, tags`` to turns: a commit command wins, then the touched-file rules."""
    commits = F.exists("tool_calls", lambda c: (c["name"] == "run_command") & F.contains(
        F.coalesce(F.get_json_object(c["args"], "$.CommandLine"), F.lit("")), F.lit("commit")))
    out = rows.withColumn("tool_calls", F.coalesce("tool_calls", F.array().cast(rows.schema["tool_calls"].dataType)))
    out = out.withColumn("files", touched_files("tool_calls", root)).withColumn("_git", commits)
    category, tags = F.when(F.col("_git"), "Git/Commit"), F.when(F.col("_git"), "#general")
    for name, tag, needles in CATEGORY_RULES:
        hit = F.exists("files", lambda f: contains_any(f, needles))  # noqa: B023
        category, tags = category.when(hit, name), tags.when(hit, tag)
    code = F.exists("files", lambda f: f.rlike(r"\.(ts|js)\z"))
    return (out.withColumn("category", category.when(code, "Refactor").otherwise("General"))
            .withColumn("tags", tags.when(code, "#refactor").otherwise("#general")).drop("_git"))


def turn_summaries(rows: DataFrame) -> DataFrame:
    """Add ``summary`` (first request line, 60 characters) and ``learnings`` of the answer."""
    return rows.withColumn("summary", first_filled(T.summary_line("request"), F.concat(F.lit("Turn "), F.col("turn").cast("string")))) \
               .withColumn("learnings", T.learnings_section("answer"))


def session_numbers(sessions: DataFrame, created: str, key: str = "session_id") -> DataFrame:
    """Directory per second, four-digit sequence inside it, and the tag made of both."""
    rows = sessions.withColumn("date_dir", D.directory_stamp(created)).withColumn("_ms", F.unix_millis(F.col(created).cast("timestamp")))
    num = prefix_scan(rows, ["date_dir"], ["_ms", key], F.col("_ms"), {"_n": ("sum", F.lit(1))})
    seq = F.lpad(F.col("_n").cast("string"), 4, "0")
    return num.select(key, "date_dir", seq.alias("seq"), F.concat_ws("-", seq, F.col(key).cast("string")).alias("tag"))


def session_usage(msgs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per session: steps and size of its messages next to the stored token counts and cost."""
    steps = msgs.groupBy("session_id").agg(F.count("*").alias("steps"), F.sum(F.octet_length("content")).alias("bytes"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return sessions.join(steps, "session_id", "left").select(
        "session_id", "updated", zero("steps"), zero("bytes"), T.bytes_text(F.coalesce("bytes", F.lit(0))).alias("size"),
        zero("tokens_in"), zero("tokens_out"), zero("tokens_reasoning"), zero("cost"))


def latest_sessions(usage: DataFrame, n: int = 5) -> DataFrame:
    return usage.orderBy(F.col("updated").desc(), "session_id").limit(n)


def join_parts(sessions: DataFrame, msgs: DataFrame, parts: DataFrame) -> DataFrame:
    """Messages of a relational store (``parts(session_id, message_id, ord, type, text, tool, input,
    output)``): texts joined in order, tool parts as calls. A message gathers its own parts only."""
    rows = parts.groupBy("session_id", "message_id").agg(F.array_sort(F.collect_list(F.struct(
        "ord", "type", "text", "tool", "input", "output"))).alias("p"))
    texts = F.filter(F.transform(F.filter("p", lambda x: x["type"].isin("text", "reasoning")), lambda x: x["text"]), lambda s: s != "")
    calls = F.transform(F.filter("p", lambda x: x["type"] == "tool"), lambda x: F.struct(
        first_filled(x["tool"], F.lit("unknown")).alias("name"), F.coalesce(x["input"], F.lit("{}")).alias("args"),
        F.coalesce(x["output"], F.lit("")).alias("result")))
    body = rows.select("session_id", "message_id", F.array_join(texts, "\n").alias("_content"), calls.alias("tool_calls"))
    j = msgs.join(sessions.select("session_id"), "session_id").join(body, ["session_id", "message_id"], "left")
    own = F.when(F.col("role") == "user", F.col("content"))
    return j.select("session_id", "message_id", "role", F.coalesce(first_filled("_content", own), F.lit("")).alias("content"), "tool_calls")


# --- one message table from either store: session_id, step, role, content, tool_calls<name,args,result> ------

def log_messages(steps: DataFrame) -> DataFrame:
    """Messages of a step log with the results of their calls. A message gathers its own calls only."""
    calls = attach_tasks(pair_results(steps), steps)
    own = calls.groupBy("session_id", "line_no").agg(F.array_sort(F.collect_list(F.struct("call_no", "name", "args", "result"))).alias("c"))
    m = messages(steps).drop("tool_calls").join(own, ["session_id", "line_no"], "left")
    done = F.transform("c", lambda x: F.struct(x["name"].alias("name"), x["args"].alias("args"), x["result"].alias("result")))
    return m.select("session_id", "step", "role", "content", _calls_or_none(done))


def store_messages(sessions: DataFrame, msgs: DataFrame, parts: DataFrame) -> DataFrame:
    """Messages of a relational store, numbered in message order."""
    rows = join_parts(sessions, msgs, parts).where(F.col("role").isin("user", "assistant"))
    num = prefix_scan(rows, ["session_id"], ["message_id"], ordinal_bucket("message_id"), {"step": ("sum", F.lit(1))})
    return num.select("session_id", (F.col("step") - 1).alias("step"), "role", "content", _calls_or_none(F.col("tool_calls")))


def _calls_or_none(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<struct<name:string,args:string,result:string>>")).alias("tool_calls")


def transcript_parts(msgs: DataFrame, root: str, part_size: int = 256) -> DataFrame:
    """Transcript Markdown in parts of at most ``part_size`` steps (``session_id, part, markdown``),
    so that a session of any length is written by many tasks."""
    icon = F.when(F.col("role") == "user", "🗣️ User").otherwise("🤖 Agent")
    text = F.when(F.col("content") != "", F.concat(F.lit("\n"), T.relativize(trim_ws("content"), root), F.lit("\n"))).otherwise("")
    block = F.concat(F.lit("\n### [Step "), F.col("step").cast("string"), F.lit("] "), icon, F.lit("\n"), text)
    return msgs.groupBy("session_id", F.floor(F.col("step") / part_size).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", block.alias("b")))), lambda s: s["b"]), "").alias("markdown"))


def call_blocks(calls: DataFrame, root: str) -> DataFrame:
    """Transcript block of each tool call, long results cut in the middle."""
    quote = lambda c: F.replace(c, F.lit("\n"), F.lit("\n> "))
    shown = T.relativize(trim_ws(T.truncate_lines("result")), root)
    result = F.when(F.coalesce("result", F.lit("")) != "", F.concat(
        F.lit(">\n> **Result**:\n> ```\n> "), quote(shown), F.lit("\n> ```\n"))).otherwise("")
    return calls.withColumn("block", F.concat(F.lit("\n> **🛠️ Tool Call**: `"), "name", F.lit("`\n> ```json\n> "),
                                              quote(F.col("args")), F.lit("\n> ```\n"), result))


def result_digest(result) -> Column:
    """First three lines of a result and the number of lines when there are more."""
    lines = T.lines_of(result)
    more = F.when(F.size(lines) > 3, F.concat(F.lit("\n... (Total "), F.size(lines).cast("string"), F.lit(" lines)"))).otherwise("")
    return trim_ws(F.concat(F.array_join(F.slice(lines, 1, 3), "\n"), more))
