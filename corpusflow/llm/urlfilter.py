"""URL filters: rules, then host word segmentation by unigram Viterbi and multinomial naive Bayes."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField

from corpusflow.llm.common import append, stored, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = 63               # letters of the longest name DNS allows
PIECE = 24               # letters of the longest word
LETTERS = r"\p{L}+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``,
    ``#`` or the end. Both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def parse_rule(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host, "/" + path


def rule_columns(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain, and a path that starts with its own."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules.items(), key=lambda x: (len(x[0]), x[0])):
        h, p = parse_rule(r)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def unigrams(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): the words of all pages without markup, in lower case, of up to ``PIECE`` letters."""
    plain = F.regexp_replace(F.regexp_replace(F.col(f"`{html}`"), r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    word = F.explode(F.split(F.lower(plain), r"\P{L}+")).alias("word")
    return pages.select(word).where(f"word <> '' AND length(word) <= {PIECE}").groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, logp: dict[str, float], unknown) -> list[str]:
    """Viterbi over the unigram model: the split with the largest sum of log probabilities, the one with fewer words of
    equal ones."""
    score, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    for j in range(1, len(name) + 1):
        for i in range(max(0, j - PIECE), j):
            w = name[i:j]
            s = score[i] + logp.get(w, unknown(len(w)))
            if s > score[j] + 1e-12:
                score[j], back[j] = s, i
    out, j = [], len(name)
    while j:
        out.append(name[back[j]:j])
        j = back[j]
    return out[::-1]


def segment_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, parts) of a table of distinct names: letters only. The words a name may hold are its own substrings, so
    each name fetches the counts of these by a join; no vocabulary is sent to all tasks. Names longer than DNS allows
    are no concatenated words and stay whole."""
    total = F.lit(float(max(2, words.agg(F.sum("n")).first()[0] or 0)))
    spans = (names.where(F.length("name") <= LABEL).select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
             .select("name", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(PIECE), F.length("name") - F.col("i") + 1))).alias("k"))
             .select("name", F.substring(F.col("name"), F.col("i"), F.col("k")).alias("word")).distinct())
    known = spans.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("word", F.log(F.col("n") / total).alias("p"))).alias("known"))
    rows = names.join(known, "name", "left").withColumn("total", total)

    def run(batch: pa.RecordBatch):
        out = []
        for name, known, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("name", "known", "total"))):
            # An unseen word costs ten times more with each letter.
            out.append([name] if len(name) > LABEL else
                       best_split(name, {k["word"]: k["p"] for k in known or ()}, lambda k, n=n: math.log(10 / n) - k * math.log(10)))
        return [pa.array(out, pa.list_(pa.string()))]

    return append(rows, [StructField("parts", ArrayType(StringType()))], run).select("name", "parts")


def judge(pages: DataFrame, rules: dict[str, str], words: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule, verdict, score.

    Where a rule fits, the longest one decides. The others go to naive Bayes over the words of the segmented host and of
    the path, trained on the addresses that rules decide; score is the log odds of blocking, above 0 blocks. Runs of
    digits are one word. Without decided addresses of both kinds everything else is allowed. Null addresses have
    empty host and path. Columns of the new names are replaced.

    Words of a host are summed once per distinct host, those of a path once per distinct path; a word that nearly all
    addresses share is one row of the model and its side of the join is split by the engine."""
    new = ["host", "path", "rule", "verdict", "score"]
    h, p = host_and_path(F.col(f"`{url}`"))
    base = without(pages.withColumn("_h", h).withColumn("_p", p), new).withColumnsRenamed({"_h": "host", "_p": "path"})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("_v", verdict)

    hosts = base.where("host <> ''").groupBy("host").count().select("host")
    labels = hosts.select("host", F.explode(F.regexp_extract_all(F.col("host"), F.lit(f"({LETTERS}|[0-9]+)"))).alias("name"))
    parts = segment_names(labels.where(F.col("name").rlike("^" + LETTERS)).select("name").distinct(), words)
    host_words = (labels.join(parts, "name", "left").select("host", F.explode(F.coalesce("parts", F.array(F.lit("<digits>")))).alias("word"))
                  .groupBy("host", "word").agg(F.count("*").alias("k")))
    host_words = stored(host_words, "url-host-words")
    paths = base.where("path <> ''").groupBy("path").agg(F.count_if(F.col("_v") == "block").alias("nb"), F.count_if(F.col("_v") == "allow").alias("na"))
    path_words = (paths.select("path", "nb", "na", F.explode(F.regexp_extract_all(F.lower("path"), F.lit(f"({LETTERS}|[0-9]+)"))).alias("word"))
                  .withColumn("word", F.when(F.col("word").rlike("^[0-9]"), "<digits>").otherwise(F.col("word"))))
    by_host = base.groupBy("host").agg(F.count_if(F.col("_v") == "block").alias("nb"), F.count_if(F.col("_v") == "allow").alias("na"))
    seen = (host_words.join(by_host, "host").select("word", (F.col("k") * F.col("nb")).alias("nb"), (F.col("k") * F.col("na")).alias("na"))
            .unionByName(path_words.select("word", "nb", "na")).groupBy("word").agg(F.sum("nb").alias("nb"), F.sum("na").alias("na")))
    seen = stored(seen, "url-word-counts")
    total = seen.agg(F.count("*").alias("v"), F.coalesce(F.sum("nb"), F.lit(0)).alias("b"), F.coalesce(F.sum("na"), F.lit(0)).alias("a")).first()
    decided = base.agg(F.count_if(F.col("_v") == "block").alias("b"), F.count_if(F.col("_v") == "allow").alias("a")).first()
    odds = seen.select("word", F.log((F.col("nb") + 1) / F.lit(float(total["b"] + total["v"] + 1)) / ((F.col("na") + 1) / F.lit(float(total["a"] + total["v"] + 1)))).alias("w"))
    prior = math.log((decided["b"] + 1) / (decided["a"] + 1))
    of_host = host_words.join(odds, "word").groupBy("host").agg(F.sum(F.col("k") * F.col("w")).alias("_sh"))
    of_path = path_words.select("path", "word").join(odds, "word").groupBy("path").agg(F.sum("w").alias("_sp"))
    out = base.join(of_host, "host", "left").join(of_path, "path", "left")
    score = F.lit(prior) + F.coalesce("_sh", F.lit(0.0)) + F.coalesce("_sp", F.lit(0.0))
    score = score if decided["b"] and decided["a"] else F.lit(0.0)
    out = out.withColumn("score", score).withColumn("verdict", F.coalesce("_v", F.when(F.col("score") > 0, "block").otherwise("allow")))
    return out.select([F.col(f"`{c}`") for c in pages.columns if c.lower() not in new] + new)
