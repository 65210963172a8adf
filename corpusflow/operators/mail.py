"""Mail records and their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.base import col, first_filled, match_group
from .links import first_by_id

# Catch-all labels that are not synchronised.
CATCH_ALL = ["all_mail", "all_mails", "gmail"]


def sender_tag(sender) -> Column:
    """``from/<second-level domain>`` of a sender."""
    parts = F.split(match_group(sender, r"@([\w.-]+)"), r"\.")
    name = F.coalesce(F.when(F.size(parts) > 1, F.element_at(parts, -2)), F.get(parts, F.lit(0)))
    return F.concat(F.lit("from/"), first_filled(name, F.get(parts, F.lit(0)), F.lit("unknown")))


def mailbox_label(label) -> Column:
    return F.lower(F.replace(F.regexp_replace(col(label), r"(?i)^\[Gmail\]/", ""), F.lit(" "), F.lit("_")))


def synced_labels(labels: DataFrame, label: str = "label") -> DataFrame:
    return labels.withColumn("alias", mailbox_label(label)).where(~F.col("alias").isin(CATCH_ALL))


def target_path(folder: Column, sender_email: Column, ts: Column, subject: Column, mail_id: Column) -> Column:
    """Export folder of a mail."""
    return F.concat_ws("/", T.mail_file_name(folder), T.mail_file_name(sender_email),
                       F.concat_ws("_", D.mail_stamps(ts)["stamp"], T.mail_file_name(subject), mail_id))


def mail_records(mail: DataFrame) -> DataFrame:
    """Export record of parsed mail (``uid, ts, sender, subject, body_md, folder, message_id,
    in_reply_to, refs, attachments``)."""
    body = T.mail_noise("body_md")
    files = F.transform(F.coalesce("attachments", F.array().cast(mail.schema["attachments"].dataType)), lambda a: F.struct(
        T.mail_file_name(a["filename"]).alias("filename"),
        first_filled(a["content_type"], F.lit("application/octet-stream")).alias("content_type"),
        F.coalesce(a["size"], F.lit(0)).alias("size")))
    rows = mail.withColumn("body", body)
    none = F.lit("")
    return rows.select(
        F.col("uid").alias("id"), first_filled("subject", F.lit("No Subject")).alias("title"),
        first_filled("sender", F.lit("Unknown")).alias("author"), D.mail_stamps("ts")["iso"].alias("date"), "folder",
        F.array(F.lit("email_backup"), sender_tag("sender")).alias("tags"), F.length("body").alias("character_count"),
        F.struct(F.coalesce("message_id", none).alias("message_id"), F.coalesce("in_reply_to", none).alias("in_reply_to"),
                 F.coalesce("refs", F.array().cast("array<string>")).alias("refs")).alias("thread_info"),
        files.alias("attachments"), T.plain_text("body").alias("plain_text"), "body")


def mail_markdown(records: DataFrame) -> DataFrame:
    """Markdown page of each record, front matter first."""
    esc = lambda c: F.replace(F.col(c), F.lit('"'), F.lit('\\"'))
    files = F.when(F.size("attachments") > 0, F.array_join(F.transform("attachments", lambda a: F.concat(
        F.lit("- [["), a["filename"], F.lit("]]"))), "\n")).otherwise("None")
    tags = F.concat(F.lit("["), F.array_join("tags", ", "), F.lit("]"))
    return records.select("id", F.concat_ws(
        "\n", F.lit("---"), F.concat(F.lit('id: "'), "id", F.lit('"')), F.concat(F.lit('title: "'), esc("title"), F.lit('"')),
        F.concat(F.lit('author: "'), esc("author"), F.lit('"')), F.concat(F.lit('date: "'), "date", F.lit('"')),
        F.concat(F.lit('folder: "'), "folder", F.lit('"')), F.concat(F.lit("tags: "), tags),
        F.concat(F.lit("characterCount: "), F.col("character_count").cast("string")),
        F.concat(F.lit('messageId: "'), F.col("thread_info.message_id"), F.lit('"')),
        F.concat(F.lit('inReplyTo: "'), F.col("thread_info.in_reply_to"), F.lit('"')),
        F.concat(F.lit("references: "), F.to_json("thread_info.refs")), F.lit("---"),
        F.concat(F.lit("# "), "title"), F.lit("## Metadata"), F.concat(F.lit("- **From:** "), "author"),
        F.concat(F.lit("- **Date:** "), "date"), F.concat(F.lit("- **Mailing ID:** "), "id"),
        F.concat(F.lit("- **Folder:** "), "folder"), F.lit("- **Raw EML:** [[message.eml]]"), F.lit(""),
        F.lit("## 📎 Attachments"), files, F.lit(""), F.lit("---"), F.lit("## Content"), F.col("body")).alias("markdown"))


def mail_index(paths: DataFrame, path: str = "path") -> DataFrame:
    """``uid -> path`` from export folders: the id is the last piece of the folder name, if it has at
    least eight characters; the last path of an id wins."""
    uid = F.substring_index(F.substring_index(F.col(path), "/", -1), "_", -1)
    rows = paths.select(uid.alias("uid"), F.col(path).alias("path")).where(F.length("uid") >= 8)
    return rows.groupBy("uid").agg(F.max("path").alias("path"))


def not_exported(mail: DataFrame, index: DataFrame) -> DataFrame:
    """Mail to fetch: one row per id that the index does not hold."""
    return first_by_id(mail, ["ts"], ["uid"]).join(index.select("uid"), "uid", "left_anti")
