"""Look-ups, set operations and paging over keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_any_key(docs: DataFrame, key_columns: list[str], wanted: DataFrame) -> DataFrame:
    """Documents with one of several id columns equal, as text, to a wanted key. The id columns are
    exploded, which turns the OR into one equi-join."""
    keys = F.array_distinct(F.array_compact(F.array(*[F.col(c).cast("string") for c in key_columns])))
    return docs.select("*", F.explode(keys).alias("key")).join(wanted.select("key").distinct(), "key")


def stitch(silver: DataFrame, bronze: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Silver rows with some bronze fields; only those columns leave the bronze scan."""
    return silver.join(bronze.select(*key, *fields), key, "left")


def key_union(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [t.toDF("key") for t in tables]).distinct()


def page_of(rows: DataFrame, order: list[Column], page: int = 1, size: int = 30) -> DataFrame:
    """One page in a total order; planned as a top-k over ``page * size`` rows."""
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def newest(rows: DataFrame, ts: str, tie: str) -> list[Column]:
    return [F.col(ts).desc_nulls_last(), F.col(tie)]


def find(rows: DataFrame, predicates: list[Column], fields: list[str] | None = None, order: list[Column] = (),
         limit: int | None = None) -> DataFrame:
    """Ad-hoc look-up: predicates, projection, order; all rows, or the first ``limit`` the caller asks for."""
    for p in predicates:
        rows = rows.where(p)
    if order:
        rows = rows.orderBy(*order)
    rows = rows if limit is None else rows.limit(limit)
    return rows.select(*fields) if fields else rows


def missing_or_not_in(c: str, values: list) -> Column:
    """Document-store negation: a missing field passes."""
    return F.col(c).isNull() | ~F.col(c).isin(values)


# Files that are no chapters, the ending of a translated chapter.
NO_CHAPTERS = ["INDEX", "README"]
TRANSLATED = ".en-ko.md"


def prefer_translation(files: DataFrame, book: str, file: str) -> DataFrame:
    """Markdown chapters, the translated variant instead of the original where both exist."""
    name = F.col(file)
    stem = F.regexp_replace(name, r"(?i)\.md\z", "")
    rows = files.where(F.lower(name).endswith(".md") & ~F.upper(stem).isin(NO_CHAPTERS))
    rows = rows.withColumn("_base", F.lower(F.regexp_replace(name, r"(?i)(\.en-ko)?\.md\z", "")))
    rows = rows.withColumn("_translated", F.lower(name).endswith(TRANSLATED))
    have = rows.where("_translated").select(book, "_base").distinct()
    originals = rows.where("NOT _translated").join(have, [book, "_base"], "left_anti")
    return rows.where("_translated").unionByName(originals).drop("_base", "_translated")
