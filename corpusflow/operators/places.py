"""Locations to countries by a table of aliases, as a join: the table may have any length.

``functions.geo`` tests each text against every alias, which suits a short list. Here an alias is found by one of its
letter groups (an equi-join on an inverted list) and only then compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import HANGUL, trim_ws
from ..functions.geo import NO_LOCATION, UNKNOWN_LOCATION

GRAM = 3          # letters of a group; shorter aliases are found by themselves
SALTS = 16        # parts of the rows of one location


def alias_rows(spark: SparkSession, aliases: list[tuple[str, list[str]]]) -> DataFrame:
    """``alias, country, priority`` of an ordered list of countries with their aliases."""
    rows = [(a, c, i) for i, (c, names) in enumerate(aliases) for a in names]
    return spark.createDataFrame(rows, "alias string, country string, priority int")


def _grams(text: Column, size) -> Column:
    """All groups of ``size`` letters of a text; none where it is shorter."""
    n = F.length(text)
    return F.when(n >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, size)))).otherwise(
        F.array().cast("array<string>"))


def _entries(aliases: DataFrame) -> DataFrame:
    """Each alias under one group of its letters, the one that the fewest aliases have."""
    a = aliases.select("alias", "country", "priority", F.lower("alias").alias("_low")).where("_low <> ''")
    size = F.least(F.length("_low"), F.lit(GRAM))
    each = a.withColumn("_size", size).withColumn("_gram", F.explode(_grams(F.col("_low"), F.col("_size"))))
    often = each.groupBy("_gram").agg(F.count("*").alias("_n"))
    best = each.join(often, "_gram").groupBy("alias", "country", "priority", "_low", "_size").agg(F.min(F.struct("_n", "_gram")).alias("_b"))
    return best.select("alias", "country", "priority", "_low", "_size", F.col("_b._gram").alias("_gram"))


def countries(places: DataFrame, place: str, aliases: DataFrame, mode: str = "substring") -> DataFrame:
    """``place, country`` of the distinct texts in which an alias (``alias, country, priority``) occurs, any case: the country
    of the smallest priority. ``word`` asks for whole words."""
    entries = _entries(aliases)
    texts = places.select(F.col(place).alias("place")).where("place IS NOT NULL").distinct().withColumn("_text", F.lower("place"))
    # One list of groups per length in use; there are at most GRAM of them.
    grams = F.flatten(F.array(*[_grams(F.col("_text"), F.lit(k)) for k in range(1, GRAM + 1)]))
    found = texts.withColumn("_gram", F.explode(grams)).join(entries, "_gram")
    if mode == "word":
        hit = F.regexp_like("place", F.concat(F.lit(r"(?iu)\b\Q"), F.col("alias"), F.lit(r"\E\b")))
    else:
        hit = F.contains("_text", F.col("_low"))
    return found.where(hit).groupBy("place").agg(F.min(F.struct("priority", "country")).alias("b")).select("place", F.col("b.country").alias("country"))


def standardize_locations(rows: DataFrame, location: str, aliases: DataFrame, out: str = "country", mode: str = "substring") -> DataFrame:
    """``rows`` with the country of a location text: by alias, South Korea for other Hangul text, else the cleaned text; the
    rules of ``geo.standardize_location``. Each distinct text is looked up once; a text that a great many rows share is
    joined in parts."""
    text = trim_ws(location)
    named = rows.withColumn("_place", text).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    known = countries(rows.select(text.alias("_place")), "_place", aliases, mode).withColumnRenamed("country", "_country")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    j = named.join(known.withColumnRenamed("place", "_place"), ["_place", "_salt"], "left")
    clean = trim_ws(F.regexp_replace("_place", r'[/\\:*?"<>|]', " "))
    country = F.coalesce("_country", F.when(F.col("_place").rlike(HANGUL), F.lit("South Korea")), clean)
    missing = F.coalesce(F.col(location), F.lit("")).isin(NO_LOCATION)
    return j.select(*[F.col(c) for c in rows.columns if c != out], F.when(missing, F.lit(UNKNOWN_LOCATION)).otherwise(country).alias(out))
