"""Nested comments as rows: levels of the tree are unfolded in rounds, no page is ever one value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.base import match_group
from ..session import cut_lineage

ROUND = 4          # levels of one round


def comment_rows(pages: DataFrame, key: str, json_ld: str) -> DataFrame:
    """``key, path, depth, comment_id, author, content`` of the comments of structured-data texts. ``path`` holds the places
    from the top (from 0), so its order is the reading order; ``depth`` is its length. One object counts as a list of
    one; a comment without text has no row, but its replies do. A malformed text has none.

    A round unfolds ``ROUND`` levels, writes them and goes on with the replies of the last one, as long as there are any."""
    top = pages.select(F.col(key), F.array().cast("array<int>").alias("path"), V.parsed(json_ld).alias("node")).where("node IS NOT NULL")
    done, level = None, _replies(top)
    while True:
        parts, cur = [level], level
        for _ in range(ROUND - 1):
            cur = _replies(cur)
            parts.append(cur)
        block = parts[0]
        for p in parts[1:]:
            block = block.unionByName(p)
        block = cut_lineage(block, "comments")
        done = block if done is None else done.unionByName(block)
        deepest = block.agg(F.max(F.size("path"))).first()[0]
        if deepest is None or deepest % ROUND:
            break
        level = _replies(block.where(F.size("path") == deepest))
    text, url = V.text_at("node", "$.text"), V.text_at("node", "$.url")
    return done.select(key, "path", F.size("path").alias("depth"), F.coalesce(match_group(url, r".*id=([^&]*)"), F.lit("")).alias("comment_id"),
                       F.coalesce(V.text_at("node", "$.author.name"), F.lit("Unknown")).alias("author"), text.alias("content")).where("content IS NOT NULL")


def _replies(level: DataFrame) -> DataFrame:
    rest = [c for c in level.columns if c not in ("path", "node")]
    kids = level.select(*rest, "path", F.posexplode(V.items("node", "$.comment")).alias("pos", "kid"))
    return kids.where(V.is_object("kid")).select(*rest, F.concat("path", F.array("pos")).alias("path"), F.col("kid").alias("node"))
