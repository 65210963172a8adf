"""Small Column helpers with the string semantics the corpus rules were written for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the web platform trims it (Java's \s is ASCII only).
WS = r"[\s\u000b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
HANGUL = r"[가-힣]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c, body) -> Column:
    """Evaluate ``c`` once and hand it to ``body``; keeps deep compositions from repeating their input."""
    return F.get(F.transform(F.array(col(c)), body), F.lit(0))


# The same characters, for the native trim (no regex).
_WS_CHARS = "\t\n\x0b\x0c\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def trim_ws(c) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.trim(col(c), F.lit(_WS_CHARS))


def first_filled(*cols) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def match_group(c, pattern: str, group: int = 1) -> Column:
    """Capture of the first match, NULL when there is none or it is empty."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def drop_matches(c, *patterns: str) -> Column:
    out = col(c)
    for p in patterns:
        out = F.regexp_replace(out, p, "")
    return out


def contains_any(c, needles) -> Column:
    """Does the text contain one of the literal needles?"""
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(col(c), F.lit(n))
    return out


def lines_of(c) -> Column:
    return F.split(col(c), "\n")
