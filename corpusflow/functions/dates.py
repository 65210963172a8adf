"""Date rules: relative ages, tolerant parsing, Korean calendar days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, first_filled, let, match_group, trim_ws

KST = "Asia/Seoul"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Unit words of a relative age, the three shapes it is written in, days per unit.
_EN, _KO = "day|week|month|year|hour|minute|second", "일|주|달|개월|년|시간|분|초"
RELATIVE_SHAPES = [rf"(?i)(\d+)\s*({_EN}|{_KO})s?\s*ago", rf"(?i)(\d+)\s*({_KO})\s*전", rf"(?i)(\d+)\s*({_EN})s?"]
UNIT_DAYS = {"day": 1, "일": 1, "week": 7, "주": 7, "month": 30, "달": 30, "개월": 30, "year": 365, "년": 365}


def days_ago(text) -> Column:
    """Days of a relative age; sub-day units count 0; NULL when the text holds no age, or a number of more
    than five digits, which is none."""
    t = F.coalesce(col(text), F.lit(""))
    number = F.coalesce(*[match_group(t, p, 1) for p in RELATIVE_SHAPES])
    unit = F.lower(F.coalesce(*[match_group(t, p, 2) for p in RELATIVE_SHAPES]))
    factor = F.lit(0)
    for word, days in UNIT_DAYS.items():
        factor = F.when(unit == word, days).otherwise(factor)
    return F.when(F.length(number) <= 5, number.try_cast("int")) * factor


def relative_date(text, fallback, base, tz: str = KST) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of ``base`` minus the age in ``text`` (else in ``fallback``), in ``tz``."""
    local = F.from_utc_timestamp(col(base).cast("timestamp"), tz)
    days = F.coalesce(days_ago(text), days_ago(fallback), F.lit(0))
    return F.date_format(local - F.make_dt_interval(days), "yyyy-MM-dd HH:mm:ss")


_WRITTEN = ["MMM d, yyyy", "MMMM d, yyyy"]


def safe_timestamp(c) -> Column:
    """Timestamp of an ISO-like, ``YYYY.MM.DD`` or written-out English date, NULL when it is none."""
    def parse(t):
        iso = F.when(t.rlike(r"^\d{4}\.\d{2}\.\d{2}\z"), F.replace(t, F.lit("."), F.lit("-"))).otherwise(t)
        return F.when(t.rlike(r"^\d{4}[-.]\d{2}"), iso.try_cast("timestamp")).when(
            t.rlike(r"^[A-Z][a-z]+ \d"), F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in _WRITTEN]))
    return let(trim_ws(c), parse)


def epoch_ms_timestamp(c) -> Column:
    """Timestamp of an epoch-milliseconds text."""
    return F.when(col(c).rlike(r"^\d{12,14}\z"), F.timestamp_millis(col(c).try_cast("bigint")))


def published_at(json_ld_date, meta_time, time_attr, visible_text) -> Column:
    """Publish date: JSON-LD, then meta time (ISO or epoch ms), then ``time[datetime]``, then a
    ``YYYY.MM.DD`` in the visible text."""
    shown = match_group(visible_text, r"(\d{4}\.\s?\d{2}\.\s?\d{2})")
    return F.coalesce(safe_timestamp(json_ld_date), epoch_ms_timestamp(meta_time), safe_timestamp(meta_time),
                      safe_timestamp(time_attr), safe_timestamp(F.regexp_replace(shown, r"\s", "")))


def kst_day(ts) -> Column:
    return F.to_date(F.from_utc_timestamp(col(ts).cast("timestamp"), KST))


def kst_day_start(day) -> Column:
    """UTC instant at which a Korean calendar day starts."""
    return F.to_utc_timestamp(F.to_timestamp(col(day).cast("date")), KST)


def in_kst_days(ts, start: str, end: str) -> Column:
    """Half-open range test that a Parquet scan can use: both bounds fold to constants."""
    t = col(ts).cast("timestamp")
    return (t >= kst_day_start(F.lit(start))) & (t < kst_day_start(F.date_add(F.lit(end).cast("date"), 1)))


def mail_stamps(ts) -> Column:
    """Struct ``iso, month, stamp`` of a mail date; ``Unknown-Date`` when there is none. The ISO text
    shows the UTC clock with a +09:00 suffix, as the stored mail records have it."""
    t = col(ts).cast("timestamp")
    local = F.from_utc_timestamp(t, KST)
    unknown = F.lit("Unknown-Date")
    return F.struct(
        F.coalesce(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00'"), unknown).alias("iso"),
        F.coalesce(F.date_format(local, "yyyy-MM"), unknown).alias("month"),
        F.coalesce(F.date_format(local, "yyyy-MM-dd_HH-mm-ss"), unknown).alias("stamp"))


def mail_uid(ts, sender) -> Column:
    """KST stamp and the first eight hex digits of the md5 of the sender."""
    h = F.substring(F.md5(trim_ws(F.lower(first_filled(sender, F.lit("unknown"))))), 1, 8)
    local = F.from_utc_timestamp(col(ts).cast("timestamp"), KST)
    return F.concat(F.coalesce(F.date_format(local, "yyyyMMdd_HHmmss"), F.lit("unknown")), F.lit("_"), h)


def published_fallback(run_ts, *candidates, body=None, site=None) -> Column:
    """First known date of a record, else one written in its body, else the run time. With ``site``, each way of
    writing counts for its own site alone."""
    of = lambda key, c: c if site is None else F.when(col(site) == key, c)
    written = [] if body is None else [F.coalesce(
        of("linkedin", match_group(body, r'posted_date:\s*"([^"]+)"')),
        of("linkedin", match_group(body, r"\*\*포스팅 날짜 \(Posted Date\):\*\*\s*([^\n]+)")),
        of("geeknews", F.nullif(match_group(body, r"\*\*작성일:\*\*\s*([^\n]+)"), F.lit("정보 없음"))))]
    return F.coalesce(*[col(c).try_cast("timestamp") for c in candidates],
                      *[safe_timestamp(w) for w in written], col(run_ts).cast("timestamp"))


def date_partition(ts) -> tuple[Column, Column]:
    """``year`` and ``month`` folder names; ``unknown`` without a date."""
    return (F.coalesce(F.date_format(col(ts), "yyyy"), F.lit("unknown")).alias("year"),
            F.coalesce(F.date_format(col(ts), "MM"), F.lit("unknown")).alias("month"))


def directory_stamp(ts) -> Column:
    """Second-level directory name of an instant."""
    return F.date_format(col(ts).cast("timestamp"), "yyyy-MM-dd'T'HHmmss")


def day_range(start, end, descending: bool = False) -> Column:
    """Calendar days of a closed range as an array, empty when the range is."""
    a, b = col(start).cast("date"), col(end).cast("date")
    days = F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<date>"))
    return F.reverse(days) if descending else days
