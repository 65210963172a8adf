"""Country rules. The alias table is a parameter: an ordered list of ``(country, [alias, ...])``."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import HANGUL, col, let, trim_ws

# Default aliases, tested in this order, first country wins. Deployments pass their
# own longer table (see ``load_aliases``).
COUNTRY_ALIASES: list[tuple[str, list[str]]] = [
    ("South Korea", ["South Korea", "Seoul", "Korea", "Busan", "Incheon", "Pangyo", "서울", "대한민국"]),
    ("United Arab Emirates", ["Abu Dhabi", "Dubai", "Sharjah", "United Arab Emirates", "UAE"]),
    ("Germany", ["Germany", "Berlin", "Munich", "Frankfurt", "Hamburg", "Stuttgart", "DACH"]),
    ("Qatar", ["Qatar", "Doha"]),
    ("Austria", ["Austria", "Vienna", "Linz", "Graz", "Salzburg"]),
    ("Singapore", ["Singapore"]),
    ("United Kingdom", ["United Kingdom", "UK", "London", "Great Britain", "England", "Scotland", "Wales"]),
    ("Canada", ["Canada", "Toronto", "Vancouver", "Montreal"]),
    ("Ireland", ["Ireland", "Dublin"]),
    ("Saudi Arabia", ["Saudi Arabia", "Riyadh"]),
    ("Japan", ["Japan", "Tokyo", "Shibuya", "Osaka", "Kyoto", "Yokohama"]),
    ("Switzerland", ["Switzerland", "Schweiz", "Zürich", "Zurich"]),
    ("Luxembourg", ["Luxembourg", "Luxemburg"]),
    ("Malaysia", ["Malaysia", "Johor"]),
    ("Spain", ["Spain", "Madrid"]),
    ("Poland", ["Poland", "Warsaw"]),
    ("Liechtenstein", ["Liechtenstein", "Vaduz"]),
    ("Romania", ["Romania", "Bucharest"]),
    ("United States", ["United States", "US", "Denver", "Colorado", "USA"]),
    ("Netherlands", ["Netherlands", "NL", "Amsterdam"]),
    ("Slovakia", ["Slovakia", "Bratislava"]),
    ("Hungary", ["Hungary", "Sopron"]),
    ("India", ["India", "Bengaluru", "Bangalore", "Hyderabad", "Mumbai", "Pune", "Chennai", "Delhi"]),
    ("Philippines", ["Philippines", "Manila"]),
    ("China", ["China", "Beijing", "Shenzhen", "Shanghai", "Hong Kong", "Taiwan"]),
    ("Sweden", ["Sweden", "Stockholm"]),
    ("Portugal", ["Portugal", "Lisbon"]),
    ("Egypt", ["Egypt", "Cairo"]),
    ("Israel", ["Israel", "Tel Aviv"]),
    ("South Africa", ["South Africa", "Cape Town", "Johannesburg"]),
    ("Italy", ["Italy", "Rome", "Milano", "Milan"]),
    ("Denmark", ["Denmark", "Copenhagen"]),
    ("Estonia", ["Estonia", "Tallinn"]),
    ("Bulgaria", ["Bulgaria", "Sofia"]),
    ("Türkiye", ["Türkiye", "Turkey", "Istanbul", "Ankara"]),
    ("Global", ["APAC", "EMEA", "APJ", "MENA", "Middle East", "East Asia", "Global"]),
]

# ISO country code to English name.
COUNTRY_CODES = {
    "KR": "South Korea", "US": "United States", "GB": "United Kingdom", "JP": "Japan", "CN": "China",
    "DE": "Germany", "FR": "France", "SG": "Singapore", "AE": "United Arab Emirates", "CA": "Canada",
    "IN": "India", "AU": "Australia", "NL": "Netherlands", "CH": "Switzerland", "SE": "Sweden",
    "DK": "Denmark", "IE": "Ireland", "NZ": "New Zealand", "TR": "Turkey", "ES": "Spain", "PL": "Poland",
    "AT": "Austria", "MY": "Malaysia", "SA": "Saudi Arabia", "QA": "Qatar", "IT": "Italy", "HK": "Hong Kong",
    "VN": "Vietnam", "ID": "Indonesia", "PH": "Philippines", "TH": "Thailand", "BR": "Brazil", "RU": "Russia",
    "IL": "Israel", "BE": "Belgium", "FI": "Finland", "NO": "Norway", "ZA": "South Africa", "MX": "Mexico",
    "TW": "Taiwan", "PT": "Portugal", "UA": "Ukraine", "CZ": "Czech Republic", "GR": "Greece", "HU": "Hungary",
    "RO": "Romania", "BM": "Bermuda", "CY": "Cyprus", "EE": "Estonia", "HR": "Croatia", "KE": "Kenya",
    "LI": "Liechtenstein", "LT": "Lithuania", "LU": "Luxembourg", "MK": "North Macedonia", "MT": "Malta",
    "MU": "Mauritius", "NG": "Nigeria", "SI": "Slovenia", "TN": "Tunisia", "CO": "Colombia", "EG": "Egypt",
    "MA": "Morocco", "MC": "Monaco", "PK": "Pakistan", "TG": "Togo", "UG": "Uganda", "UY": "Uruguay",
    "SK": "Slovakia", "GL": "Global", "JE": "Jersey", "SC": "Seychelles", "OO": "Global",
}

UNKNOWN_LOCATION = "unknown-location"
# Texts that mean "no location".
NO_LOCATION = ["", "정보 없음", "No info"]


def load_aliases(path: str) -> list[tuple[str, list[str]]]:
    """Ordered alias table of a ``{country: [alias, ...]}`` JSON file (a configuration file)."""
    with open(path, encoding="utf-8") as f:
        return list(json.load(f).items())


def country_of(location, aliases=None, mode: str = "substring") -> Column:
    """First country with an alias in the text, any case; NULL when none matches. ``word`` asks for
    whole words, so that ``US`` no longer matches ``Russia``."""
    edge = r"\b" if mode == "word" else ""
    out = F.lit(None).cast("string")
    for country, names in reversed(aliases or COUNTRY_ALIASES):
        pattern = "(?iu)" + edge + "(" + "|".join(re.escape(n).replace("\\ ", " ") for n in names) + ")" + edge
        out = F.when(col(location).rlike(pattern), F.lit(country)).otherwise(out)
    return out


def standardize_location(location, aliases=None, mode: str = "substring") -> Column:
    """Country of a location text, South Korea for other Hangul text, else the cleaned text."""
    def rule(loc):
        clean = trim_ws(F.regexp_replace(loc, r'[/\\:*?"<>|]', " "))
        return F.coalesce(country_of(loc, aliases, mode),
                          F.when(loc.rlike(HANGUL), F.lit("South Korea")), clean)
    missing = F.coalesce(col(location), F.lit("")).isin(NO_LOCATION)
    return F.when(missing, F.lit(UNKNOWN_LOCATION)).otherwise(let(trim_ws(location), rule))


def geo_bucket(location, aliases=None) -> Column:
    """Standard country when it is one of the table, else ``Others``."""
    known = [c for c, _ in (aliases or COUNTRY_ALIASES)]
    return let(standardize_location(location, aliases),
               lambda c: F.when(c.isin(known), c).otherwise(F.lit("Others")))


def country_name(code) -> Column:
    """English name of an ISO code, the code itself when unknown, ``Unknown`` when empty."""
    names = F.create_map(*[F.lit(x) for kv in COUNTRY_CODES.items() for x in kv])
    c = F.upper(trim_ws(code))
    return F.when(F.coalesce(col(code), F.lit("")) == "", F.lit("Unknown")).otherwise(
        F.coalesce(F.element_at(names, c), c))
