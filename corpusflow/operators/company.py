"""Company records from the data blocks embedded in profile pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.base import col, first_filled, match_group, trim_ws
from ..functions.jsonx import is_json_object
from ..functions.text import NO_INFO

_S = T.StringType()
_ADDRESS = T.StructType([T.StructField(n, _S) for n in ("country", "geographicArea", "city", "postalCode", "line1", "line2")])
ENTITY = T.StructType([T.StructField(n, _S) for n in (
    "$type", "entityUrn", "universalName", "name", "localizedName", "tagline", "websiteUrl", "companyPageUrl", "url", "description",
    "employeeCount", "phone", "parentCompany", "*parentCompany")] + [
    T.StructField("*industryV2Taxonomy", T.ArrayType(_S)), T.StructField("*industry", T.ArrayType(_S)),
    T.StructField("specialities", T.ArrayType(_S)), T.StructField("specialties", T.ArrayType(_S)),
    T.StructField("employeeCountRange", T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
    T.StructField("foundedOn", T.StructType([T.StructField("year", _S)])),
    T.StructField("headquarter", T.StructType([T.StructField("address", _ADDRESS), T.StructField("description", _S)]))])
BLOCK = T.StructType([T.StructField("included", T.ArrayType(ENTITY))])


def squeeze(c) -> Column:
    return trim_ws(F.regexp_replace(col(c), r"\s+", " "))


def data_blocks(html) -> Column:
    """JSON texts of the page's code blocks, comment wrapping removed, raw control characters escaped."""
    codes = F.regexp_extract_all(col(html), F.lit(r'(?s)<code[^>]*id="[^"]*"[^>]*>(.*?)</code>'), F.lit(1))

    def clean(c):
        t = trim_ws(F.regexp_replace(F.regexp_replace(trim_ws(c), r"\A<!--", ""), r"-->\z", ""))
        for char, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            t = F.replace(t, F.lit(char), F.lit(esc))
        return t
    return F.filter(F.transform(codes, clean), is_json_object)


def page_name(html) -> Column:
    """Company name in the page title."""
    title = match_group(html, r"(?s)<title[^>]*>(.*?)</title>")
    return trim_ws(F.replace(F.replace(title, F.lit(": About | LinkedIn"), F.lit("")), F.lit("| LinkedIn"), F.lit("")))


def pick_company(included: Column, company_id: Column, name: Column) -> Column:
    """Company entity of a block by four priorities: id, page name, page name as id, first one."""
    companies = F.filter(included, lambda e: F.contains(e["$type"], F.lit("organization.Company")))
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    has_name = F.coalesce(name, F.lit("")) != ""
    tests = [lambda e: F.lower(e["universalName"]) == F.lower(company_id),
             lambda e: has_name & (F.lower(squeeze(e["name"])) == F.lower(name)),
             lambda e: has_name & (plain(e["universalName"]) != "") & (plain(e["universalName"]) == plain(name)),
             lambda e: F.lit(True)]
    return F.coalesce(*[F.get(F.filter(companies, t), F.lit(0)) for t in tests])


def industries(included: Column, company: Column) -> Column:
    """Names of the industry entities the company points to, joined inside the block."""
    urns = F.coalesce(F.when(F.size(company["*industryV2Taxonomy"]) > 0, company["*industryV2Taxonomy"]), company["*industry"])
    hits = F.filter(included, lambda e: F.contains(e["$type"], F.lit("Industry")) & F.array_contains(urns, e["entityUrn"]))
    names = F.filter(F.transform(hits, lambda e: trim_ws(first_filled(e["name"], e["localizedName"]))), lambda n: n.isNotNull())
    return F.nullif(F.array_join(names, ", "), F.lit(""))


def company_records(pages: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Records of ``(id, url, raw_html)`` profile captures, with the columns of ``carry`` after them. The first
    block with a company counts; each later stage is its own column, read several times by the next."""
    blocks = F.transform(data_blocks("raw_html"), lambda j: F.from_json(j, BLOCK)["included"])
    useful = F.filter(blocks, lambda b: F.exists(F.coalesce(b, F.array().cast(T.ArrayType(ENTITY))), lambda e: F.contains(e["$type"], F.lit("organization.Company"))))
    rows = pages.select("id", "url", *carry, page_name("raw_html").alias("_name"), F.get(useful, F.lit(0)).alias("_inc"))
    rows = rows.withColumn("c", pick_company(F.col("_inc"), F.col("id"), F.col("_name"))).withColumn("_industry", industries(F.col("_inc"), F.col("c")))
    none, a, r = F.lit(NO_INFO), F.col("c.headquarter.address"), F.col("c.employeeCountRange")
    size = F.when((r["start"] > 0) & (r["end"] > 0), F.concat(r["start"].cast("string"), F.lit("-"), r["end"].cast("string"), F.lit(" employees"))).when(
        r["start"] > 0, F.concat(r["start"].cast("string"), F.lit("+ employees")))
    skills = F.array_join(F.transform(F.coalesce("c.specialities", "c.specialties"), squeeze), ", ")
    place = F.array_join(F.filter(F.array(*[squeeze(a[n]) for n in ("line1", "line2", "city", "geographicArea", "country")]),
                                  lambda s: F.coalesce(s, F.lit("")) != ""), ", ")
    return rows.select(
        "id", "url", first_filled(squeeze("c.name"), F.col("_name"), F.col("id")).alias("company_name"), squeeze("c.tagline").alias("tagline"),
        first_filled("c.websiteUrl", "c.companyPageUrl", "c.url", none).alias("website"), first_filled("_industry", none).alias("industry"),
        first_filled(size, none).alias("company_size"), first_filled("c.employeeCount", none).alias("employee_count"),
        first_filled("c.foundedOn.year", none).alias("founded"), first_filled(skills, none).alias("specialties"),
        first_filled(F.trim("c.phone"), none).alias("phone"), first_filled("c.parentCompany", F.col("c.`*parentCompany`"), none).alias("parent_company"),
        first_filled(place, none).alias("hq_location"), trim_ws(a["country"]).alias("hq_country"), squeeze(a["geographicArea"]).alias("hq_geographic_area"),
        squeeze(a["city"]).alias("hq_city"), trim_ws(a["postalCode"]).alias("hq_postal_code"), squeeze(a["line1"]).alias("hq_line1"),
        squeeze(a["line2"]).alias("hq_line2"), squeeze("c.headquarter.description").alias("hq_description"),
        first_filled(F.regexp_replace(trim_ws("c.description"), r"\n {2,}", "\n"), none).alias("overview"), *carry)


# Terms of a profile's definition list and the record field they fill.
DL_FIELDS = {"website": "website", "industry": "industry", "company size": "company_size", "headquarters": "hq_location",
             "founded": "founded", "specialties": "specialties"}


def definition_fields(pairs: Column) -> dict[str, Column]:
    """Record fields of ``array<struct<key,value>>`` definition pairs; the last matching term wins."""
    last = lambda term: F.get(F.reverse(F.filter(pairs, lambda p: F.contains(p["key"], F.lit(term)))), F.lit(0))
    return {f: last(term)["value"] for term, f in DL_FIELDS.items()}


def fill_missing(records: DataFrame, fallback: dict[str, Column]) -> DataFrame:
    """Placeholder fields take the fallback value where there is one."""
    for f, v in fallback.items():
        records = records.withColumn(f, first_filled(F.nullif(f, F.lit(NO_INFO)), v, F.lit(NO_INFO)))
    return records


# Detail lines of the company page, in order.
_DETAILS = [("업종 (Industry)", "industry"), ("회사 규모 (Company Size)", "company_size"), ("실제 직원 수 (Employee Count)", "employee_count"),
            ("설립년도 (Founded)", "founded"), ("연락처 (Phone)", "phone"), ("모회사 (Parent Company)", "parent_company")]
_OFFICE = [("통합 주소", "hq_location"), ("국가 (Country)", "hq_country"), ("지역 (State/Province)", "hq_geographic_area"), ("도시 (City)", "hq_city"),
           ("우편번호 (Postal Code)", "hq_postal_code"), ("상세 주소 1 (Line 1)", "hq_line1"), ("상세 주소 2 (Line 2)", "hq_line2"),
           ("본사 설명 (Location Note)", "hq_description")]
_FRONT = ["tagline", "website", "industry", "company_size", "employee_count", "hq_country", "hq_geographic_area", "hq_city", "hq_postal_code",
          "hq_line1", "hq_line2", "hq_description", "founded", "specialties"]


def company_markdown(records: DataFrame) -> DataFrame:
    """Markdown page of each record."""
    v = lambda c: first_filled(c, F.lit(NO_INFO))
    q = lambda k, c: F.concat(F.lit(f'{k}: "'), c, F.lit('"\n'))
    item = lambda pairs: [F.concat(F.lit(f"* **{k}:** "), v(c), F.lit("\n")) for k, c in pairs]
    site = F.when(F.startswith("website", F.lit("http")), F.col("website")).otherwise("#")
    tagline = F.when(F.coalesce("tagline", F.lit("")) != "", F.concat(F.lit("> **"), "tagline", F.lit("**\n"))).otherwise("")
    skills = F.array_join(F.transform(F.split("specialties", ", "), lambda s: F.concat(F.lit("* "), s)), "\n")
    return records.select("id", F.concat(
        F.lit("---\n"), q("company_id", F.col("id")), q("company_name", F.col("company_name")), *[q(f, v(f)) for f in _FRONT],
        q("linkedin_", F.col("url")), q("phone", v("phone")), q("parent_company", v("parent_company")), F.lit("---\n\n# 🏢 회사 소개: "), F.col("company_name"),
        F.lit("\n"), tagline, F.lit("\n## 📝 회사 개요 (Overview)\n"), v("overview"), F.lit("\n\n---\n\n## ⚙️ 상세 정보 (Details)\n* **공식 웹사이트:** [바로가기]("), site,
        F.lit(") ("), v("website"), F.lit(")\n"), *item(_DETAILS), F.lit("\n---\n\n## 📍 본사 위치 정보 (Headquarters)\n"), *item(_OFFICE),
        F.lit("\n---\n\n## 🚀 주요 전문 분야 (Specialties)\n"), skills, F.lit("\n")).alias("markdown"))
