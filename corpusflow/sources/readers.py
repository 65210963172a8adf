"""Sources: layer tables, JSON and text files, captured API responses, relational stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import col, trim_ws


def is_folder(spark: SparkSession, path: str) -> bool:
    """Is this path of any file system Spark reads a folder?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def read_layer(spark: SparkSession, root: str, layer: str, kind: str, site: str | None = None,
               schema=None) -> DataFrame:
    """Table ``<root>/<layer>/<kind>``; the ``site`` filter prunes partitions."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(f"{root}/{layer}/{kind}")
    return df if site is None else df.where(F.col("site") == site)


def read_json_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON files of one record list each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def url_lines(lines: DataFrame, line: str = "value", http_only: bool = False) -> DataFrame:
    """Addresses of a list file: trimmed, blank and ``#`` lines out, a continuation mark dropped."""
    url = trim_ws(F.regexp_replace(trim_ws(line), r"\\\z", ""))
    rows = lines.select(url.alias("url")).where((F.col("url") != "") & ~F.startswith("url", F.lit("#")))
    return rows.where(F.startswith("url", F.lit("http"))) if http_only else rows


def read_url_list(spark: SparkSession, path: str, http_only: bool = False) -> DataFrame:
    return url_lines(spark.read.text(path), http_only=http_only)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-wise JSON; malformed lines are dropped, not failed on."""
    record = F.from_json("value", schema + ", _corrupt_record string", {"mode": "PERMISSIVE"})
    lines = spark.read.text(path).where("trim(value) <> ''").select(record.alias("r"))
    return lines.where("r IS NOT NULL AND r._corrupt_record IS NULL").select("r.*").drop("_corrupt_record")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None,
              partitions: int = 32, **options) -> DataFrame:
    """Relational table; with a partition column the read is split over ``partitions`` range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]) \
                       .option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def read_markdown_dir(spark: SparkSession, root: str) -> DataFrame:
    """Markdown files ``<root>/<book>/<file>.md`` as ``book, file, title, content, path``."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    return _file_parts(df.select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("path")))


def _file_parts(df: DataFrame) -> DataFrame:
    path = F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    file = F.substring_index(path, "/", -1)
    book = F.element_at(F.split(path, "/"), -2)
    return df.select(book.alias("book"), file.alias("file"), F.regexp_replace(file, r"\.md\z", "").alias("title"), "content", "path")


def list_files(spark: SparkSession, roots: list[str], suffixes: list[str], exclude: str = "/raw/") -> DataFrame:
    """Distinct file paths below the roots with one of the endings; ``raw`` folders are left out.
    Only names and sizes are read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots).select("path", "length")
    ok = F.lit(False)
    for s in suffixes:
        ok = ok | F.endswith(F.lower("path"), F.lit(s))
    return df.where(ok & ~F.contains("path", F.lit(exclude))).dropDuplicates(["path"])


def sitemap_urls(xml, domain: str) -> Column:
    """Article addresses of a sitemap text as ``array<string>``."""
    d = domain.replace(".", "\\.")
    return F.array_distinct(F.regexp_extract_all(col(xml), F.lit(rf"<loc>(https://{d}/magazine/detail/\d+/)</loc>"), F.lit(1)))


def sitemap_rows(maps: DataFrame, xml: str, domain: str) -> DataFrame:
    rows = maps.select(F.explode(sitemap_urls(xml, domain)).alias("url")).distinct()
    return rows.select("url", F.regexp_extract("url", r"/detail/(\d+)/", 1).alias("id"))


NODES = "array<struct<id:string,slug:string,title:string>>"


def api_nodes(responses: DataFrame, keep: list[str], json: str) -> DataFrame:
    """List entries of captured API pages: ``topic_list.topics`` or ``data.posts.nodes``; entries
    without id or slug are dropped."""
    nodes = F.coalesce(*[F.from_json(F.get_json_object(F.col(json), p), NODES) for p in ("$.topic_list.topics", "$.data.posts.nodes")])
    rows = responses.select(*keep, F.posexplode(nodes).alias("pos", "n")).select(*keep, "pos", "n.*")
    return rows.where("coalesce(id, '') <> '' AND coalesce(slug, '') <> ''")
