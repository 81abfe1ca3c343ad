"""Readers for memo exports, page collections, sitemaps and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.functions.html import element_content
from pagequarry.operators.memos import HEADERS

MEMO_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ("Timestamp", *HEADERS)])


def read_memo_export(spark: SparkSession, path: str) -> DataFrame:
    """The CSV export. Cells span lines, so a file is read by one task; split large exports into files.

    Columns are matched by the header, in any order; files whose headers
    differ fail and have to be read one by one. Everything arrives as text: the
    date patterns cannot be inferred.
    """
    options = {"header": True, "enforceSchema": False, "multiLine": True, "quote": '"', "escape": '"'}
    found = spark.read.options(**options).csv(path)
    missing = [F.lit(None).cast("string").alias(name) for name in MEMO_SCHEMA.names if name not in found.columns]
    return found.select(*[F.col(f"`{name}`") for name in found.columns], *missing)


def write_memo_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quoteAll=True, escape='"').csv(path)


def read_table(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet with only the named columns in the scan."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per HTML file: ``url`` is the file's location, ``html`` its content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"))


def raw_pages(pages: DataFrame, content: Column | None = None, html: str = "html") -> DataFrame:
    """``url, text``: main content of each page; pages that failed or have none are dropped."""
    body = element_content(F.col(html)) if content is None else content
    return pages.select("url", F.trim(body).alias("text")).filter(F.col("text").isNotNull())


def read_sitemap(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``position, url`` of every ``loc`` in a sitemap, optionally only the first ``limit``.

    ``position`` grows in file order; it is not dense.
    """
    entries = spark.read.format("xml").schema("loc string").option("rowTag", "url").load(path)
    urls = entries.select(F.monotonically_increasing_id().alias("position"), F.trim("loc").alias("url"))
    return urls if limit is None else urls.orderBy("position").limit(limit)


def write_sitemap(urls: DataFrame, path: str, url: str = "url") -> None:
    root = 'urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    urls.select(F.col(url).alias("loc")).write.mode("overwrite").format("xml").option("rowTag", "url").option(
        "rootTag", root
    ).save(path)
