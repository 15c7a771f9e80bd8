"""Dumped search pages: a folder per cell of the search grid, anywhere Hadoop paths reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.sources.files import _exists


def _of_no_length(spark: SparkSession, pattern: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in files or [] if f.getLen() == 0]


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``query``, ``location``, ``filter``, ``page``, ``html`` of the pages of each cell, up to the first empty one, where a search ends.

    A cell's folder holds ``cell.json`` (query, location, filter; all null without it) and one HTML
    file per page, in the order of the numbers in their names.  Bytes that are no UTF-8 are replaced.
    """
    root = folder.rstrip("/")
    if not _exists(spark, f"{root}/*/*.html"):
        return spark.createDataFrame([], "query string, location string, filter string, page int, html string")
    found = spark.read.format("binaryFile").load(f"{root}/*/*.html").select("path", "content")
    # the reader passes over files of no length, which end a search like other empty pages
    found = found.unionByName(spark.createDataFrame([(p, bytearray()) for p in _of_no_length(spark, f"{root}/*/*.html")], "path string, content binary"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    number = F.coalesce(F.regexp_replace(name, r"\D", "").try_cast("bigint"), F.lit(0))
    pages = found.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("cell"), number.alias("number"), name.alias("name"), F.decode("content", "UTF-8").alias("html"))
    # a cell has as many pages as a search gives, a few dozen at most
    order = Window.partitionBy("cell").orderBy("number", "name")
    ended = F.max(F.when(F.trim(F.regexp_replace("html", r"(?U)\s+", " ")) == "", 1).otherwise(0)).over(order)
    kept = pages.withColumns({"page": F.row_number().over(order) - 1, "ended": ended}).where("ended = 0")
    if _exists(spark, f"{root}/*/cell.json"):
        about = F.from_json(F.decode("content", "UTF-8"), "query string, location string, filter string")
        cells = spark.read.format("binaryFile").load(f"{root}/*/cell.json").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("_cell"), about.alias("c"))
        met = kept.join(cells, F.col("cell") == F.col("_cell"), "left").select("c.query", "c.location", "c.filter", "page", "html")
    else:
        met = kept.select(*[F.lit(None).cast("string").alias(c) for c in ("query", "location", "filter")], "page", "html")
    return met.withColumn("page", F.col("page").cast("int"))
