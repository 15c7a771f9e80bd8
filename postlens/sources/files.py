"""Tolerant readers and the writers of pools, summaries and snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    statuses = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(statuses)


def text_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as rows of ``value``: the plain file, else the ``.gz`` beside it, else no row."""
    for candidate in (path, path + ".gz"):
        if _exists(spark, candidate):
            return spark.read.text(candidate, wholetext=True)
    return spark.createDataFrame([], "value string")


def rows_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON rows with the schema; missing files give no row, unreadable ones no row either."""
    for candidate in (path, path + ".gz"):
        if _exists(spark, candidate):
            return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).json(candidate)
    return spark.createDataFrame([], schema)


def document_or_empty(spark: SparkSession, path: str) -> dict:
    """One small JSON document; ``{}`` if it is missing, invalid or no object."""
    found = text_or_empty(spark, path).first()
    try:
        made = json.loads(found["value"]) if found else {}
    except ValueError:
        return {}
    return made if isinstance(made, dict) else {}


def listed(spark: SparkSession, path: str, fallback: str | None = None) -> list[str]:
    """Lines of a small configuration list, without blanks and ``#`` comments, in order; else the comma-separated fallback."""
    if _exists(spark, path):
        lines = spark.read.text(path, wholetext=True).first()["value"].split("\n")
        return [x.strip() for x in lines if x.strip() and not x.strip().startswith("#")]
    return [x.strip() for x in (fallback or "").split(",") if x.strip()]


def worker_outputs(spark: SparkSession, pattern: str, schema: StructType | str) -> DataFrame:
    """Rows of all workers' files with ``worker``, the name of each file's folder."""
    rows = spark.read.schema(schema).option("multiLine", True).json(pattern)
    return rows.withColumn("worker", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def flat(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in their order as text, arrays joined by ``"; "``, missing ones and nulls empty."""
    kinds = dict(rows.dtypes)

    def cell(c: str):
        if c not in kinds:
            return F.lit("").alias(c)
        value = F.array_join(c, "; ") if kinds[c].startswith("array") else F.col(c).cast("string")
        return F.coalesce(value, F.lit("")).alias(c)

    return rows.select(*[cell(c) for c in columns])


def write_csv(rows: DataFrame, path: str, columns: Sequence[str], compression: str = "none") -> None:
    flat(rows, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", compression).csv(path)


def write_json(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Rows as JSON; the committer makes the folder appear whole or not at all."""
    rows.write.mode("overwrite").option("compression", compression).option("ignoreNullFields", False).json(path)


def write_snapshot(rows: DataFrame, path: str, date: str) -> None:
    """Rows as the partition of a date; other dates stay as they are."""
    dated = rows.withColumn("snapshot_date", F.lit(date))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def write_raw(dumps: DataFrame, path: str, source: str, date: str) -> None:
    """A source's dump (one JSON text per row in ``value``) as it came, in the partition of its source and date."""
    named = dumps.select("value", F.lit(source).alias("source"), F.lit(date).alias("date"))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "date").parquet(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Named tables, each a folder of JSON rows below the path."""
    for name, rows in tables.items():
        write_json(rows, f"{path}/{name}")


def write_snapshot_summary(summary: DataFrame, path: str, date: str) -> None:
    """A pool's summary (section, label, value) as the partition of a date, beside the snapshot's rows."""
    write_snapshot(summary, f"{path}/summary", date)


def snapshot_index(spark: SparkSession, path: str) -> DataFrame:
    """``date``, ``total``, ``top_modules``, ``top_locations`` of every snapshot with a summary, by date."""
    from postlens.operators.facets import top_per_facet

    rows = spark.read.parquet(f"{path}/summary").withColumn("date", F.col("snapshot_date").cast("string"))
    counts = rows.where(F.col("section").isin("modules", "primary_locations")).select(F.concat_ws("|", "date", "section").alias("facet"), "label", F.col("value").cast("bigint").alias("n"))
    best = top_per_facet(counts, 5).groupBy("facet").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("rank", "label", "n"))), lambda x: F.struct(x["label"], x["n"]))).alias("top"))
    split = best.select(F.split_part("facet", F.lit("|"), F.lit(1)).alias("date"), F.split_part("facet", F.lit("|"), F.lit(2)).alias("section"), "top")
    of = lambda section, name: split.where(F.col("section") == section).select("date", F.col("top").alias(name))
    totals = rows.where("section = 'totals' AND label = 'sap_jobs_after_filter'").select("date", F.col("value").cast("bigint").alias("total"))
    return totals.join(of("modules", "top_modules"), "date", "left").join(of("primary_locations", "top_locations"), "date", "left").orderBy("date")


def snapshot_dates(spark: SparkSession, path: str) -> list[str]:
    return sorted(str(r[0]) for r in spark.read.parquet(path).select("snapshot_date").distinct().collect())
