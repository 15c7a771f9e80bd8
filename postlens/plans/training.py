"""Queries of the general training-data operator that belongs to the core (problem 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.timestamps import to_instants, zone_report
from postlens.session import spread, table


def job_instants(spark: SparkSession, d: str, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Instants of linkedin_jobs.detail_fetched_at, beside the columns to keep."""
    rows = table(spark, d, "linkedin_jobs").select(*dict.fromkeys([*keep, "detail_fetched_at", "worker_id", "ingested_at"]))
    return to_instants(spread(rows), "detail_fetched_at", "worker_id", table(spark, d, "crawl_workers"), "ingested_at", keep=keep)


def feed_instants(spark: SparkSession, d: str) -> DataFrame:
    """Instants of sap_jobs.posted_at by row."""
    rows = table(spark, d, "sap_jobs").select("row_id", "posted_at", "source", "ingested_at")
    return to_instants(spread(rows), "posted_at", "source", table(spark, d, "feed_registry"), "ingested_at")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each value of the two fields that names an instant, in milliseconds since 1970 UTC."""
    feeds = feed_instants(spark, d).select(F.lit("sap_jobs").alias("table_name"), "row_id", "epoch_ms")
    jobs = job_instants(spark, d).select(F.lit("linkedin_jobs").alias("table_name"), "row_id", "epoch_ms")
    return feeds.unionByName(jobs).where(F.col("epoch_ms").isNotNull())


def p1_zones(spark: SparkSession, d: str) -> DataFrame:
    """Declared and estimated zone of each feed and worker."""
    feeds = zone_report(table(spark, d, "sap_jobs"), "posted_at", "source", table(spark, d, "feed_registry"), "ingested_at")
    jobs = zone_report(table(spark, d, "linkedin_jobs"), "detail_fetched_at", "worker_id", table(spark, d, "crawl_workers"), "ingested_at")
    return feeds.unionByName(jobs)


QUERIES = {"p1_found": p1_found, "p1_zones": p1_zones}
SQL: dict[str, str] = {}
