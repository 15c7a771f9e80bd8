"""Incremental pools with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.merge import seen_stamps, upsert, with_history


def seen_stream(rows: DataFrame, key: str, at: str) -> DataFrame:
    """First and last time of each key as a streaming aggregate (update or complete mode)."""
    return seen_stamps(rows, key, at)


def watermarked_counts(rows: DataFrame, at: str, label: str, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Counts per label and window; rows later than the watermark are dropped and state is freed."""
    return rows.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), label).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), label, "n")


def upsert_stream(batches: DataFrame, folder: str, key: str, checkpoint: str, stamp: Callable[[int], tuple[str, str]], keep_if_empty: str | None = None, kept: Sequence[str] = ()):
    """Query that merges every micro-batch into a pool, written as one version folder per batch.

    The pool that a batch reads is never the one it writes; a batch that is run again overwrites its
    own version, so a restart changes nothing.  ``stamp`` gives (time, snapshot) for a batch number.
    """
    spark = batches.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        now, snapshot = stamp(number)
        fresh = with_history(batch.dropDuplicates([key]))
        old = read_pool(spark, folder, number - 1, fresh)
        upsert(old, fresh, key, now, snapshot, keep_if_empty, kept).write.mode("overwrite").parquet(f"{folder}/v{number}")

    return batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_pool(spark: SparkSession, folder: str, number: int, like: DataFrame) -> DataFrame:
    """The pool as of a batch; empty before the first."""
    if number < 0:
        return spark.createDataFrame([], like.schema)
    return spark.read.parquet(f"{folder}/v{number}")
