"""Snapshot history: consolidation of sources, deltas between days, growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consolidate(parts: Sequence[DataFrame], date: str = "date", numbers: Sequence[str] = (), texts: Sequence[str] = (), latest: Sequence[str] = ()) -> DataFrame:
    """One row per date from several sources, later sources first: the last non-zero number (else 0),
    the last non-empty text (else ``""``), the greatest of the ``latest`` stamps."""
    tagged = None
    for k, p in enumerate(parts):
        have = p.columns
        cols = [F.col(date)] + [(F.col(c) if c in have else F.lit(None)).cast("double" if c in numbers else "string").alias(c) for c in (*numbers, *texts, *latest)]
        one = p.select(*cols, F.lit(k).alias("_k"))
        tagged = one if tagged is None else tagged.unionByName(one)
    aggs = [F.coalesce(F.max_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit(0.0)) != 0, F.col("_k"))), F.lit(0.0)).alias(c) for c in numbers]
    aggs += [F.coalesce(F.max_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("_k"))), F.lit("")).alias(c) for c in texts]
    aggs += [F.max(c).alias(c) for c in latest]
    return tagged.where(F.col(date).isNotNull()).groupBy(date).agg(*aggs)


def net_new(rows: DataFrame, before: str = "jobs_before", after: str = "jobs_after", status: str = "status") -> DataFrame:
    """``net_new`` is counted only for completed runs, else 0; ``raw_difference`` always."""
    gain = F.coalesce(F.col(after), F.lit(0)) - F.coalesce(F.col(before), F.lit(0))
    return rows.withColumns({"net_new": F.when(F.col(status) == "completed", gain).otherwise(F.lit(0)).cast("bigint"), "raw_difference": gain.cast("bigint")})


def day_over_day(rows: DataFrame, date: str, value: str, series: str | None = None) -> DataFrame:
    """Difference to the date before, within each series; null for the first date.

    The window runs over one row per date and series, so its partitions are small.
    """
    w = Window.partitionBy(*([series] if series else [F.lit(0)])).orderBy(date)
    return rows.withColumn("growth", F.col(value) - F.lag(value).over(w))


def index_entries(summaries: DataFrame, signals: DataFrame, pools: DataFrame, date: str = "date") -> DataFrame:
    """Index of snapshots: summaries with the signal and pool of their date, 0 and ``""`` where there is none."""
    out = summaries.join(signals, date, "left").join(pools, date, "left")
    kinds = dict(out.dtypes)
    fill = {c: F.coalesce(F.col(c), F.lit("") if kinds[c] == "string" else F.lit(0).cast(kinds[c])) for c in (*signals.columns, *pools.columns) if c != date and (kinds[c] == "string" or kinds[c] in ("int", "bigint", "double"))}
    return out.withColumns(fill)


def merge_statistics(pool: DataFrame, shards: DataFrame, key: str, shard: str) -> DataFrame:
    """Rows and net new keys of each shard; a key that several shards bring counts for the first by name."""
    fresh = shards.join(pool.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min(shard).alias(shard))
    new = fresh.groupBy(shard).agg(F.count("*").alias("n_net_new"))
    return shards.groupBy(shard).agg(F.count("*").alias("n_rows")).join(new, shard, "left").select(shard, "n_rows", F.coalesce("n_net_new", F.lit(0)).alias("n_net_new"))
