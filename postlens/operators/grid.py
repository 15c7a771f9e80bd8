"""Search grids: product, slices, shards and their coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def grid(spark: SparkSession, queries: Sequence[str], places: Sequence[str], filters: Sequence[str]) -> DataFrame:
    """Every (query, place, filter) with its number, the filter varying fastest.  Numbers follow from
    the axes' positions, so the product needs neither a sort nor a window."""
    n_places, n_filters = len(places), len(filters)
    size = len(queries) * n_places * n_filters
    pick = lambda values, i: F.get(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    i = F.col("id")
    return spark.range(size).select(
        i.alias("idx"),
        pick(queries, F.floor(i / (n_places * n_filters))).alias("query"),
        pick(places, F.floor(i / n_filters) % n_places).alias("place"),
        pick(filters, i % n_filters).alias("filter"),
    )


def grid_of(axes: Sequence[DataFrame]) -> DataFrame:
    """Product of small tables with one column each, numbered in the order of their columns."""
    out = axes[0]
    for a in axes[1:]:
        out = out.crossJoin(a)
    return out.withColumn("idx", F.row_number().over(Window.orderBy(*out.columns)) - 1)


def slice_of(cells: DataFrame, offset: int, limit: int | None = None) -> DataFrame:
    """Cells from ``offset`` on, at most ``limit``; a filter on their number."""
    kept = cells.where(F.col("idx") >= offset)
    return kept if limit is None else kept.where(F.col("idx") < offset + limit)


def shards(spark: SparkSession, total: int, workers: int, start: int = 0) -> DataFrame:
    """``worker``, ``offset``, ``size``: equal shards of what is left, the last one short; none if nothing is left."""
    left = max(0, total - start)
    each = -(-left // workers) if workers > 0 else 0
    n = -(-left // each) if each else 0
    w = F.col("id")
    return spark.range(n).select((w + 1).cast("int").alias("worker"), (F.lit(start) + w * each).alias("offset"), F.least(F.lit(each), F.lit(left) - w * each).cast("bigint").alias("size"))


def covered(runs: DataFrame) -> DataFrame:
    """Runs (offset, size, attempted) with ``covered_until`` and whether each is complete."""
    return runs.withColumns({"covered_until": F.col("offset") + F.col("attempted"), "complete": F.col("attempted") >= F.col("size")})


def high_watermark(runs: DataFrame, total: int, current: int = 0) -> DataFrame:
    """One row: the number of the next cell, never behind the current one and never beyond the grid."""
    return covered(runs).agg(F.least(F.lit(total), F.greatest(F.lit(current), F.coalesce(F.max("covered_until"), F.lit(0)))).cast("bigint").alias("next_idx"))


def resume(state: dict, fingerprint: str, total: int) -> dict:
    """Crawl state to go on with: reset when the configuration's fingerprint or the grid's size changed."""
    if state.get("fingerprint") != fingerprint or state.get("total") != total:
        return {"fingerprint": fingerprint, "total": total, "next": 0, "history": []}
    return {**state, "next": min(total, int(state.get("next", 0)))}


def advance(state: dict, record: dict, keep: int = 50) -> dict:
    """State after a batch, with the last ``keep`` batch records."""
    reached = min(state["total"], int(record["offset"]) + int(record["attempted"]))
    return {**state, "next": max(state["next"], reached), "history": [*state.get("history", []), record][-keep:]}
