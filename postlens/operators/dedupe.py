"""Exact-key deduplication: the first row in an explicit order survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import normalize_space, stable_id


def key_of(*parts: Column) -> Column:
    """Normalised, lowered parts joined by ``|``; null parts are empty."""
    return F.lower(F.concat_ws("|", *[normalize_space(p) for p in parts]))


def first_wins(rows: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """Of each key the row that comes first in ``order`` (which should end with a unique column).

    A minimum per key combines on the map side, so a key that holds a third of all rows costs one
    row per task; a window would collect the key's rows in one task.  Null keys form one group.
    """
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    whole = F.struct(*[F.col(c) for c in rows.columns])
    best = rows.withColumn("_k", key).groupBy("_k").agg(F.min_by(whole, packed).alias("_row"))
    return best.select("_row.*")


def posting_key(job_id: Column, title: Column, company: Column, location: Column, url: Column) -> Column:
    """The id of the posting where there is one, else a hash of what describes it."""
    return F.coalesce(F.nullif(F.trim(job_id), F.lit("")), stable_id(title, company, location, url))
