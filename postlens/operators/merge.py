"""Merging new batches into pools: upsert with protected columns, shard merge, seen stamping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEEN = ("first_seen_at", "last_seen_at", "first_seen_snapshot", "last_seen_snapshot")


def with_history(rows: DataFrame, default: str | None = "") -> DataFrame:
    """Rows with all four seen-columns; missing or null ones get the default."""
    return rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in rows.columns else F.lit(default).cast("string") for c in SEEN})


def upsert(old: DataFrame, new: DataFrame, key: str, now: str, snapshot: str, keep_if_empty: str | None = None, kept: Sequence[str] = ()) -> DataFrame:
    """Pool after a batch.  Matched rows take the batch's columns but keep their first-seen stamps; if
    the batch's ``keep_if_empty`` is empty and the pool's is not, the ``kept`` columns stay as well.
    Rows without match stay as they are, new rows get both stamps.  Keys are unique on either side.
    """
    columns = [c for c in old.columns if c not in SEEN and c != key]
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new = F.col(f"n.{key}").isNotNull()
    is_old = F.col(f"o.{key}").isNotNull()
    protect = F.lit(False)
    if keep_if_empty:
        filled = lambda side: F.coalesce(F.trim(F.col(f"{side}.{keep_if_empty}")) != "", F.lit(False))
        protect = is_old & filled("o") & ~filled("n")
    picked = [F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key)]
    for c in columns:
        fresh = is_new & ~protect if c in kept else is_new
        incoming = F.col(f"n.{c}") if c in new.columns else F.col(f"o.{c}")
        picked.append(F.when(fresh, incoming).otherwise(F.col(f"o.{c}")).alias(c))
    stamp = {"at": F.lit(now), "snapshot": F.lit(snapshot)}
    for c in SEEN:
        when = stamp[c.rsplit("_", 1)[1]]
        given = F.col(f"o.{c}")
        picked.append((F.when(is_new & (F.lit(c.startswith("last")) | ~is_old), when).otherwise(given)).alias(c))
    return both.select(*picked)


def split_seen(pool: DataFrame, batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the batch that the pool knows, rows that are new)."""
    known = pool.select(key).distinct()
    return batch.join(known, key, "left_semi"), batch.join(known, key, "left_anti")


def _filled(c: Column) -> Column:
    return F.when(F.trim(c.cast("string")) != "", c)


def merge_shards(rows: DataFrame, key: str, order: Sequence[str], longest: str | None = None, least: Sequence[str] = (), most: Sequence[str] = (), union: Sequence[str] = ()) -> DataFrame:
    """One row per key from rows of several workers: the first filled value of each column in
    ``order``, the longest of one text, the least and most of stamps, the distinct union of lists.

    Everything is an aggregate with partial results, so a hot key is combined before the shuffle;
    only the lists of ``union`` grow with a key, by their distinct values.
    """
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    special = {key, *least, *most, *union, *( [longest] if longest else [])}
    aggs = []
    for c in rows.columns:
        if c == key:
            continue
        if c == longest:
            aggs.append(F.max_by(c, F.struct(F.coalesce(F.length(F.trim(c)), F.lit(0)).alias("n"), F.struct(*[(-F.col(x)).alias(x) if dict(rows.dtypes)[x] in ("int", "bigint") else F.col(x) for x in order]).alias("o"))).alias(c))
        elif c in least:
            aggs.append(F.min(_filled(F.col(c))).alias(c))
        elif c in most:
            aggs.append(F.max(_filled(F.col(c))).alias(c))
        elif c in union:
            value = F.col(c) if dict(rows.dtypes)[c].startswith("array") else F.array_compact(F.array(_filled(F.col(c))))
            aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(value)))).alias(c))
        elif c not in special:
            aggs.append(F.min_by(F.col(c), F.when(_filled(F.col(c)).isNotNull(), rank)).alias(c))
    return rows.groupBy(key).agg(*aggs)


def seen_stamps(rows: DataFrame, key: str, at: str) -> DataFrame:
    """``key``, ``first_seen``, ``last_seen``, ``n_seen``."""
    return rows.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("n_seen"))


def listed(c: Column) -> Column:
    """A text of values parted by ``;`` as a list; null is an empty list."""
    return F.coalesce(F.split(c, ";"), F.array().cast("array<string>"))


def merge_lists(a: Column, b: Column) -> Column:
    """Distinct union in order of first occurrence; values are trimmed, nulls are empty lists, empty values none."""
    none = F.array().cast("array<string>")
    both = F.transform(F.concat(F.coalesce(a, none), F.coalesce(b, none)), lambda v: F.trim(v))
    return F.array_distinct(F.filter(both, lambda v: v != ""))


def with_details(listed: DataFrame, details: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """List rows whose columns are overridden by the detail rows' filled values."""
    d = details.dropDuplicates([key]).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    met = listed.join(d, listed[key] == d["_k"], "left")
    return met.withColumns({c: F.coalesce(_filled(F.col(f"_d_{c}")), F.col(c)) for c in columns}).drop("_k", *[f"_d_{c}" for c in columns])
