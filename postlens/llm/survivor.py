"""Best representative of each duplicate group, field by field (problem 4).

Fields are unpivoted to long rows (group, field, normalised value, trust, time).  Equal normalised
values of a field vote together: the sum over their rows of source trust times recency decay.
Winners are chosen by the greatest ranking key that the field's policy names, and pivoted back to
one record per group.  Every grouping combines on the map side, so a group with a third of all rows
costs one small row per task, field and value.

A vote weighs 2 ** (time / half-life) / (1 + trust rank).  Only quotients of votes matter within a
group, so no "now" is needed, and nothing that happens in other groups changes a winner.  Sums are
compared by their logarithm to six digits, which hides the order of summing but no vote, however
old.  A time later than the row's bound (its ingestion, if a bound is given) counts as the bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trust rank of a source without one; half-lives between the first moment and the last that votes tell apart.
UNTRUSTED, SPAN = 1_000_000, 900


@dataclass(frozen=True)
class Policy:
    """How a field's winner is chosen.

    ``rank``: at most four ranking keys in order of importance, of: votes (trust times decay summed
    per normalised value), score (the field's own measure, such as the number of distinct words),
    trust (smallest rank first), time (latest instant first, none is earliest).  The smallest row id
    decides last.  A policy with votes is completed by the keys that it doesn't name, in this order, which
    choose among the rows of the winning value.  ``score``: the measure; a row whose score is null or 0 offers no value.
    ``norm``: a column that is equal for values that are the same; by default the field's text in
    lower case with single blanks.
    """

    field: str
    rank: tuple[str, ...] = ("votes", "score", "trust", "time")
    score: str | None = None
    norm: str | None = None

    def keys(self) -> tuple[str, ...]:
        more = [k for k in ("score", "trust", "time") if k not in self.rank] if "votes" in self.rank else []
        return (*self.rank, *more)


def distinct_words(text: Column) -> Column:
    """Words of a text in order, each once: markup parts words, lower case, maximal runs of letters and digits."""
    bare = F.lower(F.regexp_replace(text, "<[^>]*>", " "))
    return F.array_distinct(F.regexp_extract_all(bare, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def n_distinct_words(text: Column) -> Column:
    """Number of different words."""
    return F.size(distinct_words(text))


def long_rows(rows: DataFrame, group: str, row: str, policies: Sequence[Policy], trust: str, time_ms: str, half_life_days: float, latest_ms: str | None) -> DataFrame:
    """Unpivot: one row for each field that offers a value, and one with field "" for the row itself.

    ``log`` is the logarithm of the row's vote, ``k0`` to ``k3`` are the keys of its field's policy
    (0 for votes, which aren't summed yet), ``last`` prefers the smallest row id.
    """
    rank, ms = F.coalesce(F.col(trust).cast("bigint"), F.lit(UNTRUSTED)), F.col(time_ms).cast("bigint")
    seen = F.least(ms, F.col(latest_ms)) if latest_ms else ms
    halves = F.greatest(F.lit(-float(SPAN)), F.least(F.lit(float(SPAN)), seen / F.lit(half_life_days * 86_400_000.0) - F.lit(float(SPAN) / 2)))
    log = F.coalesce(halves, F.lit(-float(SPAN))) - F.log2(F.lit(1.0) + F.greatest(rank, F.lit(0)))
    value_of = {"trust": -rank, "time": F.coalesce(ms, F.lit(-(2**62))), "votes": F.lit(0)}
    items = [F.struct(F.lit("").alias("field"), F.lit(0).cast("bigint").alias("norm"), F.lit(1).cast("bigint").alias("score"), *[F.lit(0).cast("bigint").alias(f"k{i}") for i in range(4)])]
    for p in policies:
        value = F.col(p.field).cast("string")
        norm = F.col(p.norm).cast("bigint") if p.norm else F.xxhash64(F.lower(F.regexp_replace(F.trim(value), r"(?U)\s+", " ")))
        score = F.col(p.score).cast("bigint") if p.score else F.when(F.trim(F.coalesce(value, F.lit(""))) != "", 1).cast("bigint")
        keys = [(score if k == "score" else value_of[k]).cast("bigint") for k in p.keys()]
        keys += [F.lit(0).cast("bigint")] * (4 - len(keys))
        items.append(F.struct(F.lit(p.field).alias("field"), norm.alias("norm"), score.alias("score"), *[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    base = rows.where(F.col(group).isNotNull()).select(F.col(group).alias("_group"), (-F.col(row)).cast("bigint").alias("last"), log.alias("log"), F.explode(F.array(*items)).alias("i"))
    return base.select("_group", "last", "log", "i.*").where("score > 0")


def winning_rows(rows: DataFrame, group: str, row: str, policies: Sequence[Policy], trust: str, time_ms: str, half_life_days: float = 30.0, latest_ms: str | None = None) -> DataFrame:
    """``group``, ``n_rows`` and, per field, ``<field>_<row>``: the row that gives it, null if none offers one.

    A missing trust rank counts as the worst, a missing time as the earliest; a row without time has
    the least vote, which still counts among such rows.  Groups with a null key have no record.
    Ties, also between repeated rows, go to the smallest row id.
    """
    long = long_rows(rows, group, row, policies, trust, time_ms, half_life_days, latest_ms)
    best = F.max(F.struct("k0", "k1", "k2", "k3", "last"))
    values = long.groupBy("_group", "field", "norm").agg(F.sum(F.pow(F.lit(2.0), "log")).alias("votes"), F.count("*").alias("n"), best.alias("best"))
    votes = F.round(F.log2("votes") * 1e6).cast("bigint")
    aggs = [F.sum(F.when(F.col("field") == "", F.col("n"))).alias("n_rows")]
    for p in policies:
        keys = [(votes if k == "votes" else F.col(f"best.k{i}")).alias(f"k{i}") for i, k in enumerate(p.keys())]
        aggs.append((-F.max(F.when(F.col("field") == p.field, F.struct(*keys, F.col("best.last").alias("last"))))["last"]).alias(f"{p.field}_{row}"))
    return values.groupBy("_group").agg(*aggs).withColumnRenamed("_group", group)


def winners(rows: DataFrame, group: str, row: str, policies: Sequence[Policy], trust: str, time_ms: str, least_rows: int = 1, **options) -> DataFrame:
    """``group``, ``field``, ``row``: the records' rows field by field, of groups with at least ``least_rows`` rows; a field that no row offers is left out."""
    wide = winning_rows(rows, group, row, policies, trust, time_ms, **options).where(F.col("n_rows") >= least_rows)
    pairs = F.explode(F.array(*[F.struct(F.lit(p.field).alias("field"), F.col(f"{p.field}_{row}").alias("row")) for p in policies]))
    return wide.select(group, pairs.alias("w")).select(group, "w.field", F.col("w.row").alias(row)).where(F.col(row).isNotNull())


def golden(rows: DataFrame, group: str, row: str, policies: Sequence[Policy], trust: str, time_ms: str, least_rows: int = 1, **options) -> DataFrame:
    """One record per group with each field's value and the row it comes from.

    The values are fetched by one join of the rows with the winners, whatever the number of fields.
    """
    fields = [p.field for p in policies]
    won = winners(rows, group, row, policies, trust, time_ms, least_rows, **options).groupBy(F.col(group).alias("_group"), F.col(row).alias("_row")).agg(F.collect_set("field").alias("_fields"))
    met = rows.select(group, row, *dict.fromkeys(fields)).join(won, (F.col(group) == F.col("_group")) & (F.col(row) == F.col("_row")))
    gives = lambda f: F.array_contains("_fields", f)
    return met.groupBy(group).agg(*[F.max(F.when(gives(f), F.col(c))).alias(n) for f in fields for c, n in ((f, f), (row, f"{f}_{row}"))])
