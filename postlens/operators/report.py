"""Report tables: search over the table, labels, bars, narrative levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the feeds and providers in reports.
SOURCE_LABELS = {
    "himalayas": "Himalayas", "remotefirst": "RemoteFirstJobs", "jobicy": "Jobicy", "remotive": "Remotive", "remoteok": "Remote OK", "arbeitnow": "Arbeitnow",
}


def label_of(value: Column, labels: dict[str, str] = SOURCE_LABELS) -> Column:
    from postlens.functions.rules import lookup

    return lookup(value, labels)


def search(rows: DataFrame, term: str = "", columns: tuple[str, ...] = ("title", "company", "primary_location", "role_family"), **equal: str) -> DataFrame:
    """Rows whose lowered columns together hold the term and whose other columns equal the given values (empty: any)."""
    out = rows
    if term:
        out = out.where(F.lower(F.concat_ws(" ", *columns)).contains(term.lower()))
    for column, value in equal.items():
        if value:
            out = out.where(F.col(column) == value)
    return out


def unknown_filters(names: list[str]) -> list[str]:
    """Names that are no search filter, in order."""
    from postlens.functions.rules import SEARCH_FILTERS

    return [n for n in dict.fromkeys(names) if n not in SEARCH_FILTERS]


def search_filter(rows: DataFrame, name: str, at: Column, now: Column, model: Column) -> DataFrame:
    """Rows that a named search filter keeps: not older than its seconds before ``now``, of its work model."""
    from postlens.functions.rules import SEARCH_FILTERS

    if unknown_filters([name]):
        raise ValueError(f"unknown filter {name}")
    seconds, wanted = SEARCH_FILTERS[name]
    out = rows if seconds is None else rows.where(F.timestamp_diff("SECOND", at, now) <= seconds)
    return out if wanted is None else out.where(model == wanted)


def bars(counts: DataFrame) -> DataFrame:
    """Counts with a bar's width in percent of the largest, at least 4; labels without count drop out."""
    largest = counts.agg(F.max("n").alias("top"))  # one row
    return counts.where("n > 0").crossJoin(F.broadcast(largest)).select("label", "n", F.greatest(F.lit(4.0), 100.0 * F.col("n") / F.col("top")).alias("width"))


def keyword_label(c: Column) -> Column:
    """A keyword without its product prefix; null for the product itself."""
    return F.when(c != "SAP", F.regexp_replace(c, r"^SAP ", ""))


def salary_text(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """``low-high currency period`` with what there is; empty for no amount.  Null, blank and 0 are no amount."""
    amount = lambda c: F.when(~F.coalesce(F.trim(c), F.lit("")).isin("", "0"), F.trim(c))
    a, b = amount(low), amount(high)
    number = F.when(a == b, a).otherwise(F.concat_ws("-", a, b))
    return F.when(a.isNull() & b.isNull(), F.lit("")).otherwise(F.concat_ws(" ", number, F.nullif(F.trim(currency), F.lit("")), F.nullif(F.trim(period), F.lit(""))))


def level(share: Column, bounds: tuple[float, ...], names: tuple[str, ...]) -> Column:
    """Name of the first bound that the share stays under; the last name from the last bound on."""
    out = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names, strict=False))):
        out = F.when(share < bound, F.lit(name)).otherwise(out)
    return out


def percent(part: Column, total: Column) -> Column:
    """Share in percent to one digit; 0 where the total is 0."""
    return F.coalesce(F.round(F.try_divide(part * 100.0, total), 1), F.lit(0.0))


def thousands(c: Column) -> Column:
    """A whole number with commas between its thousands."""
    return F.format_number(c.cast("bigint"), 0)


def date_of(c: Column) -> Column:
    """The date of an ISO stamp: its first ten characters; null for an empty one."""
    return F.nullif(F.substring(F.coalesce(c, F.lit("")), 1, 10), F.lit(""))


def history_counts(rows: DataFrame, value: str, date: str = "date") -> DataFrame:
    """``date``, ``value`` of the snapshots that have a date and a value above 0."""
    kept = rows.where((F.coalesce(F.col(date), F.lit("")) != "") & (F.coalesce(F.col(value), F.lit(0)) > 0))
    return kept.select(F.col(date).alias("date"), F.col(value).cast("bigint").alias("value"))


def choices(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``field``, ``value``: the different filled values of each column, sorted: what a table's filters offer."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).select("p.field", "p.value").where("value IS NOT NULL AND value != ''").distinct().orderBy("field", "value")


def in_link_order(rows: DataFrame) -> DataFrame:
    """Rows by query, location, company and title; a missing value stands where an empty one does."""
    return rows.orderBy(*[F.coalesce(F.col(c), F.lit("")) for c in ("query", "location", "company", "title")])


def tables(summaries: dict[str, DataFrame], history: DataFrame) -> dict[str, DataFrame]:
    """The report's tables by name: each pool's summary, and the history; what a page embeds."""
    return {**{f"{name}_summary": s for name, s in summaries.items()}, "history": history}
