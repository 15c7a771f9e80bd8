"""Summaries of the three pools: one tall table (section, label, value) each.

All facets of a pool come out of one pass and one shuffle; the numbers beside them are one more
aggregate.  A consumer reads a section by its name and gets it most frequent first with ``ranked``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import rules, text
from postlens.operators import facets

#: Facets of the pools: section to column; the first of each pair of tables counts values, the second elements.
OPEN = ({"salary_disclosure": "salary_status", "sources": "source", "sap_focus": "sap_focus", "primary_locations": "primary_location", "role_families": "role_family", "seniority": "seniority"}, {"modules": "modules", "skills": "skills"})
LINKS = (
    {"locations": "location", "queries": "query", "query_locations": "query_location", "query_filters": "query_filter", "role_families": "role_family", "seniority": "seniority"},
    {"modules": "modules", "skills": "skills", "soft_skills": "soft_skills", "degree_levels": "degree_levels", "degree_fields": "degree_fields"},
)
CAREERS = (OPEN[0] | {"providers": "provider", "companies": "company"}, OPEN[1])
#: Rule tables that are looked up in title and excerpt.
BY_EXCERPT = {"soft_skills": rules.SOFT_SKILLS, "degree_levels": rules.DEGREE_LEVELS, "degree_fields": rules.DEGREE_FIELDS}
ROW = ("section", "label", "value")


def counted(rows: DataFrame, single: Mapping[str, str], multi: Mapping[str, str], tagged: Mapping[str, tuple[Column, Mapping[str, str]]] | None = None) -> DataFrame:
    """Counts of all facets as (section, label, value); null and empty labels are left out."""
    named = rows.withColumns({f"_f_{n}": F.col(c) for n, c in (*single.items(), *multi.items())})
    found = facets.facets(named, [f"_f_{n}" for n in single], [f"_f_{n}" for n in multi], tagged)
    return found.select(F.regexp_replace("facet", "^_f_", "").alias("section"), "label", F.col("n").cast("double").alias("value"))


def numbers(one: DataFrame, section: str = "totals") -> DataFrame:
    """A row of numbers as (section, label, value)."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("value")) for c in one.columns]))
    return one.select(cells.alias("c")).select(F.lit(section).alias("section"), "c.label", "c.value")


def seen(rows: DataFrame, snapshot: str) -> list[Column]:
    at = lambda c: F.count_if(F.coalesce(F.col(c) == snapshot, F.lit(False)))
    return [F.count("*").alias("jobs_collected"), at("last_seen_snapshot").alias("jobs_seen_in_snapshot"), at("first_seen_snapshot").alias("new_jobs_in_snapshot")]


def _excerpt_text() -> Column:
    return F.concat_ws(" ", text.normalize_space(F.col("title")), text.normalize_space(F.col("description_excerpt")))


def _of_excerpts(rows: DataFrame) -> tuple[DataFrame, dict]:
    body = rows.withColumn("_excerpt", F.trim(_excerpt_text()))
    return body, {name: (F.col("_excerpt"), table) for name, table in BY_EXCERPT.items()}


def _terms(rows: DataFrame) -> DataFrame:
    return facets.term_frequencies(rows, _excerpt_text()).select(F.lit("description_terms").alias("section"), "label", F.col("n").cast("double").alias("value"))


def _sources(registry: DataFrame | None, raw: DataFrame | None) -> DataFrame | None:
    """Raw rows per registered source, 0 for one that failed or gave none."""
    if registry is None or raw is None:
        return None
    return facets.source_counts(registry, raw).select(F.lit("raw_source_counts").alias("section"), F.col("source").alias("label"), F.col("n").cast("double").alias("value"))


def _union(parts: Sequence[DataFrame | None]) -> DataFrame:
    there = [p.select(*ROW) for p in parts if p is not None]
    out = there[0]
    for p in there[1:]:
        out = out.unionByName(p)
    return out


def open_summary(rows: DataFrame, registry: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
    """Summary of the open feeds' classified rows; the shares of tags are those of title and excerpt."""
    body, tagged = _of_excerpts(rows)
    total = rows.agg(F.count("*").alias("sap_jobs_after_filter"), F.count_distinct(F.nullif("primary_location", F.lit(""))).alias("distinct_locations"))
    return _union([numbers(total), counted(body, *OPEN, tagged), _terms(rows), _sources(registry, raw)])


def link_summary(rows: DataFrame, snapshot: str) -> DataFrame:
    """Summary of the link pool's classified rows: coverage, searches, and its facets."""
    covered = facets.coverage(rows, snapshot).select(
        F.col("n_searches").alias("search_partitions_collected"), F.col("n_searches").alias("searches_attempted"), F.col("n_rows").alias("jobs_collected"), F.col("n_seen").alias("jobs_seen_in_snapshot"),
        F.col("n_new").alias("new_jobs_in_snapshot"), F.col("n_described").alias("description_enriched_jobs"), F.col("described_share").alias("description_enriched_share"),
    )
    return _union([numbers(covered), counted(rows, *LINKS)])


def career_summary(rows: DataFrame, snapshot: str, runs: DataFrame | None = None, registry: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
    """Summary of the career pool's classified rows: that of the open feeds, providers, companies, and its runs.

    ``runs`` has one row per collected source: provider, source_key, source_label, raw_count,
    sap_count, duration_seconds; see ``source_runs``.
    """
    body, tagged = _of_excerpts(rows.withColumns({c: F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")) for c in ("provider", "company")}))
    total = rows.agg(*seen(rows, snapshot), F.count("*").alias("sap_jobs_after_filter"), F.count_distinct(F.nullif("primary_location", F.lit(""))).alias("distinct_locations"))
    per_run = None
    if runs is not None:
        cells = [F.struct(F.concat_ws(" / ", "provider", "source_key", F.lit(c)).alias("label"), F.col(c).cast("double").alias("value")) for c in ("raw_count", "sap_count", "duration_seconds")]
        per_run = runs.select(F.explode(F.array(*cells)).alias("c")).select(F.lit("source_runs").alias("section"), "c.label", "c.value")
    return _union([numbers(total), counted(body, *CAREERS, tagged), _terms(rows), _sources(registry, raw), per_run])


def source_runs(runs: DataFrame) -> DataFrame:
    """Runs in the order of their labels."""
    return runs.select("provider", "source_key", "source_label", "raw_count", "sap_count", "duration_seconds").orderBy("source_label", "provider", "source_key")


def ranked(summary: DataFrame, section: str) -> DataFrame:
    """A section's labels, most frequent first, then by label."""
    return summary.where(F.col("section") == section).select("label", "value").orderBy(F.desc("value"), "label")


def top_maps(summary: DataFrame, k: int = 5, sections: Sequence[str] = ("modules", "primary_locations")) -> DataFrame:
    """``section``, ``top``: a map of the k most frequent labels of each section, for the index of snapshots."""
    some = summary.where(F.col("section").isin(*sections)).select(F.col("section").alias("facet"), "label", F.col("value").cast("bigint").alias("n"))
    best = facets.top_per_facet(some, k).groupBy(F.col("facet").alias("section"))
    return best.agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("rank", "label", "n"))), lambda x: F.struct(x["label"], x["n"]))).alias("top"))
