"""Rows of the three pools: only relevant ones, with identity, places, tags and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import rules, text
from postlens.operators import enrich

_OWN = ("_title", "_text", "_body", "_sample", "_text_line", "_title_line", "_sample_line")


def _lined(rows: DataFrame, title: Column, company: Column, body: Column, whole_sample: bool) -> DataFrame:
    """Cleaned title, body and whole text with their word lines; the level is read from the title and the
    first 1000 characters of the body or, with ``whole_sample``, of the whole text."""
    out = rows.withColumns({"_title": text.normalize_space(title), "_body": body})
    out = out.withColumn("_text", F.trim(F.concat_ws(" ", "_title", text.normalize_space(company), "_body")))
    out = out.withColumn("_sample", enrich.seniority_sample(F.col("_title"), F.col("_text" if whole_sample else "_body")))
    return rules.with_lines(out, {f"_{n}_line": F.col(f"_{n}") for n in ("text", "title", "sample")})


def _classes(full_tags: bool) -> dict[str, Column]:
    full, line = F.col("_text"), F.col("_text_line")
    tagged = lambda table, default=None: rules.tags(full, table, default, line)
    made = {
        "modules": tagged(rules.MODULES, rules.NO_MODULE),
        "skills": tagged(rules.SKILLS),
        "role_family": rules.first_match(rules.ROLE_RULES, {"title": F.col("_title"), "text": full}, rules.OTHER_ROLE, {"title": F.col("_title_line"), "text": line}),
        "seniority": rules.first_match(rules.SENIORITY_RULES, {"sample": F.col("_sample")}, rules.NO_SENIORITY, {"sample": F.col("_sample_line")}),
        "description_excerpt": text.excerpt(F.col("_body")),
    }
    if full_tags:
        return made | {"soft_skills": tagged(rules.SOFT_SKILLS), "degree_levels": tagged(rules.DEGREE_LEVELS), "degree_fields": tagged(rules.DEGREE_FIELDS)}
    return made | {"match_terms": tagged(rules.STRONG_TERMS)}


def _finished(out: DataFrame, full_tags: bool) -> DataFrame:
    made = out.withColumns(_classes(full_tags))
    return made.withColumn("sap_focus", enrich.focus(F.col("_title"), F.col("_text"), F.col("modules"), title_line=F.col("_title_line"))).drop(*_OWN)


def posting_rows(rows: DataFrame) -> DataFrame:
    """Relevant rows of a feed or career system in the adapters' common shape, with classes and ``salary_status``.

    Rows without title or company, or in which no strong term occurs, are left out before anything
    else is worked out; identity and places are those of the adapter.
    """
    out = _lined(rows, F.col("title"), F.col("company"), text.normalize_space(F.col("description")), whole_sample=False)
    kept = out.where("_title != ''").where(text.normalize_space(F.col("company")) != "").where(rules.any_match(F.col("_text"), rules.STRONG_TERMS, F.col("_text_line")))
    amount = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    status = enrich.salary_state(amount("salary_min"), amount("salary_max"), F.col("_body"))
    return _finished(kept.withColumn("salary_status", status), full_tags=False)


def link_rows(rows: DataFrame) -> DataFrame:
    """All rows of the link pool with identity, cleaned place, tags of the whole text and classes."""
    place = text.clean_place(F.col("location"))
    out = _lined(rows, F.col("title"), F.col("company"), text.normalize_space(F.col("description")), whole_sample=True)
    named = out.withColumns({
        "location": F.coalesce(F.nullif(place, F.lit("")), F.lit("Not specified")),
        "id": text.stable_id(F.lit("linkedin_guest"), F.col("linkedin_job_id"), F.col("url")),
        "source": F.lit("linkedin_guest"),
    })
    return _finished(named, full_tags=True)


def merged_shards(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """Rows of several workers merged by key and enriched again: first filled values in ``order``, the longest
    description, least and latest stamps, all queries, places and filters under which a posting was observed.
    """
    from postlens.operators.merge import merge_shards

    observed = {f"observed_{n}": F.col(c) for n, c in (("queries", "query"), ("query_locations", "query_location"), ("query_filters", "query_filter"))}
    keyed = rows.withColumns(observed).withColumn("_key", key)
    least = [c for c in ("first_seen_at", "first_seen_snapshot") if c in rows.columns]
    most = [c for c in ("last_seen_at", "last_seen_snapshot", "detail_fetched_at") if c in rows.columns]
    made = merge_shards(keyed, "_key", [order], longest="description", least=least, most=most, union=list(observed))
    return link_rows(made.drop("_key"))
