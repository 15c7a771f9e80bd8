"""Rows of a pool to classified rows: tags, role, focus, seniority, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import rules, text


def focus(title: Column, body: Column, modules: Column, corrected: bool = False, title_line: Column | None = None, line: Column | None = None) -> Column:
    """How central the product is: by title, then by modules, then by mention.

    The tool phrases never match in the compatible mode (they hold capitals, the text is lowered);
    ``corrected`` matches them in any case.
    """
    core, delivery = rules.matches(title, rules.TITLE_CORE, title_line), rules.matches(title, rules.TITLE_DELIVERY, title_line)
    specific = F.coalesce((F.size(modules) > 0) & (modules != F.array(F.lit(rules.NO_MODULE))), F.lit(False))
    tool = rules.matches(body, rules.TOOL_PHRASES, line) if corrected else F.lit(False)
    return (
        F.when(core & delivery, "Core SAP delivery role")
        .when(core, "SAP-titled role")
        .when(specific, "SAP module/technical requirement")
        .when(tool, "SAP required as business tool")
        .otherwise("SAP mentioned")
    )


def salary_state(low: Column, high: Column, body: Column) -> Column:
    """Whether pay is disclosed, mentioned near a pay word, or neither; null, empty and 0 are no amount."""
    given = lambda c: ~F.coalesce(c.cast("string"), F.lit("")).isin("", "0")
    return F.when(given(low) | given(high), "Disclosed").when(rules.matches(body, rules.PAY_PHRASE), "Mentioned in text").otherwise("Not disclosed")


def work_model(place: Column, title: Column, remote: Column) -> Column:
    """remote, hybrid or onsite by the provider's flag and the words of place and title."""
    words = F.concat_ws(" ", place, title)
    return F.when(rules.matches(words, r"\bhybrid\b"), "hybrid").when(F.coalesce(remote, F.lit(False)) | rules.matches(words, r"\bremote\b"), "remote").otherwise("onsite")


def seniority_sample(title: Column, body: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, 1000))


def seniority(title: Column, body: Column) -> Column:
    """By the title and the first 1000 characters of the text; the first level that matches."""
    sample = seniority_sample(title, body)
    return rules.first_match(rules.SENIORITY_RULES, {"sample": sample}, rules.NO_SENIORITY)


def classify(rows: DataFrame, title: str = "title", company: str = "company", description: str = "description", location: str = "location", url: str = "url", job_id: str | None = None, only_matching: bool = False) -> DataFrame:
    """``rows`` with id, cleaned place, excerpt, tags and classes (columns of the same names are replaced).

    ``only_matching`` keeps rows in which a strong term occurs; it runs before the taggers.  Null
    titles, companies and descriptions count as empty.  Long descriptions are read whole.
    """
    known = F.col(job_id) if job_id else F.lit(None).cast("string")
    body = text.html_text(F.col(description))
    out = rows.withColumns({"_title": text.normalize_space(F.col(title)), "_body": body, "_company": text.normalize_space(F.col(company))})
    out = out.withColumns({"_text": F.trim(F.concat_ws(" ", "_title", "_company", "_body")), "_sample": seniority_sample(F.col("_title"), F.col("_body"))})
    # every text's word line is worked out once and looked into by all rules
    out = rules.with_lines(out, {f"_{n}_line": F.col(f"_{n}") for n in ("text", "title", "sample")})
    full, line = F.col("_text"), F.col("_text_line")
    if only_matching:
        out = out.where(rules.any_match(full, rules.STRONG_TERMS, line))
    place = text.clean_place(F.col(location))
    tagged = lambda table, default=None: rules.tags(full, table, default, line)
    made = {
        "id": F.coalesce(F.nullif(F.trim(known), F.lit("")), text.stable_id(F.col(title), F.col(company), F.col(location), F.col(url))),
        "primary_location": F.coalesce(F.nullif(place, F.lit("")), F.lit("Not specified")),
        "description_excerpt": text.excerpt(F.col("_body")),
        "modules": tagged(rules.MODULES, rules.NO_MODULE),
        "skills": tagged(rules.SKILLS),
        "match_terms": tagged(rules.STRONG_TERMS),
        "soft_skills": tagged(rules.SOFT_SKILLS),
        "degree_levels": tagged(rules.DEGREE_LEVELS),
        "degree_fields": tagged(rules.DEGREE_FIELDS),
        "role_family": rules.first_match(rules.ROLE_RULES, {"title": F.col("_title"), "text": full}, rules.OTHER_ROLE, {"title": F.col("_title_line"), "text": line}),
        "seniority": rules.first_match(rules.SENIORITY_RULES, {"sample": F.col("_sample")}, rules.NO_SENIORITY, {"sample": F.col("_sample_line")}),
    }
    out = out.withColumns(made)
    out = out.withColumn("sap_focus", focus(F.col("_title"), full, F.col("modules"), title_line=F.col("_title_line")))
    return out.drop("_title", "_body", "_company", "_text", "_sample", "_text_line", "_title_line", "_sample_line")
