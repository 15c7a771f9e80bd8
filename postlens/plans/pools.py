"""Queries of the pools' rows, summaries and report tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import rules
from postlens.operators import facets, pools, report, run, summary
from postlens.plans.catalogue import q, sql_first, sql_match, sql_places, sql_space, sql_stable
from postlens.session import spread, table, written
from postlens.sources.feeds import normalize_career

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SNAPSHOT = "2026-01-15"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def sql_list(x: str, rules_: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {sql_match(x, p)} THEN {q(label)} END" for label, p in rules_.items())
    return f"list_filter([{cases}], lambda e: e IS NOT NULL)"


_ANY = "(" + " OR ".join(sql_match("x", p) for p in rules.STRONG_TERMS.values()) + ")"
_FOCUS = f"""CASE WHEN {sql_match('t', rules.TITLE_CORE)} AND {sql_match('t', rules.TITLE_DELIVERY)} THEN 'Core SAP delivery role' WHEN {sql_match('t', rules.TITLE_CORE)} THEN 'SAP-titled role'
 WHEN len({sql_list('x', rules.MODULES)}) > 0 THEN 'SAP module/technical requirement' ELSE 'SAP mentioned' END"""
_ROLE = sql_first(rules.ROLE_RULES, {"title": "t", "text": "x"}, rules.OTHER_ROLE)


def _level(body: str) -> str:
    return sql_first(rules.SENIORITY_RULES, {"sample": f"(t || ' ' || substr({body}, 1, 1000))"}, rules.NO_SENIORITY)


_CLASSES = f"{_FOCUS} AS sap_focus, {_ROLE} AS role_family, coalesce(nullif({sql_list('x', rules.MODULES)}, []), [{q(rules.NO_MODULE)}]) AS modules, {sql_list('x', rules.SKILLS)} AS skills"
_PAY = sql_match("b", rules.PAY_PHRASE)
_CAREERS = f"""SELECT row_id, source, coalesce(nullif(provider, ''), 'unknown') AS provider, c AS company, coalesce((ps)[1], CASE WHEN remote THEN 'Remote / Not specified' ELSE 'Not specified' END) AS primary_location, url, first_seen_snapshot, last_seen_snapshot, t, b,
 trim(t || ' ' || substr(b, 1, 420)) AS excerpt, CASE WHEN {_PAY} THEN 'Mentioned in text' ELSE 'Not disclosed' END AS salary_status, {_level('b')} AS seniority, {_CLASSES}
FROM (SELECT *, {sql_space('title')} AS t, {sql_space('company')} AS c, {sql_space('description')} AS b, {sql_places('location')} AS ps, trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_space('description')})) AS x FROM company_career_jobs)
WHERE t != '' AND c != '' AND coalesce(url, '') != '' AND {_ANY}"""
_LINKS = f"""SELECT *, {_level('x')} AS seniority, {_CLASSES}, {sql_list('x', rules.SOFT_SKILLS)} AS soft_skills, {sql_list('x', rules.DEGREE_LEVELS)} AS degree_levels, {sql_list('x', rules.DEGREE_FIELDS)} AS degree_fields
FROM (SELECT row_id, query, query_location, query_filter, description, first_seen_snapshot, last_seen_snapshot, CASE WHEN {sql_match(sql_space('location'), rules.NO_PLACE_TEXT)} OR {sql_space('location')} = '' THEN 'Not specified' ELSE {sql_space('location')} END AS location,
 {sql_space('title')} AS t, trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_space('description')})) AS x FROM linkedin_jobs)"""
_OPEN = f"""SELECT row_id, source, coalesce((ps)[1], CASE WHEN remote THEN 'Worldwide / Not specified' ELSE 'Not specified' END) AS primary_location, t, b, trim(t || ' ' || substr(b, 1, 420)) AS excerpt, {_level('b')} AS seniority, {_CLASSES},
 CASE WHEN coalesce(salary_min, '') NOT IN ('', '0') OR coalesce(salary_max, '') NOT IN ('', '0') THEN 'Disclosed' WHEN {_PAY} THEN 'Mentioned in text' ELSE 'Not disclosed' END AS salary_status
FROM (SELECT *, {sql_space('title')} AS t, {sql_space('company')} AS c, {sql_space('description_excerpt')} AS b, {sql_places('location')} AS ps, trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_space('description_excerpt')})) AS x FROM sap_jobs) WHERE t != '' AND c != '' AND {_ANY}"""
_TERM_SQL = "list_distinct(list_filter(list_transform(regexp_extract_all(lower(t || ' ' || substr(b, 1, 420)), '[a-zA-Z][a-zA-Z0-9+/#.-]{2,}'), lambda w: regexp_replace(w, '^[./-]+|[./-]+$', '', 'g')), lambda w: length(w) >= 4 AND w NOT IN (" + ", ".join(map(q, [*rules.STOP_WORDS, *rules.STOP_TOKENS])) + ")))"


def _sql_summary(base: str, single: dict[str, str], multi: dict[str, str], totals: dict[str, str], excerpts: bool, more: str = "") -> str:
    parts = [f"SELECT 'totals' AS section, {q(n)} AS label, CAST({e} AS DOUBLE) AS value FROM p" for n, e in totals.items()]
    parts += [f"SELECT {q(n)}, CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM p WHERE {c} != '' GROUP BY {c}" for n, c in single.items()]
    parts += [f"SELECT {q(n)}, l, CAST(count(*) AS DOUBLE) FROM (SELECT unnest({c}) AS l FROM p) GROUP BY l" for n, c in multi.items()]
    if excerpts:
        parts += [f"SELECT {q(n)}, l, CAST(count(*) AS DOUBLE) FROM (SELECT unnest({sql_list('excerpt', r)}) AS l FROM p) GROUP BY l" for n, r in summary.BY_EXCERPT.items()]
        parts.append(f"SELECT * FROM (SELECT 'description_terms', l, CAST(count(*) AS DOUBLE) AS n FROM (SELECT unnest({_TERM_SQL}) AS l FROM p) GROUP BY l ORDER BY n DESC, l LIMIT 30)")
    return f"WITH p AS MATERIALIZED ({base}) " + " UNION ALL ".join(parts) + more


def careers(spark: SparkSession, d: str) -> DataFrame:
    """Relevant classified rows of the career pool."""
    return pools.posting_rows(normalize_career(spread(table(spark, d, "company_career_jobs"))))


def links(spark: SparkSession, d: str) -> DataFrame:
    """Classified rows of the link pool."""
    return pools.link_rows(spread(table(spark, d, "linkedin_jobs")))


def opened(spark: SparkSession, d: str) -> DataFrame:
    """Relevant classified rows of the open feeds."""
    from postlens.functions import text

    rows = spread(table(spark, d, "sap_jobs")).withColumn("description", F.col("description_excerpt"))
    places = text.split_places(F.col("location"))
    default = F.when(F.col("remote"), "Worldwide / Not specified").otherwise("Not specified")
    return pools.posting_rows(rows.withColumn("primary_location", text.primary_place(places, default)))


@query(f"SELECT row_id, substr(sha1(concat_ws('|', {', '.join(f'lower({sql_space(c)})' for c in ('source', 'url', 't', 'company'))})), 1, 16) AS id, primary_location, role_family, seniority, sap_focus, salary_status, array_to_string(modules, '; ') AS modules, array_to_string(skills, '; ') AS skills FROM ({_CAREERS})")
def career_rows(spark, d):
    return careers(spark, d).select("row_id", "id", "primary_location", "role_family", "seniority", "sap_focus", "salary_status", F.array_join("modules", "; ").alias("modules"), F.array_join("skills", "; ").alias("skills"))


@query(f"SELECT row_id, location, role_family, seniority, sap_focus, array_to_string(modules, '; ') AS modules, array_to_string(soft_skills, '; ') AS soft_skills, array_to_string(degree_levels, '; ') AS degree_levels FROM ({_LINKS})")
def link_rows(spark, d):
    joined = [F.array_join(c, "; ").alias(c) for c in ("modules", "soft_skills", "degree_levels")]
    return links(spark, d).select("row_id", "location", "role_family", "seniority", "sap_focus", *joined)


_SEEN = {"jobs_collected": "count(*)", "jobs_seen_in_snapshot": f"count(*) FILTER (WHERE last_seen_snapshot = '{SNAPSHOT}')", "new_jobs_in_snapshot": f"count(*) FILTER (WHERE first_seen_snapshot = '{SNAPSHOT}')"}
_KEPT = {"sap_jobs_after_filter": "count(*)", "distinct_locations": "count(DISTINCT nullif(primary_location, ''))"}


@query(_sql_summary(_CAREERS, *summary.CAREERS, _SEEN | _KEPT, True, " UNION ALL SELECT 'raw_source_counts', provider, CAST(count(*) AS DOUBLE) FROM company_career_jobs WHERE provider IS NOT NULL GROUP BY provider"))
def summary_careers(spark, d):
    raw = table(spark, d, "company_career_jobs").select(F.col("provider").alias("source"))
    return summary.career_summary(written(careers(spark, d).drop("description")), SNAPSHOT, registry=raw.distinct(), raw=raw)


_SEARCHED = "count(DISTINCT CASE WHEN trim(coalesce(query, '')) != '' AND trim(coalesce(query_location, '')) != '' THEN (query, query_location, coalesce(query_filter, '')) END)"
_DESCRIBED = f"count(*) FILTER (WHERE length({sql_space('description')}) >= 80)"


@query(_sql_summary(_LINKS, *summary.LINKS, {"search_partitions_collected": _SEARCHED, "searches_attempted": _SEARCHED, **_SEEN, "description_enriched_jobs": _DESCRIBED, "description_enriched_share": f"round({_DESCRIBED} / count(*), 4)"}, False))
def summary_links(spark, d):
    return summary.link_summary(written(links(spark, d)), SNAPSHOT)


@query(_sql_summary(_OPEN, *summary.OPEN, _KEPT, True, " UNION ALL SELECT 'raw_source_counts', f.source, CAST(count(j.row_id) AS DOUBLE) FROM feed_registry f LEFT JOIN sap_jobs j ON j.source = f.source GROUP BY f.source"))
def summary_open(spark, d):
    return summary.open_summary(written(opened(spark, d).drop("description")), table(spark, d, "feed_registry"), table(spark, d, "sap_jobs"))


_RUNS = "SELECT provider, source_key, source AS source_label, count(*) AS raw_count, count(*) FILTER (WHERE trim(coalesce(title, '')) != '') AS sap_count, CAST(max(row_id) - min(row_id) AS DOUBLE) AS duration_seconds FROM company_career_jobs GROUP BY 1, 2, 3"


@query(f"SELECT row_number() OVER (ORDER BY source_label NULLS FIRST, provider NULLS FIRST, source_key NULLS FIRST) AS place, * FROM ({_RUNS})")
def source_runs_careers(spark, d):
    """Runs of the career sources in the order of their labels (title counts and row ids stand for what a run measures)."""
    jobs = table(spark, d, "company_career_jobs")
    named = F.count_if(F.trim(F.coalesce("title", F.lit(""))) != "")
    runs = jobs.groupBy("provider", "source_key", F.col("source").alias("source_label")).agg(F.count("*").alias("raw_count"), named.alias("sap_count"), (F.max("row_id") - F.min("row_id")).cast("double").alias("duration_seconds"))
    ordered = summary.source_runs(runs)
    listed = ordered.agg(F.array_sort(F.collect_list(F.struct("source_label", "provider", "source_key", "raw_count", "sap_count", "duration_seconds"))).alias("r"))  # one row per configured source
    return listed.select(F.posexplode("r").alias("i", "r")).select((F.col("i") + 1).cast("bigint").alias("place"), "r.*")


@query("SELECT 'company' AS field, company AS value FROM company_career_jobs WHERE company != '' GROUP BY 2 UNION ALL SELECT 'provider', provider FROM company_career_jobs WHERE provider != '' GROUP BY 2")
def choices_careers(spark, d):
    return report.choices(table(spark, d, "company_career_jobs"), ("company", "provider"))


@query("SELECT last_seen_snapshot AS date, count(*) AS value FROM linkedin_jobs WHERE last_seen_snapshot != '' GROUP BY 1 HAVING count(*) > 0")
def history_counts_jobs(spark, d):
    counts = table(spark, d, "linkedin_jobs").groupBy(F.col("last_seen_snapshot").alias("date")).agg(F.count("*").alias("n"))
    return report.history_counts(counts, "n")


@query("SELECT source, format('{:,}', sum(row_id)::BIGINT) AS total, strftime(max(ingested_at), '%Y-%m-%d') AS latest FROM sap_jobs GROUP BY source")
def labels_sources(spark, d):
    rows = table(spark, d, "sap_jobs").groupBy("source").agg(F.sum("row_id").alias("n"), F.max("ingested_at").cast("string").alias("at"))
    return rows.select("source", report.thousands(F.col("n")).alias("total"), report.date_of(F.col("at")).alias("latest"))


@query("SELECT row_id FROM linkedin_jobs ORDER BY coalesce(query, ''), coalesce(location, ''), coalesce(company, ''), coalesce(title, ''), row_id LIMIT 200")
def link_order_jobs(spark, d):
    """The first rows in the link pool's order; ties by row."""
    rows = table(spark, d, "linkedin_jobs").select("row_id", "query", "location", "company", "title")
    return rows.orderBy(*[F.coalesce(F.col(c), F.lit("")) for c in ("query", "location", "company", "title")], "row_id").limit(200).select("row_id")


@query("SELECT count(DISTINCT location) AS n_locations FROM linkedin_jobs WHERE location != ''")
def distinct_locations_jobs(spark, d):
    return facets.count_values(table(spark, d, "linkedin_jobs"), "location").agg(F.count("*").alias("n_locations"))


@query("""WITH s AS (SELECT worker_id AS path, count(*) AS n_rows, count(*) FILTER (WHERE batch_no > 3) AS n_net_new FROM linkedin_incoming GROUP BY 1), p AS (SELECT worker_id AS path, count(*) AS n_rows, count(DISTINCT linkedin_job_id) AS n_net_new FROM linkedin_incoming WHERE batch_no <= 3 GROUP BY 1)
SELECT s.path, s.n_rows, CASE WHEN s.n_net_new = 0 AND s.n_rows = p.n_rows THEN coalesce(p.n_net_new, 0) ELSE s.n_net_new END AS n_net_new FROM s LEFT JOIN p ON s.path = p.path""")
def previous_run_incoming(spark, d):
    rows = table(spark, d, "linkedin_incoming")
    now = rows.groupBy(F.col("worker_id").alias("path")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("batch_no") > 3).alias("n_net_new"))
    before = rows.where("batch_no <= 3").groupBy(F.col("worker_id").alias("path")).agg(F.count("*").alias("n_rows"), F.count_distinct("linkedin_job_id").alias("n_net_new"))
    return run.with_previous(now, before)


@query(f"SELECT row_id FROM linkedin_jobs WHERE trim(coalesce(linkedin_job_id, '')) != '' AND length({sql_space('description')}) < 80 ORDER BY row_id LIMIT 500")
def backfill_queue_jobs(spark, d):
    return run.backfill_queue(table(spark, d, "linkedin_jobs"), "row_id", 500).select("row_id")


@query(f"""WITH r AS (SELECT *, coalesce(nullif(trim(linkedin_job_id), ''), {sql_stable('title', 'company', 'location', 'url')}) AS key FROM linkedin_jobs),
m AS (SELECT key, arg_min(title, row_id) FILTER (WHERE trim(title) != '') AS title, arg_min(company, row_id) FILTER (WHERE trim(company) != '') AS company,
 arg_max(description, (length(trim(coalesce(description, ''))), -row_id)) AS description, list_sort(list_distinct(list(query) FILTER (WHERE trim(query) != ''))) AS qs FROM r GROUP BY key),
x AS (SELECT *, {sql_space('title')} AS t, trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_space('description')})) AS x FROM m)
SELECT key, {_ROLE} AS role_family, {_level('x')} AS seniority, array_to_string({sql_list('x', rules.SKILLS)}, '; ') AS skills, array_to_string(coalesce(qs, []), '; ') AS observed_queries FROM x""")
def merged_shards_jobs(spark, d):
    """Postings merged from all workers and enriched again."""
    from postlens.operators.dedupe import posting_key

    rows = table(spark, d, "linkedin_jobs")
    key = posting_key(*[F.col(c) for c in ("linkedin_job_id", "title", "company", "location", "url")])
    made = pools.merged_shards(rows.withColumn("key", key), key, "row_id")
    return made.select("key", "role_family", "seniority", F.array_join("skills", "; ").alias("skills"), F.array_join("observed_queries", "; ").alias("observed_queries"))
