"""Queries for the operators of the posting pipeline over the driver's tables, with their SQL.

Every query runs over whole tables.  The SQL is written on its own, in DuckDB's dialect; arrays are
joined to text so that values compare.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import rules, text
from postlens.operators import dedupe, enrich, facets, grid, history, merge, report
from postlens.session import shared_folder, spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- pieces of SQL ------------------------------------------------------------------------------

_SPACES = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_space(x: str) -> str:
    """Decimal, hexadecimal and the usual named references decoded in one pass, then white space."""
    named = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "euro": "\u20ac", "copy": "\u00a9", "reg": "\u00ae", "auml": "\u00e4", "ouml": "\u00f6", "uuml": "\u00fc", "szlig": "\u00df", "eacute": "\u00e9", "ndash": "\u2013", "mdash": "\u2014", "hellip": "\u2026", "bull": "\u2022"}
    cases = " ".join(f"WHEN starts_with(e, '{n};') THEN {q(c)} || substr(e, {len(n) + 2})" for n, c in named.items())
    piece = f"""CASE WHEN k = 1 THEN e WHEN regexp_matches(e, '^#[0-9]{{1,6}};') THEN chr(CAST(regexp_extract(e, '^#([0-9]+);', 1) AS INTEGER)) || regexp_replace(e, '^#[0-9]+;', '')
 WHEN regexp_matches(e, '^#[xX][0-9a-fA-F]{{1,5}};') THEN chr(CAST('0x' || regexp_extract(e, '^#[xX]([0-9a-fA-F]+);', 1) AS INTEGER)) || regexp_replace(e, '^#[xX][0-9a-fA-F]+;', '') {cases} ELSE '&' || e END"""
    out = f"array_to_string(list_transform(string_split(coalesce({x}, ''), '&'), lambda e, k: {piece}), '')"
    return f"trim(regexp_replace({out}, {q(_SPACES)}, ' ', 'g'))"


def sql_html(x: str) -> str:
    return sql_space(f"regexp_replace(coalesce({x}, ''), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')")


def sql_match(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, {q('(?i)' + pattern)}), false)"


def sql_tags(x: str, table_: dict[str, str], default: str | None = None) -> str:
    cases = ", ".join(f"CASE WHEN {sql_match(x, p)} THEN {q(label)} END" for label, p in table_.items())
    joined = f"array_to_string(list_filter([{cases}], lambda t: t IS NOT NULL), '; ')"
    return joined if default is None else f"coalesce(nullif({joined}, ''), {q(default)})"


def sql_first(rules_: tuple, inputs: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql_match(inputs[source], p)} THEN {q(label)}" for label, source, p in rules_) + f" ELSE {q(default)} END"


def sql_lookup(x: str, pairs: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs.items()) + f" ELSE {x} END"


def sql_places(x: str) -> str:
    tidy = f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), ',|/|;|\\bor\\b|\\band\\b'), lambda p: {sql_space('p')}), lambda p: p != '')"
    mapped = f"list_transform(list_transform({tidy}, lambda p: {sql_lookup('p', rules.CITY_COUNTRY)}), lambda p: {sql_lookup('p', rules.PLACE_ALIASES)})"
    return f"list_filter({mapped}, lambda p, i: list_position({mapped}, p) = i)"


def sql_stable(*parts: str) -> str:
    joined = ", ".join(f"CASE WHEN {p} IS NOT NULL THEN lower({sql_space(p)}) END" for p in parts)
    return f"substr(sha1(concat_ws('|', {joined})), 1, 16)"


_DOC = f"SELECT doc_id, source, lang, {sql_space('title')} AS t, {sql_html('text')} AS b, trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_html('text')})) AS x FROM documents"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """Documents with cleaned title ``t``, body ``b`` and everything ``x``."""
    docs = spread(table(spark, d, "documents").select("doc_id", "source", "lang", "title", "company", "text"))
    t, c, b = text.normalize_space(F.col("title")), text.normalize_space(F.col("company")), text.html_text(F.col("text"))
    made = docs.select("doc_id", "source", "lang", t.alias("t"), b.alias("b"), c.alias("c")).withColumn("x", F.trim(F.concat_ws(" ", "t", "c", "b")))
    return rules.with_lines(made, {"line": F.col("x")})


# --- cleaning -----------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5({sql_space('text')}) AS h FROM documents")
def normalize_space_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize_space(F.col("text"))).alias("h"))


@query(f"SELECT doc_id, length({sql_html('text')}) AS n, md5({sql_html('text')}) AS h FROM documents")
def html_text_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", text.html_text(F.col("text")).alias("t")).select("doc_id", F.length("t").alias("n"), F.md5("t").alias("h"))


@query()
def html_text_exact_jobs(spark, d):
    return table(spark, d, "linkedin_jobs").select("row_id", F.length(text.html_text_exact(F.col("description"))).alias("n"))


@query(f"SELECT row_id, {sql_stable('title', 'company', 'location', 'url')} AS id FROM linkedin_jobs")
def stable_id_jobs(spark, d):
    return table(spark, d, "linkedin_jobs").select("row_id", text.stable_id(*[F.col(c) for c in ("title", "company", "location", "url")]).alias("id"))


@query(f"SELECT row_id, array_to_string({sql_places('location')}, '; ') AS places, coalesce(({sql_places('location')})[1], CASE WHEN remote THEN 'Worldwide / Not specified' ELSE 'Not specified' END) AS primary_place FROM sap_jobs")
def split_places_jobs(spark, d):
    places = text.split_places(F.col("location"))
    default = F.when(F.col("remote"), "Worldwide / Not specified").otherwise("Not specified")
    return table(spark, d, "sap_jobs").select("row_id", F.array_join(places, "; ").alias("places"), text.primary_place(places, default).alias("primary_place"))


@query(f"SELECT row_id, CASE WHEN {sql_match(sql_space('location'), rules.NO_PLACE_TEXT)} THEN '' ELSE {sql_space('location')} END AS place FROM sap_jobs")
def clean_place_jobs(spark, d):
    return table(spark, d, "sap_jobs").select("row_id", text.clean_place(F.col("location")).alias("place"))


@query("SELECT row_id, coalesce(nullif(salary_min, ''), nullif(salary_max, ''), nullif(salary_currency, ''), 'none') AS v FROM sap_jobs")
def coalesce_chain_jobs(spark, d):
    return table(spark, d, "sap_jobs").select("row_id", text.first_present(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"), F.lit("none")).alias("v"))


@query(f"SELECT doc_id, md5(substr({sql_html('text')}, 1, 420)) AS h FROM documents")
def excerpt_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.excerpt(text.html_text(F.col("text")))).alias("h"))


@query("""WITH c AS (SELECT row_id, posted_at, CASE WHEN regexp_full_match(posted_at, '-?\\d+') THEN try_cast(posted_at AS BIGINT) END AS n FROM sap_jobs)
SELECT row_id, CASE WHEN n BETWEEN -62135596800 AND 253402300799 THEN strftime(make_timestamp(n * 1000000), '%Y-%m-%dT%H:%M:%S') ELSE posted_at END AS iso FROM c""")
def epoch_iso_jobs(spark, d):
    return table(spark, d, "sap_jobs").select("row_id", text.epoch_iso(F.col("posted_at")).alias("iso"))


@query(f"""WITH s AS (SELECT doc_id, list_filter([{', '.join(f"CASE WHEN {sql_match('x', p)} THEN {q(label)} END" for label, p in rules.SKILLS.items())}], lambda t: t IS NOT NULL) AS v FROM ({_DOC}))
SELECT doc_id, array_to_string(CASE WHEN len(v) > 3 THEN list_append(v[1:3], '+' || (len(v) - 3)) ELSE v END, '; ') AS chips FROM s""")
def chips_docs(spark, d):
    return _docs(spark, d).select("doc_id", F.array_join(text.chips(rules.tags(F.col("x"), rules.SKILLS, line=F.col("line")), 3), "; ").alias("chips"))


@query("""WITH v AS (SELECT row_id, CASE WHEN trim(coalesce(salary_min, '')) NOT IN ('', '0') THEN trim(salary_min) END AS a, CASE WHEN trim(coalesce(salary_max, '')) NOT IN ('', '0') THEN trim(salary_max) END AS b,
 nullif(trim(salary_currency), '') AS c, nullif(trim(salary_period), '') AS p FROM sap_jobs)
SELECT row_id, CASE WHEN a IS NULL AND b IS NULL THEN '' ELSE concat_ws(' ', CASE WHEN a = b THEN a ELSE concat_ws('-', a, b) END, c, p) END AS salary FROM v""")
def salary_text_jobs(spark, d):
    cols = [F.col(c) for c in ("salary_min", "salary_max", "salary_currency", "salary_period")]
    return table(spark, d, "sap_jobs").select("row_id", report.salary_text(*cols).alias("salary"))


@query("""SELECT row_id, 'keywords=' || replace(url_encode(coalesce(query, '')), '%20', '+') || '&location=' || replace(url_encode(coalesce(query_location, '')), '%20', '+') AS link FROM linkedin_jobs""")
def search_links_jobs(spark, d):
    some = lambda c: F.coalesce(F.col(c), F.lit(""))
    return table(spark, d, "linkedin_jobs").select("row_id", text.url_query({"keywords": some("query"), "location": some("query_location")}).alias("link"))


# --- tags and classes ---------------------------------------------------------------------------


def _tag_query(name: str, rules_: dict[str, str], default: str | None = None) -> None:
    def run(spark, d):
        return _docs(spark, d).select("doc_id", F.array_join(rules.tags(F.col("x"), rules_, default, F.col("line")), "; ").alias("labels"))

    run.__name__ = name
    query(f"SELECT doc_id, {sql_tags('x', rules_, default)} AS labels FROM ({_DOC})")(run)


_tag_query("tag_modules_docs", rules.MODULES, rules.NO_MODULE)
_tag_query("tag_skills_docs", rules.SKILLS)
_tag_query("tag_terms_docs", rules.STRONG_TERMS)
_tag_query("tag_soft_skills_docs", rules.SOFT_SKILLS)
_tag_query("tag_degree_levels_docs", rules.DEGREE_LEVELS)
_tag_query("tag_degree_fields_docs", rules.DEGREE_FIELDS)


@query(f"SELECT doc_id FROM ({_DOC}) WHERE " + " OR ".join(sql_match("x", p) for p in rules.STRONG_TERMS.values()))
def match_filter_docs(spark, d):
    return _docs(spark, d).where(rules.any_match(F.col("x"), rules.STRONG_TERMS, F.col("line"))).select("doc_id")


@query(f"SELECT doc_id, {sql_first(rules.ROLE_RULES, {'title': 't', 'text': 'x'}, rules.OTHER_ROLE)} AS role FROM ({_DOC})")
def classify_role_docs(spark, d):
    return rules.with_lines(_docs(spark, d), {"tl": F.col("t")}).select("doc_id", rules.first_match(rules.ROLE_RULES, {"title": F.col("t"), "text": F.col("x")}, rules.OTHER_ROLE, {"title": F.col("tl"), "text": F.col("line")}).alias("role"))


@query("SELECT doc_id, " + sql_first(rules.SENIORITY_RULES, {"sample": "(t || ' ' || substr(b, 1, 1000))"}, rules.NO_SENIORITY) + f" AS level FROM ({_DOC})")
def classify_seniority_docs(spark, d):
    return _docs(spark, d).select("doc_id", enrich.seniority(F.col("t"), F.col("b")).alias("level"))


@query(f"""SELECT doc_id, CASE WHEN {sql_match('t', rules.TITLE_CORE)} AND {sql_match('t', rules.TITLE_DELIVERY)} THEN 'Core SAP delivery role'
 WHEN {sql_match('t', rules.TITLE_CORE)} THEN 'SAP-titled role' WHEN {sql_tags('x', rules.MODULES)} != '' THEN 'SAP module/technical requirement'
 WHEN {sql_match('x', rules.TOOL_PHRASES)} THEN 'SAP required as business tool' ELSE 'SAP mentioned' END AS focus FROM ({_DOC})""")
def classify_focus_docs(spark, d):
    modules = rules.tags(F.col("x"), rules.MODULES, rules.NO_MODULE, F.col("line"))
    docs = rules.with_lines(_docs(spark, d), {"tl": F.col("t")}).withColumn("modules", modules)
    return docs.select("doc_id", enrich.focus(F.col("t"), F.col("x"), F.col("modules"), corrected=True, title_line=F.col("tl"), line=F.col("line")).alias("focus"))


_JOB = f"""SELECT row_id, coalesce(nullif(trim(linkedin_job_id), ''), {sql_stable('title', 'company', 'location', 'url')}) AS id, {sql_space('location')} AS l, {sql_space('title')} AS t, {sql_html('description')} AS b,
 trim(concat_ws(' ', {sql_space('title')}, {sql_space('company')}, {sql_html('description')})) AS x FROM linkedin_jobs"""
_ANY = "(" + " OR ".join(sql_match("x", p) for p in rules.STRONG_TERMS.values()) + ")"


@query(f"""WITH j AS MATERIALIZED ({_JOB}) SELECT row_id, id, CASE WHEN l = '' OR {sql_match('l', rules.NO_PLACE_TEXT)} THEN 'Not specified' ELSE l END AS primary_location,
 {sql_first(rules.ROLE_RULES, {'title': 't', 'text': 'x'}, rules.OTHER_ROLE)} AS role_family, {sql_first(rules.SENIORITY_RULES, {'sample': "(t || ' ' || substr(b, 1, 1000))"}, rules.NO_SENIORITY)} AS seniority,
 CASE WHEN {sql_match('t', rules.TITLE_CORE)} AND {sql_match('t', rules.TITLE_DELIVERY)} THEN 'Core SAP delivery role' WHEN {sql_match('t', rules.TITLE_CORE)} THEN 'SAP-titled role'
 WHEN {sql_tags('x', rules.MODULES)} != '' THEN 'SAP module/technical requirement' ELSE 'SAP mentioned' END AS sap_focus, {sql_tags('x', rules.SKILLS)} AS skills FROM j WHERE {_ANY}""")
def classified_jobs(spark, d):
    made = enrich.classify(spread(table(spark, d, "linkedin_jobs")), job_id="linkedin_job_id", only_matching=True)
    return made.select("row_id", "id", "primary_location", "role_family", "seniority", "sap_focus", F.array_join("skills", "; ").alias("skills"))


# --- filters ------------------------------------------------------------------------------------


@query(f"SELECT row_id FROM linkedin_jobs WHERE trim(coalesce(linkedin_job_id, '')) != '' AND length({sql_space('description')}) < 80")
def needs_detail_jobs(spark, d):
    rows = table(spark, d, "linkedin_jobs").where(text.present(F.col("linkedin_job_id")))
    return rows.where(F.length(text.normalize_space(F.col("description"))) < 80).select("row_id")


@query("SELECT row_id, title FROM sap_jobs WHERE contains(lower(concat_ws(' ', title, company, location)), 'consultant') AND source = 'himalayas'")
def search_table_jobs(spark, d):
    return report.search(table(spark, d, "sap_jobs"), "Consultant", columns=("title", "company", "location"), source="himalayas").select("row_id", "title")


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE trim(title) != '' AND trim(company) != '' AND trim(url) != '') AS n_complete FROM company_career_jobs")
def required_fields_careers(spark, d):
    ok = text.present(F.col("title")) & text.present(F.col("company")) & text.present(F.col("url"))
    return table(spark, d, "company_career_jobs").agg(F.count("*").alias("n_rows"), F.count_if(ok).alias("n_complete"))


# --- duplicates and merges ----------------------------------------------------------------------

_FIRST_KEY = f"lower({sql_space('title')} || '|' || {sql_space('company')} || '|' || {sql_space('url')})"


@query(f"SELECT min(row_id) AS row_id FROM sap_jobs GROUP BY {_FIRST_KEY}")
def first_wins_jobs(spark, d):
    jobs = table(spark, d, "sap_jobs").select("row_id", "title", "company", "url")
    return dedupe.first_wins(jobs, dedupe.key_of(F.col("title"), F.col("company"), F.col("url")), ["row_id"]).select("row_id")


@query(f"SELECT min(row_id) AS row_id FROM linkedin_jobs GROUP BY coalesce(nullif(trim(linkedin_job_id), ''), {sql_stable('title', 'company', 'location', 'url')})")
def first_wins_postings(spark, d):
    jobs = table(spark, d, "linkedin_jobs").select("row_id", "linkedin_job_id", "title", "company", "location", "url")
    key = dedupe.posting_key(*[F.col(c) for c in ("linkedin_job_id", "title", "company", "location", "url")])
    return dedupe.first_wins(jobs, key, ["row_id"]).select("row_id")


_CUT = "2026-04-01"


def _halves(spark, d):
    rows = table(spark, d, "company_career_jobs").select("row_id", "id", "title", "description", "first_seen_snapshot").where("id IS NOT NULL")
    one = lambda part: dedupe.first_wins(part, F.col("id"), ["row_id"])
    return one(rows.where(F.col("first_seen_snapshot") < _CUT)), one(rows.where(F.col("first_seen_snapshot") >= _CUT))


_UPSERT = f"""WITH r AS (SELECT row_id, id, title, description, first_seen_snapshot FROM company_career_jobs WHERE id IS NOT NULL),
o AS (SELECT * FROM r WHERE first_seen_snapshot < '{_CUT}' QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1),
n AS (SELECT * FROM r WHERE first_seen_snapshot >= '{_CUT}' QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.title ELSE o.title END AS title,
 md5(coalesce(CASE WHEN n.id IS NULL OR (o.id IS NOT NULL AND trim(coalesce(o.description, '')) != '' AND trim(coalesce(n.description, '')) = '') THEN o.description ELSE n.description END, '')) AS h,
 CASE WHEN o.id IS NULL THEN 'S1' ELSE o.first_seen_snapshot END AS first_seen_snapshot, CASE WHEN n.id IS NOT NULL THEN 'S1' ELSE '' END AS last_seen_snapshot
FROM o FULL OUTER JOIN n ON o.id = n.id"""


@query(_UPSERT)
def upsert_careers(spark, d):
    old, new = _halves(spark, d)
    pool = merge.with_history(old)
    made = merge.upsert(pool, merge.with_history(new), "id", "T1", "S1", keep_if_empty="description", kept=("description",))
    return made.select("id", "title", F.md5(F.coalesce("description", F.lit(""))).alias("h"), "first_seen_snapshot", "last_seen_snapshot")


@query("""SELECT 'seen' AS part, count(*) AS n FROM linkedin_incoming i WHERE EXISTS (SELECT 1 FROM linkedin_jobs j WHERE j.linkedin_job_id = i.linkedin_job_id)
UNION ALL SELECT 'new', count(*) FROM linkedin_incoming i WHERE NOT EXISTS (SELECT 1 FROM linkedin_jobs j WHERE j.linkedin_job_id = i.linkedin_job_id)""")
def split_seen_incoming(spark, d):
    seen, new = merge.split_seen(table(spark, d, "linkedin_jobs"), table(spark, d, "linkedin_incoming"), "linkedin_job_id")
    return seen.agg(F.count("*").alias("n")).select(F.lit("seen").alias("part"), "n").unionByName(new.agg(F.count("*").alias("n")).select(F.lit("new").alias("part"), "n"))


@query(f"""WITH r AS (SELECT *, coalesce(nullif(trim(linkedin_job_id), ''), {sql_stable('title', 'company', 'location', 'url')}) AS key FROM linkedin_jobs)
SELECT key AS linkedin_job_id, arg_min(title, row_id) FILTER (WHERE trim(title) != '') AS title, max(length(trim(coalesce(description, '')))) AS n_description, min(first_seen_snapshot) FILTER (WHERE trim(first_seen_snapshot) != '') AS first_seen_snapshot,
 max(last_seen_snapshot) FILTER (WHERE trim(last_seen_snapshot) != '') AS last_seen_snapshot, array_to_string(list_sort(list_distinct(list(worker_id) FILTER (WHERE trim(worker_id) != ''))), '; ') AS workers
FROM r GROUP BY key""")
def merge_shards_jobs(spark, d):
    """One row per posting; ``linkedin_job_id`` is its key, the stable id where rows have none."""
    key = dedupe.posting_key(*[F.col(c) for c in ("linkedin_job_id", "title", "company", "location", "url")])
    cols = ["row_id", "title", "description", "first_seen_snapshot", "last_seen_snapshot", "worker_id"]
    rows = table(spark, d, "linkedin_jobs").select(key.alias("linkedin_job_id"), *cols)
    made = merge.merge_shards(rows, "linkedin_job_id", ["row_id"], longest="description", least=["first_seen_snapshot"], most=["last_seen_snapshot"], union=["worker_id"])
    return made.select("linkedin_job_id", "title", F.coalesce(F.length(F.trim("description")), F.lit(0)).alias("n_description"), "first_seen_snapshot", "last_seen_snapshot", F.array_join("worker_id", "; ").alias("workers"))



_SEEN = "SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n_seen FROM events GROUP BY user_id"


def _us(c: str):
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


@query(_SEEN)
def seen_stamps_events(spark, d):
    made = merge.seen_stamps(table(spark, d, "events"), "user_id", "ts")
    return made.select("user_id", _us("first_seen").alias("first_us"), _us("last_seen").alias("last_us"), "n_seen")


@query(_SEEN)
def stream_seen_events(spark, d):
    """The same stamps from a stream; each state is written to the shared folder, the last one is the result."""
    from postlens.streaming.seen import seen_stream

    base = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    stream = spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    write = lambda state, n: state.write.mode("overwrite").parquet(f"{base}/state")
    seen_stream(stream, "user_id", "ts").writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/state").select("user_id", _us("first_seen").alias("first_us"), _us("last_seen").alias("last_us"), "n_seen")


@query("""SELECT c_custkey, c_name, coalesce(n_name, 'unknown') AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_nation(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    rows = table(spark, d, "customer")
    return rows.join(names, rows["c_nationkey"] == names["k"], "left").select("c_custkey", "c_name", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query("SELECT j.row_id, CASE WHEN trim(coalesce(i.title, '')) != '' THEN i.title ELSE j.title END AS title FROM linkedin_jobs j LEFT JOIN (SELECT linkedin_job_id, min(title) AS title FROM linkedin_incoming GROUP BY 1) i ON i.linkedin_job_id = j.linkedin_job_id")
def detail_merge_jobs(spark, d):
    details = table(spark, d, "linkedin_incoming").groupBy("linkedin_job_id").agg(F.min("title").alias("title"))
    return merge.with_details(table(spark, d, "linkedin_jobs").select("row_id", "linkedin_job_id", "title"), details, "linkedin_job_id", ["title"]).select("row_id", "title")


# --- aggregates ---------------------------------------------------------------------------------


@query("SELECT event_type AS label, count(*) AS n FROM events WHERE event_type != '' GROUP BY 1")
def facet_counts_events(spark, d):
    return facets.count_values(table(spark, d, "events"), "event_type")


def _sql_rule_counts(table_: dict[str, str], facet: str | None = None) -> str:
    head = f"{q(facet)} AS facet, " if facet else ""
    return " UNION ALL ".join(f"SELECT {head}{q(label)} AS label, count(*) AS n FROM x WHERE {sql_match('x', p)} HAVING count(*) > 0" for label, p in table_.items())


@query(f"WITH x AS MATERIALIZED ({_DOC}) " + _sql_rule_counts(rules.SKILLS))
def facet_counts_skills(spark, d):
    return facets.count_values(_docs(spark, d).withColumn("skills", rules.tags(F.col("x"), rules.SKILLS, line=F.col("line"))), "skills", multi=True)


@query(f"WITH x AS MATERIALIZED ({_DOC}) SELECT 'source' AS facet, source AS label, count(*) AS n FROM x WHERE source != '' GROUP BY source UNION ALL "
       + f"SELECT 'lang', lang, count(*) FROM x WHERE lang != '' GROUP BY lang UNION ALL {_sql_rule_counts(rules.MODULES, 'modules')} UNION ALL {_sql_rule_counts(rules.SOFT_SKILLS, 'soft_skills')} UNION ALL {_sql_rule_counts(rules.DEGREE_FIELDS, 'degree_fields')}")
def facets_one_pass_docs(spark, d):
    x = F.col("x")
    return facets.facets(_docs(spark, d), single=["source", "lang"], tagged={"modules": (x, rules.MODULES), "soft_skills": (x, rules.SOFT_SKILLS), "degree_fields": (x, rules.DEGREE_FIELDS)})


@query(f"WITH x AS MATERIALIZED ({_DOC}) " + _sql_rule_counts(rules.DEGREE_LEVELS))
def rule_counts_docs(spark, d):
    return facets.rule_counts(_docs(spark, d), F.col("x"), rules.DEGREE_LEVELS)


_STOP = ", ".join(map(q, [*rules.STOP_WORDS, *rules.STOP_TOKENS]))


@query(f"""WITH t AS (SELECT doc_id, unnest(list_distinct(list_filter(list_transform(regexp_extract_all(lower(t || ' ' || substr(b, 1, 420)), '[a-zA-Z][a-zA-Z0-9+/#.-]{{2,}}'),
 lambda w: regexp_replace(w, '^[./-]+|[./-]+$', '', 'g')), lambda w: length(w) >= 4 AND w NOT IN ({_STOP})))) AS label FROM ({_DOC}))
SELECT label, count(*) AS n FROM t GROUP BY label ORDER BY n DESC, label LIMIT 30""")
def term_frequencies_docs(spark, d):
    return facets.term_frequencies(_docs(spark, d), F.concat_ws(" ", "t", text.excerpt(F.col("b"))))


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE last_seen_snapshot = '2026-01-15') AS n_seen, count(*) FILTER (WHERE first_seen_snapshot = '2026-01-15') AS n_new, count(*) FILTER (WHERE length({sql_space('description')}) >= 80) AS n_described,
 count(DISTINCT CASE WHEN trim(coalesce(query, '')) != '' AND trim(coalesce(query_location, '')) != '' THEN (query, query_location, coalesce(query_filter, '')) END) AS n_searches,
 round(count(*) FILTER (WHERE length({sql_space('description')}) >= 80) / count(*), 4) AS described_share FROM linkedin_jobs""")
def coverage_jobs(spark, d):
    return facets.coverage(table(spark, d, "linkedin_jobs"), "2026-01-15")


@query("SELECT count(DISTINCT (user_id, event_type)) AS n FROM events")
def distinct_tuples_events(spark, d):
    return table(spark, d, "events").agg(F.count_distinct(F.struct("user_id", "event_type")).alias("n"))


@query("WITH c AS (SELECT company AS label, count(*) AS n FROM linkedin_jobs WHERE company != '' GROUP BY 1), s AS (SELECT sum(n) AS total FROM c) SELECT label, n, round(n / total, 4) AS share FROM c, s WHERE label != 'Orvanta Consulting Group' ORDER BY n DESC, label LIMIT 15")
def top_k_companies(spark, d):
    return facets.top_k(facets.count_values(table(spark, d, "linkedin_jobs"), "company"), 15, exclude=["Orvanta Consulting Group"])


@query("SELECT l_returnflag AS facet, l_linestatus AS label, count(*) AS n, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_linestatus) AS rank FROM lineitem GROUP BY 1, 2 QUALIFY rank <= 2")
def top_per_facet_lineitem(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("facet"), F.col("l_linestatus").alias("label")).agg(F.count("*").alias("n"))
    return facets.top_per_facet(counts, 2)


@query("""WITH a AS (SELECT company AS label, count(*) AS n FROM linkedin_jobs WHERE company != '' GROUP BY 1 ORDER BY n DESC, label LIMIT 10), b AS (SELECT company AS label, count(*) AS n FROM company_career_jobs WHERE company != '' GROUP BY 1 ORDER BY n DESC, label LIMIT 10)
SELECT label, n FROM a WHERE label IN (SELECT label FROM b)""")
def label_overlap_pools(spark, d):
    return facets.overlap(*[facets.count_values(table(spark, d, t), "company") for t in ("linkedin_jobs", "company_career_jobs")], k=10)


@query("SELECT f.source, count(j.row_id) AS n FROM feed_registry f LEFT JOIN sap_jobs j ON j.source = f.source GROUP BY 1")
def source_counts_feeds(spark, d):
    return facets.source_counts(table(spark, d, "feed_registry"), table(spark, d, "sap_jobs"))


@query("SELECT coalesce(provider, 'unknown') AS label, count(*) AS n FROM company_career_jobs GROUP BY 1")
def provider_counts(spark, d):
    return facets.count_values(table(spark, d, "company_career_jobs").withColumn("p", F.coalesce("provider", F.lit("unknown"))), "p")


@query("SELECT median(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def median_age_days(spark, d):
    o, i = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    return i.join(o, i["l_orderkey"] == o["o_orderkey"]).agg(F.median(F.datediff("l_shipdate", "o_orderdate")).alias("days"))


# --- grids, history, report ---------------------------------------------------------------------

_GRID = "WITH g AS (SELECT n_name, r_name, event_type, row_number() OVER (ORDER BY n_name, r_name, event_type) - 1 AS idx FROM nation, region, (SELECT DISTINCT event_type FROM events))"


@query(_GRID + " SELECT * FROM g WHERE idx >= 100 AND idx < 350")
def grid_slice(spark, d):
    axes = [table(spark, d, "nation").select("n_name"), table(spark, d, "region").select("r_name"), table(spark, d, "events").select("event_type").distinct()]
    return grid.slice_of(grid.grid_of(axes), 100, 250).select("n_name", "r_name", "event_type", "idx")


@query("SELECT CAST(w AS INTEGER) AS worker, 180 + (w - 1) * 5143 AS \"offset\", least(5143, 36000 - (w - 1) * 5143) AS size FROM range(1, 8) t(w)")
def shard_ranges(spark, d):
    return grid.shards(spark, 36180, 7, 180)


@query("SELECT least(10000000, greatest(500, max(l_orderkey + l_quantity))) AS next_idx FROM (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem)")
def high_watermark_lineitem(spark, d):
    runs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("offset"), F.lit(10).alias("size"), F.col("l_quantity").cast("bigint").alias("attempted"))
    return grid.high_watermark(runs, 10_000_000, 500)


def _by_day(spark, d):
    e = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count("*").cast("double").alias("n_events"), F.max("event_type").alias("label"))
    j = table(spark, d, "linkedin_jobs").groupBy(F.col("last_seen_snapshot").alias("date")).agg(F.count("*").cast("double").alias("n_events"), F.count("*").cast("double").alias("n_jobs"), F.max("worker_id").alias("label"))
    return [e, j]


@query("""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS date, count(*)::DOUBLE AS n, max(event_type) AS label FROM events GROUP BY 1), j AS (SELECT last_seen_snapshot AS date, count(*)::DOUBLE AS n, max(worker_id) AS label FROM linkedin_jobs WHERE last_seen_snapshot IS NOT NULL GROUP BY 1)
SELECT coalesce(e.date, j.date) AS date, coalesce(j.n, e.n, 0) AS n_events, coalesce(j.n, 0) AS n_jobs, coalesce(nullif(j.label, ''), nullif(e.label, ''), '') AS label FROM e FULL OUTER JOIN j ON e.date = j.date""")
def history_consolidate(spark, d):
    return history.consolidate(_by_day(spark, d), numbers=["n_events", "n_jobs"], texts=["label"])


@query("""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2) SELECT date, status, n, n - lag(n) OVER (PARTITION BY status ORDER BY date) AS growth FROM c""")
def delta_by_day(spark, d):
    counts = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return history.day_over_day(counts, "date", "n", "status")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey - o_orderkey AS BIGINT) ELSE 0 END AS net_new, CAST(o_custkey - o_orderkey AS BIGINT) AS raw_difference FROM orders""")
def net_new_orders(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("jobs_before"), F.col("o_custkey").alias("jobs_after"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("skipped").alias("status"))
    return history.net_new(rows).select("o_orderkey", "net_new", "raw_difference")


@query("""WITH p AS (SELECT DISTINCT linkedin_job_id FROM linkedin_jobs), f AS (SELECT linkedin_job_id, min(worker_id) AS worker_id FROM linkedin_incoming WHERE linkedin_job_id IS NULL OR linkedin_job_id NOT IN (SELECT linkedin_job_id FROM p WHERE linkedin_job_id IS NOT NULL) GROUP BY 1), k AS (SELECT worker_id, count(*) AS n_net_new FROM f GROUP BY 1)
SELECT s.worker_id, s.n_rows, coalesce(k.n_net_new, 0) AS n_net_new FROM (SELECT worker_id, count(*) AS n_rows FROM linkedin_incoming GROUP BY 1) s LEFT JOIN k ON k.worker_id = s.worker_id""")
def merge_statistics_incoming(spark, d):
    return history.merge_statistics(table(spark, d, "linkedin_jobs"), table(spark, d, "linkedin_incoming").select("linkedin_job_id", "worker_id"), "linkedin_job_id", "worker_id")


@query("WITH c AS (SELECT source AS label, count(*) AS n FROM sap_jobs WHERE source != '' GROUP BY 1) SELECT label, n, greatest(4.0, 100.0 * n / (SELECT max(n) FROM c))::DOUBLE AS width FROM c")
def bars_sources(spark, d):
    return report.bars(facets.count_values(table(spark, d, "sap_jobs"), "source"))


@query("""WITH k AS (SELECT source, count(*) FILTER (WHERE coalesce(trim(salary_min), '') NOT IN ('', '0') OR coalesce(trim(salary_max), '') NOT IN ('', '0')) / count(*) AS share FROM sap_jobs GROUP BY 1)
SELECT source, round(share, 4) AS share, CASE WHEN share < 0.25 THEN 'low' WHEN share < 0.5 THEN 'partial' ELSE 'strong' END AS level FROM k""")
def narrative_levels(spark, d):
    filled = lambda c: ~F.coalesce(F.trim(c), F.lit("")).isin("", "0")
    k = table(spark, d, "sap_jobs").groupBy("source").agg((F.count_if(filled("salary_min") | filled("salary_max")) / F.count("*")).alias("s"))
    return k.select("source", F.round("s", 4).alias("share"), report.level(F.col("s"), (0.25, 0.5), ("low", "partial", "strong")).alias("level"))


@query(f"""SELECT row_id, CASE WHEN coalesce(salary_min, '') NOT IN ('', '0') OR coalesce(salary_max, '') NOT IN ('', '0') THEN 'Disclosed' WHEN {sql_match('description_excerpt', rules.PAY_PHRASE)} THEN 'Mentioned in text' ELSE 'Not disclosed' END AS state FROM sap_jobs""")
def salary_state_jobs(spark, d):
    return table(spark, d, "sap_jobs").select("row_id", enrich.salary_state(F.col("salary_min"), F.col("salary_max"), F.col("description_excerpt")).alias("state"))


@query("""WITH n AS (SELECT max(ingested_at) AS now FROM sap_jobs) SELECT row_id FROM sap_jobs, n WHERE date_sub('second', ingested_at, now) <= 604800 AND NOT coalesce(regexp_matches(concat_ws(' ', location, title), '(?i)\\bhybrid\\b'), false)
 AND (coalesce(remote, false) OR coalesce(regexp_matches(concat_ws(' ', location, title), '(?i)\\bremote\\b'), false))""")
def search_filter_jobs(spark, d):
    jobs = table(spark, d, "sap_jobs").select("row_id", "location", "title", "remote", "ingested_at")
    dated = jobs.crossJoin(F.broadcast(jobs.agg(F.max("ingested_at").alias("now"))))  # one row
    model = enrich.work_model(F.col("location"), F.col("title"), F.col("remote"))
    return report.search_filter(dated, "past_week_remote", F.col("ingested_at"), F.col("now"), model).select("row_id")


@query("SELECT query, replace(CASE WHEN query != 'SAP' THEN regexp_replace(query, '^SAP ', '') END, 'x', 'x') AS keyword, count(*) AS n FROM linkedin_jobs WHERE query IS NOT NULL AND query != 'SAP' GROUP BY query")
def keyword_labels(spark, d):
    counts = table(spark, d, "linkedin_jobs").groupBy("query").agg(F.count("*").alias("n"))
    return counts.withColumn("keyword", report.keyword_label(F.col("query"))).where("keyword IS NOT NULL").select("query", "keyword", "n")


@query("SELECT source, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM sap_jobs), 1)::DOUBLE AS percent, CASE source WHEN 'himalayas' THEN 'Himalayas' WHEN 'remotefirst' THEN 'RemoteFirstJobs' WHEN 'jobicy' THEN 'Jobicy' WHEN 'remotive' THEN 'Remotive' WHEN 'remoteok' THEN 'Remote OK' WHEN 'arbeitnow' THEN 'Arbeitnow' ELSE source END AS label FROM sap_jobs GROUP BY source")
def percent_sources(spark, d):
    counts = table(spark, d, "sap_jobs").groupBy("source").agg(F.count("*").alias("n"))
    joined = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))  # one row
    return joined.select("source", "n", report.percent(F.col("n"), F.col("total")).alias("percent"), report.label_of(F.col("source")).alias("label"))


@query("""WITH s AS (SELECT last_seen_snapshot AS date, count(*) AS n_jobs FROM linkedin_jobs WHERE last_seen_snapshot IS NOT NULL GROUP BY 1), g AS (SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_signals, min(event_type) AS signal FROM events GROUP BY 1),
p AS (SELECT last_seen_snapshot AS date, count(*) AS n_careers FROM company_career_jobs WHERE last_seen_snapshot IS NOT NULL GROUP BY 1)
SELECT s.date, n_jobs, coalesce(n_signals, 0) AS n_signals, coalesce(signal, '') AS signal, coalesce(n_careers, 0) AS n_careers FROM s LEFT JOIN g ON g.date = s.date LEFT JOIN p ON p.date = s.date""")
def index_entries_days(spark, d):
    days = lambda t, n: table(spark, d, t).where("last_seen_snapshot IS NOT NULL").groupBy(F.col("last_seen_snapshot").alias("date")).agg(F.count("*").alias(n))
    signals = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("n_signals"), F.min("event_type").alias("signal"))
    return history.index_entries(days("linkedin_jobs", "n_jobs"), signals, days("company_career_jobs", "n_careers"))


@query("SELECT row_id, company, title, source FROM sap_jobs WHERE company IS NOT NULL ORDER BY source, company, title, row_id LIMIT 120")
def sorted_first_rows(spark, d):
    return table(spark, d, "sap_jobs").where("company IS NOT NULL").orderBy("source", "company", "title", "row_id").limit(120).select("row_id", "company", "title", "source")


@query("""WITH i AS (SELECT linkedin_job_id AS k, worker_id AS w, min((batch_no, incoming_id)) AS came FROM linkedin_incoming WHERE trim(linkedin_job_id) != '' AND worker_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT k, list(w ORDER BY came, w) AS ws FROM i GROUP BY k), u AS (SELECT row_id, list_filter(list_concat([worker_id], ws), lambda w: w IS NOT NULL) AS ws FROM linkedin_jobs LEFT JOIN l ON linkedin_job_id = k)
SELECT row_id, array_to_string(list_filter(ws, lambda w, n: list_position(ws, w) = n), ';') AS workers FROM u""")
def merged_lists_jobs(spark, d):
    """Every row's own worker, then those that brought its posting again, as they came; blank ids name no posting."""
    jobs = table(spark, d, "linkedin_jobs").select("row_id", "linkedin_job_id", "worker_id")
    came = table(spark, d, "linkedin_incoming").where("trim(linkedin_job_id) != '' AND worker_id IS NOT NULL").groupBy(F.col("linkedin_job_id").alias("k"), F.col("worker_id").alias("w"))
    i = came.agg(F.min(F.struct("batch_no", "incoming_id")).alias("at")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("ws"))
    met = jobs.join(i, jobs["linkedin_job_id"] == i["k"], "left")
    lists = merge.merge_lists(F.array_compact(F.array("worker_id")), F.col("ws.w"))
    return met.select("row_id", F.array_join(lists, ";").alias("workers"))


@query(f"""WITH j AS MATERIALIZED ({_JOB}), m AS MATERIALIZED (SELECT row_id, id, x FROM j WHERE {_ANY}),
s AS (SELECT id, arg_min([{', '.join(f"CASE WHEN {sql_match('x', p)} THEN {q(label)} END" for label, p in rules.SKILLS.items())}], row_id) AS s FROM m GROUP BY id), c AS (SELECT label, count(*) AS n FROM (SELECT unnest(s) AS label FROM s) WHERE label IS NOT NULL GROUP BY 1)
SELECT label, n, round(n / sum(n) OVER (), 4) AS share FROM c ORDER BY n DESC, label LIMIT 20""")
def flagship(spark, d):
    """Skills asked for most in the link pool: filtered, tagged, deduplicated by posting, counted.

    Texts stay where they are read: only the key and the tags of a row that matches are shuffled.
    """
    jobs = spread(table(spark, d, "linkedin_jobs").select("row_id", "linkedin_job_id", "title", "company", "location", "url", "description"))
    key = dedupe.posting_key(*[F.col(c) for c in ("linkedin_job_id", "title", "company", "location", "url")])
    body = F.concat_ws(" ", text.normalize_space(F.col("title")), text.normalize_space(F.col("company")), text.html_text(F.col("description")))
    read = rules.with_lines(jobs.select("row_id", key.alias("key"), body.alias("x")), {"line": F.col("x")})
    kept = read.where(rules.any_match(F.col("x"), rules.STRONG_TERMS, F.col("line"))).select("row_id", "key", rules.tags(F.col("x"), rules.SKILLS, line=F.col("line")).alias("s"))
    once = kept.groupBy("key").agg(F.min_by("s", "row_id").alias("s"))
    return facets.top_k(facets.count_values(once, "s", multi=True), 20)
