"""Queries that read dumps and pages: they are made from the driver's tables and must give their rows again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.plans.catalogue import q, sql_html, sql_places, sql_space, sql_stable
from postlens.session import shared_folder, table
from postlens.sources import feeds, files, markup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# The feeds' own names for title, company, description, url, places, date, amounts, currency and period.
_NAMES = {
    "himalayas": ("title", "companyName", "description", "applicationLink", "locationRestrictions", "pubDate", "minSalary", "maxSalary", "currency", "salaryPeriod"),
    "remotefirst": ("title", "company_name", "description", "url", "locations", "publication_date", "salary_min", "salary_max", "salary_currency", "salary_period"),
    "jobicy": ("jobTitle", "companyName", "jobDescription", "url", "jobGeo", "pubDate", "annualSalaryMin", "annualSalaryMax", "salaryCurrency", "salaryPeriod"),
    "remotive": ("title", "company_name", "description", "url", "candidate_required_location", "publication_date", "salaryMin", "salaryMax", "currency", "period"),
    "remoteok": ("position", "company", "description", "url", "location", "date", "salary_min", "salary_max", "currency", "period"),
    "arbeitnow": ("title", "company_name", "description", "url", "location", "created_at", "salaryMin", "salaryMax", "currency", "period"),
}
_COLUMNS = ("title", "company", "description_excerpt", "url", "location", "posted_at", "salary_min", "salary_max", "salary_currency", "salary_period")
_AROUND = {"queries_pages": ('{"sap": [{"page": 1, "count": 1, "payload": {"%s": ', "}}]}"), "queries": ('{"sap": {"%s": ', "}}"), "pages": ('[{"page": 1, "count": 1, "payload": {"%s": ', "}}]"), "items": ("", "")}
#: Rows in a dump.
_EACH = 200


def _documents(rows: DataFrame, item: Column, before: str, after: str) -> DataFrame:
    """``value``: JSON texts that each list the items of about _EACH rows."""
    n = max(1, rows.count() // _EACH)
    grouped = rows.select(item.alias("item"), F.pmod(F.xxhash64("row_id"), F.lit(n)).alias("b")).groupBy("b").agg(F.concat_ws(",", F.collect_list("item")).alias("items"))
    return grouped.select(F.concat(F.lit(before + "["), "items", F.lit("]" + after)).alias("value"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/dumps-{uuid.uuid4().hex}"


def _given(x: str) -> str:
    return f"CASE WHEN {x} NOT IN ('', '0', 'false', '[]', '{{}}') THEN {x} END"


def _amount(c: str) -> str:
    return f"CASE WHEN source NOT IN ('remotive', 'arbeitnow') THEN {_given(c)} END"


_OWN_URL = f"coalesce({_given('url')}, CASE source WHEN 'himalayas' THEN 'https://himalayas.app/companies/' || coalesce(id, '') || '/jobs/' || row_id WHEN 'remoteok' THEN 'https://remoteok.com/remote-jobs/' || row_id END)"
_FEEDS = f"""WITH j AS (SELECT *, {sql_space(_given('title'))} AS t, {sql_space(_given('company'))} AS c, {_OWN_URL} AS u, {sql_places('location')} AS ps, CASE WHEN source = 'arbeitnow' THEN coalesce(remote, false) ELSE true END AS r, {_amount('salary_min')} AS a, {_amount('salary_max')} AS b,
 CASE WHEN regexp_full_match(posted_at, '-?\\d+') THEN try_cast(posted_at AS BIGINT) END AS n FROM sap_jobs WHERE source IN ({', '.join(map(q, _NAMES))}))
SELECT source, {sql_stable('source', 'u', 't', 'c')} AS id, t AS title, c AS company, md5({sql_html(_given('description_excerpt'))}) AS body, u AS url, coalesce((ps)[1], CASE WHEN r THEN 'Worldwide / Not specified' ELSE 'Not specified' END) AS primary_location,
 CASE WHEN n BETWEEN -62135596800 AND 253402300799 AND n != 0 THEN strftime(make_timestamp(n * 1000000), '%Y-%m-%dT%H:%M:%S') ELSE {_given('posted_at')} END AS posted_at, r AS remote, a AS salary_min, b AS salary_max,
 CASE source WHEN 'remoteok' THEN CASE WHEN coalesce(a, b) IS NOT NULL THEN 'USD' END ELSE {_amount('salary_currency')} END AS salary_currency,
 CASE WHEN source IN ('remoteok', 'jobicy') THEN CASE WHEN coalesce(a, b) IS NOT NULL THEN 'annual' END ELSE {_amount('salary_period')} END AS salary_period FROM j WHERE t != '' AND c != ''"""


@query(_FEEDS)
def feeds_from_dumps(spark, d):
    """All open feeds, collected from dumps in each feed's own shape."""
    folder, jobs = _folder(spark), table(spark, d, "sap_jobs")
    for feed in feeds.FEEDS:
        fields = [F.col(c).alias(n) for c, n in zip(_COLUMNS, _NAMES[feed.name], strict=True)]
        item = F.to_json(F.struct(*fields, F.col("row_id").alias("id"), F.col("id").alias("companySlug"), F.col("remote").alias("remote")))
        before, after = _AROUND[feed.nesting]
        dumps = _documents(jobs.where(F.col("source") == feed.name), item, before.replace("%s", feed.items), after)
        dumps.write.option("compression", "none").option("lineSep", "\n").text(f"{folder}/{feed.name}.json")
    columns = ("source", "id", "title", "company", "url", "primary_location", "posted_at", "remote", "salary_min", "salary_max", "salary_currency", "salary_period")
    parts = [feeds.adapt(spark.read.text(f"{folder}/{f.name}.json"), f, i) for i, f in enumerate(feeds.FEEDS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*columns, F.md5("description").alias("body"))


_CAREER_ROW = f"{sql_stable('source', 'u', 't', 'c')} AS id, p AS provider, t AS title, c AS company, u AS url, md5({sql_space('body')}) AS body, coalesce((ps)[1], CASE WHEN r THEN 'Remote / Not specified' ELSE 'Not specified' END) AS primary_location, r AS remote, posted_at"
_CAREERS = f"""WITH j AS (SELECT *, 'All' AS s, {sql_space('title')} AS t, {sql_space("coalesce(nullif(company, ''), 'All')")} AS c, {sql_html('description')} AS body, {sql_places('location')} AS ps, regexp_matches(coalesce(location, ''), '(?i)\\bremote\\b') AS says FROM company_career_jobs),
k AS (SELECT 'greenhouse' AS p, url AS u, says AS r, * EXCLUDE (posted_at, source, remote), posted_at, 'All' AS source FROM j UNION ALL BY NAME SELECT 'smartrecruiters' AS p, url AS u, coalesce(remote, false) AS r, * EXCLUDE (posted_at, source, remote) REPLACE (coalesce(nullif(body, ''), {sql_space('description')}) AS body), posted_at, 'All' AS source FROM j
 UNION ALL BY NAME SELECT 'workday' AS p, 'https://all.example/job/' || row_id AS u, says AS r, * EXCLUDE (posted_at, source, remote), posted_at, 'All' AS source FROM j)
SELECT {_CAREER_ROW} FROM k WHERE t != '' AND c != '' AND coalesce(u, '') != ''"""


@query(_CAREERS.replace(", posted_at FROM", ", nullif(posted_at, '') AS posted_at FROM"))
def careers_from_dumps(spark, d):
    """Career rows read from a board, from lists with details, and from paths with details.

    A detail's markup without any text is kept as it is, as the reader of these details does.
    """
    jobs = table(spark, d, "company_career_jobs")
    col = F.col
    board = F.to_json(F.struct(col("company").alias("company_name"), "title", F.struct(col("location").alias("name")).alias("location"), col("url").alias("absolute_url"), col("description").alias("content"), col("posted_at").alias("first_published")))
    one = feeds.greenhouse(_documents(jobs, board, '{"jobs": ', "}"), "all", "All")
    listed = F.to_json(F.struct(col("row_id").alias("id"), col("url").alias("postingUrl"), F.lit("Listed").alias("name")))
    detail = F.to_json(F.struct(col("title").alias("name"), F.struct(col("company").alias("name")).alias("company"), F.struct(col("location").alias("fullLocation"), F.coalesce("remote", F.lit(False)).alias("remote")).alias("location"),
                                F.struct(F.struct(F.struct(col("description").alias("text")).alias("body")).alias("sections")).alias("jobAd"), col("posted_at").alias("releasedDate")))
    filled = jobs.where(text.present(col("title")))
    details = filled.select(col("row_id").cast("string").alias("id"), detail.alias("value"))
    two = feeds.smartrecruiters(_documents(filled, listed, '{"content": ', "}"), details, "all", "All")
    path = F.concat(F.lit("/job/"), col("row_id").cast("string"))
    paths = F.to_json(F.struct(path.alias("externalPath"), F.lit(None).cast("string").alias("locationsText")))
    info = F.struct("title", "location", col("description").alias("jobDescription"), col("posted_at").alias("startDate"))
    pages = filled.select(path.alias("id"), F.to_json(F.struct(info.alias("jobPostingInfo"), F.struct(col("company").alias("name")).alias("hiringOrganization"))).alias("value"))
    three = feeds.workday(_documents(filled, paths, '{"jobPostings": ', "}"), pages, "all", "All", "https://all.example")
    rows = feeds.normalize_career(one.unionByName(two).unionByName(three))
    return rows.select("id", "provider", "title", "company", "url", F.md5("description").alias("body"), "primary_location", "remote", "posted_at")


def _escaped(c: str) -> Column:
    out = F.coalesce(F.col(c), F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


_BLANKS = "trim(regexp_replace(coalesce({}, ''), '[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'))"


@query(f"SELECT CAST(row_id AS VARCHAR) AS linkedin_job_id, {_BLANKS.format('title')} AS title, {_BLANKS.format('company')} AS company, {_BLANKS.format('location')} AS location, 'https://x.example/jobs/view/' || row_id AS url FROM linkedin_jobs")
def cards_from_pages(spark, d):
    """Search cards read from pages of HTML."""
    jobs = table(spark, d, "linkedin_jobs")
    number = F.col("row_id").cast("string")
    card = F.concat(
        F.lit('<li><div class="base-card" data-entity-urn="urn:li:jobPosting:'), number, F.lit('"><a class="base-card__full-link" href="https://x.example/jobs/view/'), number, F.lit('?trk=x&amp;y=1">link</a><h3 class="base-search-card__title">'), _escaped("title"),
        F.lit('</h3><h4 class="base-search-card__subtitle"><a>'), _escaped("company"), F.lit('</a></h4><br><span class="job-search-card__location">'), _escaped("location"), F.lit('</span><time class="job-search-card__listdate" datetime="2026-01-01"></time></div></li>'),
    )
    n = max(1, jobs.count() // 25)
    pages = jobs.select(card.alias("card"), F.pmod(F.xxhash64("row_id"), F.lit(n)).alias("b")).groupBy("b").agg(F.concat_ws("\n", F.collect_list("card")).alias("html"))
    rows = pages.select(F.explode(markup.cards(F.concat(F.lit("<ul>"), "html", F.lit("</ul>")))).alias("c")).select("c.*")
    return rows.select("linkedin_job_id", "title", "company", "location", "url")


@query(f"SELECT row_id, {_BLANKS.format('title')} AS title, {_BLANKS.format('company')} AS company, md5({_BLANKS.format('description')}) AS body FROM linkedin_jobs")
def details_from_pages(spark, d):
    """Details read from a posting's page."""
    jobs = table(spark, d, "linkedin_jobs")
    page = F.concat(
        F.lit('<html><body><h2 class="top-card-layout__title">'), _escaped("title"), F.lit('</h2><a class="topcard__org-name-link">'), _escaped("company"), F.lit('</a><span class="topcard__flavor topcard__flavor--bullet">'), _escaped("location"),
        F.lit('</span><div class="show-more-less-html__markup">'), _escaped("description"), F.lit("</div></body></html>"),
    )
    return jobs.select("row_id", markup.details(page).alias("d")).select("row_id", "d.title", "d.company", F.md5("d.description").alias("body"))


@query("SELECT company, title, coalesce(salary_min, '') AS salary_min, remote::VARCHAR AS remote FROM (SELECT coalesce(company, '') AS company, coalesce(title, '') AS title, salary_min, coalesce(remote::VARCHAR, '') AS remote FROM sap_jobs)")
def csv_written_jobs(spark, d):
    """Projections of the pool written as CSV and read again."""
    path = f"{_folder(spark)}/jobs.csv"
    columns = ("company", "title", "salary_min", "remote")
    rows = table(spark, d, "sap_jobs").select(*columns)
    files.write_csv(rows, path, columns)
    read = spark.read.option("header", True).option("multiLine", True).option("escape", "\\").csv(path, schema=", ".join(f"{c} string" for c in columns))
    return read.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


@query("SELECT row_id, title, description FROM company_career_jobs")
def json_written_careers(spark, d):
    """Rows written as compressed JSON and read again, missing files beside them giving nothing."""
    base, schema = _folder(spark), "row_id bigint, title string, description string"
    files.write_json(table(spark, d, "company_career_jobs").select("row_id", "title", "description"), f"{base}/jobs", "gzip")
    rows = spark.read.schema(schema).json(f"{base}/jobs")
    return rows.unionByName(files.rows_or_empty(spark, f"{base}/missing.json", schema))
