"""Adapters from raw dumps of feeds and career systems to one row shape.

A feed is described by data: how its dump is nested and, for each output field, the raw fields to
try in order.  Every item is kept as JSON text and read with get_json_object, so numbers, lists and
missing keys need no schema of their own.  ``src_ord``, ``page`` and ``pos`` keep the collection
order, in which the first of equal postings wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import text


@dataclass(frozen=True)
class Feed:
    name: str
    nesting: str  # of the dump: queries_pages, queries, pages or items
    items: str  # key of the list of items in a payload
    title: tuple[str, ...]
    company: tuple[str, ...]
    description: tuple[str, ...]
    url: tuple[str, ...]
    places: str
    posted_at: tuple[str, ...]
    salary_min: tuple[str, ...] = ()
    salary_max: tuple[str, ...] = ()
    currency: tuple[str, ...] = ()
    period: tuple[str, ...] = ()
    fixed: dict = field(default_factory=dict)  # currency and period of disclosed salaries
    url_template: tuple[str, ...] = ()  # text and field names in turn, where no url is given
    remote: str | None = None  # field; every posting is remote without one


# The feeds in their order of priority and the fields they deliver.
FEEDS = (
    Feed("himalayas", "queries_pages", "jobs", ("title",), ("companyName",), ("description", "excerpt"), ("applicationLink", "url"), "locationRestrictions",
         ("pubDate", "updatedAt", "createdAt"), ("minSalary",), ("maxSalary",), ("currency",), ("salaryPeriod",),
         url_template=("https://himalayas.app/companies/", "companySlug", "/jobs/", "id")),
    Feed("remotefirst", "queries_pages", "jobs", ("title",), ("company_name", "company"), ("description", "excerpt"), ("url", "apply_url", "job_url"), "locations",
         ("publication_date", "posted_at", "created_at"), ("salary_min",), ("salary_max",), ("salary_currency", "currency"), ("salary_period",)),
    Feed("jobicy", "queries", "jobs", ("jobTitle",), ("companyName",), ("jobDescription", "jobExcerpt"), ("url",), "jobGeo",
         ("pubDate", "postedAt"), ("annualSalaryMin", "salaryMin"), ("annualSalaryMax", "salaryMax"), ("salaryCurrency",), fixed={"period": "annual"}),
    Feed("remotive", "queries", "jobs", ("title",), ("company_name",), ("description",), ("url",), "candidate_required_location", ("publication_date",)),
    Feed("remoteok", "items", "", ("position",), ("company",), ("description",), ("url",), "location", ("date",), ("salary_min",), ("salary_max",),
         fixed={"currency": "USD", "period": "annual"}, url_template=("https://remoteok.com/remote-jobs/", "id")),
    Feed("arbeitnow", "pages", "data", ("title",), ("company_name",), ("description",), ("url",), "location", ("created_at",), remote="remote"),
)

_PAGE = "struct<page:int,count:int,payload:string>"
_SHAPES = {"queries_pages": f"map<string,array<{_PAGE}>>", "queries": "map<string,string>", "pages": f"array<{_PAGE}>", "items": "array<string>"}


def raw_items(dumps: DataFrame, feed: Feed) -> DataFrame:
    """``query``, ``page``, ``pos``, ``item`` from a table of dumps (one JSON text per row in ``value``).

    Dumps that are no valid JSON, and pages without items, give nothing.
    """
    read = dumps.select(F.from_json("value", _SHAPES[feed.nesting]).alias("d"))
    none = F.lit(None)
    if feed.nesting == "queries_pages":
        pages = read.select(F.explode("d").alias("query", "pages")).select("query", F.explode("pages").alias("p")).select("query", F.col("p.page").alias("page"), F.col("p.payload").alias("payload"))
    elif feed.nesting == "queries":
        pages = read.select(F.explode("d").alias("query", "payload")).select("query", F.lit(1).alias("page"), "payload")
    elif feed.nesting == "pages":
        pages = read.select(F.explode("d").alias("p")).select(none.cast("string").alias("query"), F.col("p.page").alias("page"), F.col("p.payload").alias("payload"))
    else:
        found = read.select(F.posexplode("d").alias("pos", "item"))
        has_id = ~F.coalesce(F.get_json_object("item", "$.id"), F.lit("")).isin("", "0", "false")
        return found.where(has_id).select(none.cast("string").alias("query"), F.lit(1).alias("page"), "pos", "item")
    listed = F.from_json(F.get_json_object("payload", f"$.{feed.items}"), "array<string>")
    return pages.select("query", "page", F.posexplode(listed).alias("pos", "item"))


def _field(names: tuple[str, ...]) -> Column:
    """The first value that is there; empty text, 0 and false are none."""
    if not names:
        return F.lit(None).cast("string")
    values = [F.get_json_object("item", f"$.{n}") for n in names]
    return F.coalesce(*[F.when(~v.isin("", "0", "false", "[]", "{}"), v) for v in values])


def _places(name: str) -> Column:
    """Places of a string, or of a list of strings and of objects with a name, country or location."""
    raw = F.get_json_object("item", f"$.{name}")
    listed = F.from_json(raw, "array<string>")
    named = lambda x: F.when(x.startswith("{"), text.first_present(F.get_json_object(x, "$.name"), F.get_json_object(x, "$.country"), F.get_json_object(x, "$.location"))).otherwise(x)
    return F.when(raw.startswith("[") & listed.isNotNull(), text.clean_places(F.transform(listed, named))).otherwise(text.split_places(raw))


def adapt(dumps: DataFrame, feed: Feed, order: int = 0) -> DataFrame:
    """Rows of the common shape from a feed's dumps; titles and companies must be filled."""
    low, high = _field(feed.salary_min), _field(feed.salary_max)
    disclosed = low.isNotNull() | high.isNotNull()
    remote = F.lit(True) if feed.remote is None else F.coalesce(F.get_json_object("item", f"$.{feed.remote}") == "true", F.lit(False))
    url = _field(feed.url)
    if feed.url_template:
        pieces = [F.lit(p) if i % 2 == 0 else F.coalesce(F.get_json_object("item", f"$.{p}"), F.lit("")) for i, p in enumerate(feed.url_template)]
        url = F.coalesce(url, F.concat(*pieces))
    places = _places(feed.places)
    fallback = F.when(remote, "Worldwide / Not specified").otherwise("Not specified")
    rows = raw_items(dumps, feed).select(
        F.lit(feed.name).alias("source"),
        F.lit(order).alias("src_ord"),
        "page",
        "pos",
        text.normalize_space(_field(feed.title)).alias("title"),
        text.normalize_space(_field(feed.company)).alias("company"),
        text.html_text(_field(feed.description)).alias("description"),
        url.alias("url"),
        F.when(F.size(places) > 0, places).otherwise(F.array(fallback)).alias("locations"),
        text.epoch_iso(_field(feed.posted_at)).alias("posted_at"),
        remote.alias("remote"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        (F.when(disclosed, F.lit(feed.fixed["currency"])) if "currency" in feed.fixed else _field(feed.currency)).alias("salary_currency"),
        (F.when(disclosed, F.lit(feed.fixed["period"])) if "period" in feed.fixed else _field(feed.period)).alias("salary_period"),
    )
    kept = rows.where("title != '' AND company != ''")
    return kept.withColumns({"id": text.stable_id(F.col("source"), F.col("url"), F.col("title"), F.col("company")), "primary_location": F.get("locations", F.lit(0))})


def collect(spark: SparkSession, folder: str, feeds: tuple[Feed, ...] = FEEDS) -> DataFrame:
    """All feeds of a folder with one ``<name>.json`` (or ``.json.gz``) dump each; missing dumps give no rows."""
    from postlens.sources.files import text_or_empty

    out = None
    for order, feed in enumerate(feeds):
        one = adapt(text_or_empty(spark, f"{folder}/{feed.name}.json"), feed, order)
        out = one if out is None else out.unionByName(one)
    return out


# --- career systems ---------------------------------------------------------------------------

ROW = ("provider", "source_key", "source", "company", "title", "location", "url", "description", "remote", "posted_at")


def _json(path: str) -> Column:
    return F.get_json_object("item", path)


def greenhouse(dumps: DataFrame, key: str, source: str) -> DataFrame:
    """Rows of a board's dump: one payload with all postings."""
    items = dumps.select(F.explode(F.from_json(F.get_json_object("value", "$.jobs"), "array<string>")).alias("item"))
    place = _json("$.location.name")
    return _row(items, "greenhouse", key, source, _json("$.company_name"), _json("$.title"), place, _json("$.absolute_url"), text.html_text(_json("$.content")), place.rlike(r"(?i)\bremote\b"), text.first_present(_json("$.first_published"), _json("$.updated_at")))


def smartrecruiters(lists: DataFrame, details: DataFrame, key: str, source: str) -> DataFrame:
    """List items with their detail documents (``id``, ``value``); a detail's filled fields override the item's."""
    items = lists.select(F.explode(F.from_json(F.get_json_object("value", "$.content"), "array<string>")).alias("item"))
    ids = text.first_present(_json("$.id"), _json("$.uuid"), F.substring_index(_json("$.ref"), "/", -1))
    met = items.withColumn("_id", ids).join(details.select(F.col("id").alias("_id"), F.col("value").alias("detail")), "_id", "left")
    either = lambda *paths: text.first_present(*[F.get_json_object(c, p) for c in ("detail", "item") for p in paths])
    place = text.first_present(either("$.location.fullLocation"), F.concat_ws(", ", either("$.location.city"), either("$.location.country")))
    body = text.flatten_text(either("$.jobAd"))
    url = text.first_present(either("$.postingUrl"), either("$.ref"))
    return _row(met, "smartrecruiters", key, source, either("$.company.name"), either("$.name"), place, url, body, F.coalesce(either("$.location.remote") == "true", F.lit(False)), either("$.releasedDate"))


def workday(lists: DataFrame, details: DataFrame, key: str, source: str, base_url: str) -> DataFrame:
    """List items by ``externalPath``, each once, with their detail documents (``id`` = path, ``value``)."""
    listed = lists.select(F.posexplode(F.from_json(F.get_json_object("value", "$.jobPostings"), "array<string>")).alias("pos", "item")).withColumn("_path", _json("$.externalPath"))
    once = listed.where(F.col("_path").isNotNull()).groupBy("_path").agg(F.min_by("item", "pos").alias("item"))
    met = once.join(details.select(F.col("id").alias("_path"), F.get_json_object("value", "$").alias("detail")), "_path", "left")
    info = lambda name: F.get_json_object("detail", f"$.jobPostingInfo.{name}")
    place = text.first_present(info("location"), _json("$.locationsText"))
    company = text.first_present(F.get_json_object("detail", "$.hiringOrganization.name"), F.lit(source))
    return _row(met, "workday", key, source, company, text.first_present(info("title"), _json("$.title")), place, F.concat(F.lit(base_url), F.col("_path")), text.html_text(info("jobDescription")), place.rlike(r"(?i)\bremote\b"), text.first_present(info("startDate"), _json("$.postedOn")))


def jobs2web(pages: DataFrame, key: str, source: str, company: str, base_url: str) -> DataFrame:
    """Rows of result pages (``query_ord``, ``page``, ``html``); of equal addresses the first by query, page and place wins."""
    from postlens.sources.markup import results

    rows = pages.select("query_ord", "page", F.posexplode(results(F.col("html"), F.lit(base_url))).alias("pos", "r")).select("query_ord", "page", "pos", "r.*")
    once = rows.groupBy("url").agg(F.min_by(F.struct("title", "location"), F.struct("query_ord", "page", "pos")).alias("r")).select("url", "r.*")
    return _row(once, "jobs2web", key, source, F.lit(company), F.col("title"), F.col("location"), F.col("url"), F.lit(""), F.col("location").rlike(r"(?i)\bremote\b"), F.lit(None).cast("string"))


def _row(items: DataFrame, provider: str, key: str, source: str, company: Column, title: Column, place: Column, url: Column, body: Column, remote: Column, posted: Column) -> DataFrame:
    values = (F.lit(provider), F.lit(key), F.lit(source), text.first_present(company, F.lit(source)), title, place, url, body, F.coalesce(remote, F.lit(False)), posted)
    return items.select(*[v.alias(n) for v, n in zip(values, ROW, strict=True)])


def normalize_career(rows: DataFrame) -> DataFrame:
    """Career rows of the common shape; title, company and address must be filled."""
    places = text.split_places(F.col("location"))
    fallback = F.when(F.col("remote"), "Remote / Not specified").otherwise("Not specified")
    tidy = rows.withColumns({c: text.normalize_space(F.col(c)) for c in ("title", "company", "description")})
    kept = tidy.where("title != '' AND company != '' AND coalesce(url, '') != ''")
    out = kept.withColumn("locations", F.when(F.size(places) > 0, places).otherwise(F.array(fallback)))
    return out.withColumns({"id": text.stable_id(F.col("source"), F.col("url"), F.col("title"), F.col("company")), "primary_location": F.get("locations", F.lit(0))})


#: Readers of the career systems by provider.
PROVIDERS = {"jobs2web": jobs2web, "smartrecruiters": smartrecruiters, "greenhouse": greenhouse, "workday": workday}


def career_sources(config: dict[str, list[dict]], allowed: set[str] | None = None) -> list[tuple[str, dict]]:
    """(provider, source) of a configuration in its order; providers that are unknown, or not among the allowed, are passed over."""
    return [(p, source) for p, sources in config.items() if p in PROVIDERS and (not allowed or p in allowed) for source in sources]
