"""Dumps of feeds and career systems, pages, files, streaming."""

import gzip
import json

from pyspark.sql import functions as F

from postlens.sources import feeds, files, markup
from postlens.sources.pages import search_pages
from postlens.streaming.seen import read_pool, upsert_stream, watermarked_counts

CARD = """<ul><li><div data-entity-urn="urn:li:jobPosting:31"><a class="base-card__full-link" href="https://x.example/j/31?a=1">l</a>
<h3 class="base-search-card__title"> SAP <b>Dev</b></h3><h4 class="base-search-card__subtitle">Co</h4><span class="job-search-card__location">Here</span>
<time class="job-search-card__listdate" datetime="2026-01-02">t</time></div></li><li><div data-entity-urn="urn:li:jobPosting:32"><h3>no link</h3></div></li></ul>"""


def test_cards_and_details():
    assert markup.search_cards(CARD) == [{"linkedin_job_id": "31", "url": "https://x.example/j/31", "title": "SAP Dev", "company": "Co", "location": "Here", "posted_at": "2026-01-02"}]
    assert markup.search_cards(None) == []
    page = '<h2 class="top-card-layout__title">T</h2><div class="show-more-less-html__markup">a<br>b<ul><li>c</li></ul></div>'
    assert markup.detail_page(page) == {"title": "T", "company": "", "location": "", "description": "a b c"}
    rows = markup.result_rows('<tr class="data-row"><td><a class="jobTitle-link" href="/j/1">A</a></td><td class="colLocation">B</td></tr>', "https://h.example")
    assert rows == [{"title": "A", "location": "B", "url": "https://h.example/j/1"}]


def test_cards_column(spark):
    got = spark.createDataFrame([(CARD,), (None,)], "html string").select(F.size(markup.cards(F.col("html"))).alias("n")).collect()
    assert sorted(r["n"] for r in got) == [0, 1]


def dump(tmp_path, name, value, zipped=False):
    data = json.dumps(value).encode()
    path = tmp_path / (name + ".json" + (".gz" if zipped else ""))
    path.write_bytes(gzip.compress(data) if zipped else data)


def test_feeds(spark, tmp_path):
    page = lambda jobs, n=1: {"page": n, "count": len(jobs), "payload": {"jobs": jobs}}
    dump(tmp_path, "himalayas", {"sap": [page([{"title": "A", "companyName": "C", "excerpt": "<p>e</p>", "companySlug": "c", "id": 7, "locationRestrictions": [{"name": None, "country": "India"}, "EU"], "minSalary": 5}])]})
    dump(tmp_path, "jobicy", {"t": {"jobs": [{"jobTitle": "B", "companyName": "C", "url": "u", "jobGeo": "USA", "annualSalaryMin": 0, "salaryMin": 3}]}}, zipped=True)
    dump(tmp_path, "remoteok", [{"legal": 1}, {"id": 1, "position": "D", "company": "E"}, {"id": 2, "position": "", "company": "E"}])
    dump(tmp_path, "arbeitnow", [{"page": 1, "count": 1, "payload": {"data": [{"title": "F", "company_name": "G", "url": "v", "created_at": 1700000000, "remote": False}], "links": {}}}])
    got = {r["source"]: r for r in feeds.collect(spark, str(tmp_path)).collect()}
    assert set(got) == {"himalayas", "jobicy", "remoteok", "arbeitnow"}
    assert got["himalayas"]["locations"] == ["India", "Europe"] and got["himalayas"]["description"] == "e" and got["himalayas"]["url"].endswith("/c/jobs/7")
    assert (got["jobicy"]["salary_min"], got["jobicy"]["salary_period"], got["jobicy"]["primary_location"]) == ("3", "annual", "United States")
    assert got["remoteok"]["primary_location"] == "Worldwide / Not specified" and got["remoteok"]["salary_currency"] is None
    assert (got["arbeitnow"]["posted_at"], got["arbeitnow"]["primary_location"], got["arbeitnow"]["remote"]) == ("2023-11-14T22:13:20", "Not specified", False)


def texts(spark, *values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "value string")


def docs(spark, **values):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in values.items()], "id string, value string")


def test_career_systems(spark):
    board = feeds.greenhouse(texts(spark, {"jobs": [{"title": "T", "location": {"name": "Remote, Spain"}, "absolute_url": "u", "content": "&lt;p&gt;x&lt;/p&gt;", "updated_at": "d"}]}), "k", "S").first()
    assert (board["company"], board["remote"], board["description"], board["posted_at"]) == ("S", True, "x", "d") or board["description"] == "<p>x</p>"
    smart = feeds.smartrecruiters(texts(spark, {"content": [{"id": "1", "name": "N", "location": {"city": "B", "country": "de"}}]}), docs(spark, **{"1": {"name": "M", "postingUrl": "p", "jobAd": {"sections": {"a": {"text": "q"}}}}}), "k", "S").first()
    assert (smart["title"], smart["url"], smart["location"], smart["description"]) == ("M", "p", "B, de", "q")
    work = feeds.workday(texts(spark, {"jobPostings": [{"externalPath": "/a", "title": "T", "locationsText": "L", "postedOn": "today"}] * 2}), docs(spark), "k", "S", "https://w").collect()
    assert len(work) == 1 and work[0]["url"] == "https://w/a" and work[0]["posted_at"] == "today"
    made = feeds.normalize_career(feeds.smartrecruiters(texts(spark, {"content": [{"id": "1", "name": "N", "ref": "r"}]}), docs(spark), "k", "S"))
    assert made.first()["primary_location"] == "Not specified"
    html = '<table><tr class="data-row"><td><a class="jobTitle-link" href="/j">A</a></td></tr></table>'
    assert feeds.jobs2web(spark.createDataFrame([(0, 0, html), (1, 0, html)], "query_ord int, page int, html string"), "k", "S", "C", "https://h").count() == 1


def test_files(spark, tmp_path):
    assert files.document_or_empty(spark, str(tmp_path / "none.json")) == {}
    (tmp_path / "bad.json").write_text("{")
    assert files.document_or_empty(spark, str(tmp_path / "bad.json")) == {}
    (tmp_path / "l.txt").write_text("a\n\n# c\n b \n")
    assert files.listed(spark, str(tmp_path / "l.txt")) == ["a", "b"] and files.listed(spark, str(tmp_path / "no"), "x, y") == ["x", "y"]
    rows = spark.createDataFrame([(1, ["a", "b"], None)], "i int, l array<string>, t string")
    assert files.flat(rows, ["l", "t", "z", "i"]).first().asDict() == {"l": "a; b", "t": "", "z": "", "i": "1"}
    files.write_csv(rows, str(tmp_path / "c"), ["i", "l"], "gzip")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["l"] == "a; b"
    for date in ("2026-01-01", "2026-01-02", "2026-01-02"):
        files.write_snapshot(rows, str(tmp_path / "s"), date)
    assert files.snapshot_dates(spark, str(tmp_path / "s")) == ["2026-01-01", "2026-01-02"] and spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_search_pages(spark, tmp_path):
    cell = tmp_path / "cells" / "000"
    cell.mkdir(parents=True)
    (cell / "cell.json").write_text(json.dumps({"query": "q", "location": "l", "filter": "f"}))
    for n, page in enumerate((CARD, "", CARD)):
        (cell / f"{n}.html").write_text(page)
    got = search_pages(spark, str(tmp_path / "cells"))
    assert [(r["query"], r["page"]) for r in got.collect()] == [("q", 0)]


def test_stream_equals_batch(spark, tmp_path):
    source, pool = tmp_path / "in", tmp_path / "pool"
    schema = "id string, title string"
    for part in ([("a", "1"), ("b", "1")], [("a", "2"), ("c", "2")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    upsert_stream(stream, str(pool), "id", str(tmp_path / "log"), lambda n: (f"t{n}", f"s{n}")).awaitTermination()
    last = max(int(p.name[1:]) for p in pool.iterdir())
    got = {r["id"]: (r["first_seen_at"], r["last_seen_at"]) for r in read_pool(spark, str(pool), last, None).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"][0] != got["a"][1]
    counts = watermarked_counts(spark.createDataFrame([("2026-01-01 00:00:00", "x")], "at string, label string").withColumn("at", F.col("at").cast("timestamp")), "at", "label")
    assert counts.first()["n"] == 1
