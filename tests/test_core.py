"""Cleaning, rules, dedupe, merges, facets, grids, history, report."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.functions import rules, text
from postlens.operators import dedupe, enrich, facets, grid, history, merge, report


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, expected",
    [("  a \n b &amp; c ", "a b & c"), (None, ""), ("a  b", "a b"), ("", "")],
)
def test_normalize_space(spark, value, expected):
    assert one(spark, text.normalize_space, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("foo<b>bar</b>baz", "foo bar baz"), ("a<script>x=1</script>b<!-- c -->d", "a x=1 b d"), ("x &amp;lt; y", "x < y"), ("<p>one</p>tail AT&T", "one"), (None, "")],
)
def test_parsed_text(value, expected):
    assert text.parsed_text(value) == expected


def test_stable_id(spark):
    import hashlib

    got = spark.range(1).select(text.stable_id(F.lit("A "), F.lit(None).cast("string"), F.lit("b")).alias("r")).first()["r"]
    assert got == hashlib.sha1(b"a|b").hexdigest()[:16]


@pytest.mark.parametrize(
    "value, expected",
    [("USA, Berlin / UK or US", ["United States", "Germany", "United Kingdom"]), ("Trinidad and Tobago", ["Trinidad", "Tobago"]), (None, []), ("N/A", ["N", "A"])],
)
def test_split_places(spark, value, expected):
    assert one(spark, text.split_places, value) == expected


def test_clean_place_and_epoch(spark):
    assert one(spark, text.clean_place, "Over 200 applicants") == ""
    assert one(spark, text.epoch_iso, "1700000000") == "2023-11-14T22:13:20"
    assert one(spark, text.epoch_iso, "soon") == "soon"


def test_tags_in_rule_order(spark):
    tag = lambda table, default=None: lambda c: rules.tags(c, table, default)
    assert {"S/4HANA", "HANA / Data"} <= set(one(spark, tag(rules.MODULES, rules.NO_MODULE), "SAP S/4 HANA consultant"))
    assert one(spark, tag(rules.MODULES, rules.NO_MODULE), "sap user") == [rules.NO_MODULE]
    assert one(spark, tag(rules.SOFT_SKILLS), "FÜHRUNG") == ["Leadership"]
    assert one(spark, tag(rules.DEGREE_FIELDS), "it was good") == ["Computer Science / Informatics"]
    assert one(spark, tag(rules.SKILLS), None) == []


def classes(spark, title, body):
    row = spark.createDataFrame([(1, title, None, body, None, None)], "row_id int, title string, company string, description string, location string, url string")
    return enrich.classify(row).first()


@pytest.mark.parametrize(
    "title, body, role",
    [("SAP Project Manager", "ABAP", "Project / Program"), ("SAP Consultant", "ABAP Basis Administrator", "Basis / Security"), ("X", None, rules.OTHER_ROLE)],
)
def test_role(spark, title, body, role):
    assert classes(spark, title, body)["role_family"] == role


def test_focus_and_seniority(spark):
    assert classes(spark, "Accountant", "experience with SAP")["sap_focus"] == "SAP mentioned"
    assert classes(spark, "SAP", None)["sap_focus"] == "SAP-titled role"
    assert classes(spark, "Senior Manager", None)["seniority"] == "Lead / Manager"
    assert classes(spark, "X", "a" * 1000 + " 7+ years")["seniority"] == rules.NO_SENIORITY


def test_classify_plan_has_no_python_and_no_join(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", "d", "e")], "row_id int, title string, company string, description string, location string, url string")
    plan = enrich.classify(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_first_wins(spark):
    rows = spark.createDataFrame([(3, "A", "x"), (1, "a ", "x"), (2, "b", None), (2, "b", None)], "i int, t string, u string")
    got = sorted((r["i"], r["t"]) for r in dedupe.first_wins(rows, dedupe.key_of(F.col("t"), F.col("u")), ["i"]).collect())
    assert got == [(1, "a "), (2, "b")]


def pool(spark, rows):
    return spark.createDataFrame(rows, "id string, title string, d string, first_seen_at string, last_seen_at string, first_seen_snapshot string, last_seen_snapshot string")


def test_upsert(spark):
    old = pool(spark, [("a", "old", "text", "t0", "t0", "s0", "s0"), ("b", "kept", "x", "t0", "t0", "s0", "s0")])
    new = pool(spark, [("a", "new", "", None, None, None, None), ("c", "fresh", "y", None, None, None, None)])
    got = {r["id"]: r for r in merge.upsert(old, new, "id", "t1", "s1", "d", ("d",)).collect()}
    assert (got["a"]["title"], got["a"]["d"], got["a"]["first_seen_at"], got["a"]["last_seen_snapshot"]) == ("new", "text", "t0", "s1")
    assert (got["b"]["title"], got["b"]["last_seen_at"]) == ("kept", "t0")
    assert (got["c"]["first_seen_snapshot"], got["c"]["last_seen_at"]) == ("s1", "t1")
    again = merge.upsert(merge.upsert(old, new, "id", "t1", "s1", "d", ("d",)), new, "id", "t1", "s1", "d", ("d",))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.values()))


def test_merge_shards_is_order_independent(spark):
    rows = [("k", 1, None, "ab", "2026-02", ["x"]), ("k", 2, "t", "abcd", "2026-01", ["y", "x"]), ("q", 3, "u", None, None, None)]
    schema = "k string, i int, t string, d string, s string, l array<string>"
    for given in (rows, rows[::-1]):
        got = {r["k"]: r for r in merge.merge_shards(spark.createDataFrame(given, schema), "k", ["i"], "d", ["s"], [], ["l"]).collect()}
        assert (got["k"]["t"], got["k"]["d"], got["k"]["s"], got["k"]["l"]) == ("t", "abcd", "2026-01", ["x", "y"])


def test_split_seen_and_details(spark):
    a, b = spark.createDataFrame([("1",)], "k string"), spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    seen, new = merge.split_seen(a, b, "k")
    assert [r["k"] for r in seen.collect()] == ["1"] and [r["k"] for r in new.collect()] == ["2"]
    got = merge.with_details(b, spark.createDataFrame([("1", "z"), ("2", " ")], "k string, v string"), "k", ["v"])
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("1", "z"), ("2", "y")]


def test_counts(spark):
    rows = spark.createDataFrame([(x,) for x in ("a", "b", "b", "", None, "c", "c")], "v string")
    assert [(r["label"], r["n"]) for r in facets.count_values(rows, "v").collect()] == [("b", 2), ("c", 2), ("a", 1)]
    terms = facets.term_frequencies(spark.createDataFrame([("data data DATA. the",)], "t string"), F.col("t"))
    assert [(r["label"], r["n"]) for r in terms.collect()] == [("data", 1)]


def test_facets_use_one_shuffle(spark):
    rows = spark.createDataFrame([("a", "SAP ABAP"), (None, "SAP")], "s string, x string")
    got = facets.facets(rows, ["s"], tagged={"skills": (F.col("x"), rules.SKILLS)})
    assert got._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2  # partial and final
    assert sorted(map(tuple, got.collect())) == [("s", "a", 1), ("skills", "ABAP", 1)]


def test_coverage_counts_searches_once(spark):
    rows = spark.createDataFrame([("q", "l", "f", None, "s", "s")] * 2 + [("q", "", "f", "x" * 90, None, None)], "query string, query_location string, query_filter string, description string, first_seen_snapshot string, last_seen_snapshot string")
    got = facets.coverage(rows, "s").first()
    assert (got["n_searches"], got["n_seen"], got["n_described"], got["described_share"]) == (1, 2, 1, 0.3333)


def test_grid(spark):
    cells = grid.grid(spark, ["a", "b"], ["x", "y", "z"], ["f", "g"])
    assert [tuple(r)[1:] for r in cells.orderBy("idx").collect()] == [(q, p, f) for q in "ab" for p in "xyz" for f in "fg"]
    assert grid.slice_of(cells, 3, 4).count() == 4
    assert [(r["offset"], r["size"]) for r in grid.shards(spark, 36180, 3).orderBy("worker").collect()] == [(0, 12060), (12060, 12060), (24120, 12060)]
    assert [r["size"] for r in grid.shards(spark, 10, 4).orderBy("worker").collect()] == [3, 3, 3, 1]
    runs = spark.createDataFrame([(0, 80, 80), (80, 40, 40)], "offset int, size int, attempted int")
    assert grid.high_watermark(runs, 100, 50).first()["next_idx"] == 100
    assert grid.resume({"fingerprint": "a", "total": 5, "next": 3}, "b", 5)["next"] == 0
    assert grid.advance({"total": 9, "next": 2}, {"offset": 4, "attempted": 9})["next"] == 9


def test_history(spark):
    a = spark.createDataFrame([("d1", 5, "x", "t1"), ("d2", 7, "", "t0")], "date string, n int, label string, at string")
    b = spark.createDataFrame([("d1", 0, "y", "t0"), ("d3", 1, None, None)], "date string, n int, label string, at string")
    got = {r["date"]: (r["n"], r["label"], r["at"]) for r in history.consolidate([a, b], numbers=["n"], texts=["label"], latest=["at"]).collect()}
    assert got == {"d1": (5.0, "y", "t1"), "d2": (7.0, "", "t0"), "d3": (1.0, "", None)}
    runs = spark.createDataFrame([(85343, 85853, "skipped"), (1, 4, "completed")], "jobs_before int, jobs_after int, status string")
    assert sorted((r["net_new"], r["raw_difference"]) for r in history.net_new(runs).collect()) == [(0, 510), (3, 3)]


def test_report(spark):
    five = spark.createDataFrame([(list("abcde"),)], "v array<string>")
    assert five.select(text.chips(F.col("v"), 3).alias("r")).first()["r"] == ["a", "b", "c", "+2"]
    assert spark.range(1).select(report.percent(F.lit(1), F.lit(0)).alias("r")).first()["r"] == 0.0
    levels = [spark.range(1).select(report.level(F.lit(x), (0.25, 0.5), ("low", "partial", "strong")).alias("r")).first()["r"] for x in (0.249, 0.25, 0.5)]
    assert levels == ["low", "partial", "strong"]


def test_search_filters(spark):
    assert report.unknown_filters(["all", "nope", "remote", "nope"]) == ["nope"]
    rows = spark.createDataFrame([(1, "2026-01-08 00:00:00", "remote"), (2, "2026-01-01 00:00:00", "remote"), (3, "2026-01-08 00:00:00", "onsite"), (4, None, "remote")], "i int, at string, m string")
    at, now = F.col("at").cast("timestamp"), F.lit("2026-01-09 00:00:00").cast("timestamp")
    kept = lambda name: sorted(r["i"] for r in report.search_filter(rows, name, at, now, F.col("m")).collect())
    assert (kept("all"), kept("past_week"), kept("remote"), kept("past_week_remote")) == ([1, 2, 3, 4], [1, 3], [1, 2, 4], [1])
    with pytest.raises(ValueError):
        report.search_filter(rows, "nope", at, now, F.col("m"))


def test_salary_state(spark):
    state = lambda low, body: spark.createDataFrame([(low, body)], "a string, b string").select(enrich.salary_state(F.col("a"), F.lit(None).cast("string"), F.col("b")).alias("s")).first()["s"]
    assert state("0", "salary range up to $ 5") == "Mentioned in text"
    assert (state("0.0", None), state(None, None), state("", "x")) == ("Disclosed", "Not disclosed", "Not disclosed")


def test_unescape_equals_html_unescape(spark):
    import html

    rng = random.Random(1)
    pool = [
        "&amp;", "&amp", "&#38;", "&#38", "&#x26;", "&#X26", "&lt;b&gt;", "&nbsp;", "&notit;", "&not", "&copy2", "&currentJobId=1", "&unknown;", "&", "&&", "&#0;", "&#128;", "&#x81;", "&#55296;",
        "&#99999999;", "&#1;", "&#xFFFF;", "&hellip;", "&eacute", "&Eacute;", " x", "&#;", "&#x;", "R&D", "&;", "&amp;lt;", "&fjlig;", "&#31;", "&#9;", "&#13;", "&#128512;", "é",
    ]
    texts = [*pool, *("".join(rng.choice(pool) for _ in range(rng.randint(1, 6))) for _ in range(800))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r["i"]: r["u"] for r in df.select("i", text.unescape(F.col("t")).alias("u")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts] and got[len(texts)] is None
