"""Run loop, recovery, lock, HTTP with retries, registry, snapshots and report helpers."""

import urllib.error

import pytest
from pyspark.sql import functions as F

from postlens.operators import report, run, summary
from postlens.operators.grid import resume
from postlens.sources import feeds, files, http


def loop(state, size=10, fail_at=(), progress=0, **options):
    ran, saved, jobs = [], [], [0]

    def batch(offset, length):
        if offset in fail_at:
            raise OSError("cut off")
        ran.append((offset, length))
        jobs[0] += length

    last = {"latest_run_partition_offset": fail_at[0] if fail_at else 0, "latest_run_searches_attempted": progress}
    state, why = run.run_batches(state, batch, size, lambda: jobs[0], saved.append, lambda: last, **options)
    return state, why, ran, saved


def test_batches_until_the_grid_is_done():
    state, why, ran, saved = loop(resume({}, "f", 25), max_batches=None)
    assert why == "complete" and ran == [(0, 10), (10, 10), (20, 5)] and state["next"] == 25 and state["cycles"] == 1
    assert [h["new_jobs"] for h in state["history"]] == [10, 10, 5] and saved[-1]["next"] == 25


def test_limits_and_cycles():
    assert loop(resume({}, "f", 25))[1:3] == ("batches", [(0, 10)])
    assert loop(resume({}, "f", 25), target=15, max_batches=None)[1:3] == ("target", [(0, 10), (10, 10)])
    state, why, ran, _ = loop(resume({}, "f", 15), cycle=True, max_batches=3)
    assert why == "batches" and ran == [(0, 10), (10, 5), (0, 10)] and state["cycles"] == 1
    ticks = iter(range(0, 1000, 40))
    assert loop(resume({}, "f", 100), max_batches=None, max_seconds=100, clock=lambda: next(ticks))[1] == "time"
    assert loop(resume({}, "f", 0), cycle=True)[1] == "complete"


def test_failed_batches():
    state, why, ran, _ = loop(resume({}, "f", 30), fail_at=(10,), progress=4, max_batches=None)
    assert why == "complete" and ran == [(0, 10), (14, 10), (24, 6)] and "cut off" in state["history"][1]["error"]
    saved = []
    with pytest.raises(OSError):
        run.run_batches({"total": 30, "next": 10}, lambda o, n: (_ for _ in ()).throw(OSError("x")), 10, lambda: 0, saved.append, dict)
    assert saved[-1]["history"][-1]["offset"] == 10 and saved[-1]["next"] == 10


def test_single_writer(spark, tmp_path):
    path = str(tmp_path / "run.lock")
    with run.single_writer(spark, path) as first:
        with run.single_writer(spark, path) as second:
            assert first and not second and run.status_of(second, False) == "skipped"
        with run.single_writer(spark, path) as third:
            assert not third
    with run.single_writer(spark, path) as again:
        assert again and run.status_of(again, False) == "completed" and run.status_of(True, False, True) == "failed"


def answers(*given):
    left = list(given)

    def get(url, timeout):
        value = left.pop(0)
        if isinstance(value, Exception):
            raise value
        return value

    return get


def test_fetch_waits_and_gives_up():
    limited = urllib.error.HTTPError("u", 429, "slow down", None, None)
    slept = []
    assert http.fetch_text("u", get=answers(limited, limited, b"ok \xff"), sleep=slept.append, base_sleep=10) == "ok �" and slept == [10, 20]
    slept.clear()
    assert http.fetch_text("u", get=answers(TimeoutError(), urllib.error.URLError("x"), b"{}"), sleep=slept.append, base_sleep=45) == "{}" and slept == [30, 45]
    with pytest.raises(urllib.error.URLError):
        http.fetch_text("u", get=answers(*[urllib.error.URLError("x")] * 3), sleep=slept.append)
    with pytest.raises(urllib.error.HTTPError):
        http.fetch_text("u", get=answers(urllib.error.HTTPError("u", 404, "gone", None, None)), sleep=slept.append)
    assert http.fetch_json("u", {"a": "b c"}, get=lambda url, timeout: b'{"url": "%s"}' % url.encode()) == {"url": "u?a=b+c"}


def test_fetched_errors_are_values(spark):
    urls = spark.createDataFrame([("not a url",), ("http://127.0.0.1:9/",)], "url string")
    rows = {r["url"]: r for r in http.fetched(urls, retries=0, timeout=1.0).collect()}
    assert all(r["value"] is None and r["error"] for r in rows.values()) and len(rows) == 2


def test_registry():
    config = {"greenhouse": [{"key": "a"}, {"key": "b"}], "unknown": [{"key": "c"}], "workday": [{"key": "d"}]}
    assert feeds.career_sources(config) == [("greenhouse", {"key": "a"}), ("greenhouse", {"key": "b"}), ("workday", {"key": "d"})]
    assert feeds.career_sources(config, {"workday", "unknown"}) == [("workday", {"key": "d"})] and feeds.career_sources({}) == []


def test_snapshots_and_raw_dumps(spark, tmp_path):
    for day, n in (("2026-01-01", 2), ("2026-01-02", 5)):
        rows = [("totals", "sap_jobs_after_filter", float(n)), *(("modules", f"m{k}", float(10 - k)) for k in range(7)), ("primary_locations", "Porto", 1.0)]
        files.write_snapshot_summary(spark.createDataFrame(rows, "section string, label string, value double"), str(tmp_path), day)
    index = files.snapshot_index(spark, str(tmp_path)).collect()
    assert [(r["date"], r["total"]) for r in index] == [("2026-01-01", 2), ("2026-01-02", 5)]
    assert index[0]["top_modules"] == {f"m{k}": 10 - k for k in range(5)} and index[1]["top_locations"] == {"Porto": 1}
    files.write_raw(spark.createDataFrame([("{}",)], "value string"), str(tmp_path / "raw"), "himalayas", "2026-01-01")
    files.write_raw(spark.createDataFrame([("[]",)], "value string"), str(tmp_path / "raw"), "jobicy", "2026-01-01")
    assert {(r["source"], r["value"]) for r in spark.read.parquet(str(tmp_path / "raw")).collect()} == {("himalayas", "{}"), ("jobicy", "[]")}
    files.write_tables(report.tables({"open": spark.createDataFrame([("a", "b", 1.0)], "section string, label string, value double")}, index_frame(spark)), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "open_summary")).count() == 1 and spark.read.json(str(tmp_path / "report" / "history")).count() == 1


def index_frame(spark):
    return spark.createDataFrame([("2026-01-01", 1)], "date string, value bigint")


def test_report_helpers(spark):
    one = spark.range(1)
    got = one.select(report.thousands(F.lit(1234567)).alias("a"), report.thousands(F.lit(12)).alias("b"), report.date_of(F.lit("2026-01-02T03:04:05")).alias("c"), report.date_of(F.lit("")).alias("d")).first()
    assert tuple(got) == ("1,234,567", "12", "2026-01-02", None)
    history = spark.createDataFrame([("d1", 3), ("", 4), (None, 5), ("d2", 0), ("d3", None)], "date string, n bigint")
    assert [tuple(r) for r in report.history_counts(history, "n").collect()] == [("d1", 3)]
    rows = spark.createDataFrame([("b", "x"), ("a", None), ("a", ""), (None, "x")], "p string, q string")
    assert [tuple(r) for r in report.choices(rows, ("p", "q")).collect()] == [("p", "a"), ("p", "b"), ("q", "x")]
    jobs = spark.createDataFrame([(1, "b", None, None, None), (2, None, "z", None, "t"), (3, "", "a", None, None)], "i int, query string, location string, company string, title string")
    assert [r["i"] for r in report.in_link_order(jobs).collect()] == [3, 2, 1]


def test_summary_of_nothing_and_top_maps(spark):
    rows = spark.createDataFrame([("modules", "a", 2.0), ("modules", "b", 5.0), ("modules", "c", 5.0), ("skills", "x", 9.0)], "section string, label string, value double")
    assert {r["section"]: r["top"] for r in summary.top_maps(rows, 2).collect()} == {"modules": {"b": 5, "c": 5}}
    assert [r["label"] for r in summary.ranked(rows, "modules").collect()] == ["b", "c", "a"]
    runs = spark.createDataFrame([("p", "k", "z", 3, 1, 0.5), ("p", "j", "a", 2, 2, 1.5)], "provider string, source_key string, source_label string, raw_count int, sap_count int, duration_seconds double")
    assert [r["source_label"] for r in summary.source_runs(runs).collect()] == ["a", "z"]


def test_previous_run_and_queue(spark):
    stats = spark.createDataFrame([("a", 5, 0), ("b", 5, 0), ("c", 5, 2)], "path string, n_rows bigint, n_net_new bigint")
    previous = spark.createDataFrame([("a", 5, 3), ("b", 4, 3), ("c", 5, 9)], "path string, n_rows bigint, n_net_new bigint")
    assert {tuple(r) for r in run.with_previous(stats, previous).collect()} == {("a", 5, 3), ("b", 5, 0), ("c", 5, 2)}
    rows = spark.createDataFrame([(1, "1", "x" * 80), (2, "2", "short"), (3, "", None), (4, "4", None), (5, None, None)], "row_id int, linkedin_job_id string, description string")
    assert [r["row_id"] for r in run.backfill_queue(rows, "row_id", 5).collect()] == [2, 4]
